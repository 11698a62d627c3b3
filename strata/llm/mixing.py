"""Mix sources to target weights by repeating documents.

Sizes are summed per source. Source number r in order of name gets weight
``weights[r % len(weights)]`` of the mix, whose size is ``share`` times all there is. A
source's target stops at ``most`` times its own size, and what is cut off goes to the
others by weight until none is above its stop. The rate of a source is its target over
its size; each document is taken floor(rate) times, and once more if a number drawn
from a hash of the seed and its id is below the fraction. So a re-run takes the same.

Sources are few beside documents, but nothing depends on it: they stay a table, ranked
by a range sort with counts per range, and levelled by rounds of one-row sums.

A row is drawn by its id. Where an id, or null, has several rows, each is drawn by the id,
the hash of its text and its number among equal rows, so that a source whose rows lack ids
meets its target like others.

Defined cases: null text has size zero; a null source is a source of its own, sorted
last; a null id counts as the text "null"; equal rows are numbered from 0, and which is
which does not matter; a source without words has target zero and takes each of its
documents zero times; columns of any name come back as given; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import column_of, staged, whole_text, word_count

#: Leading hex digits of the digest that make the drawn number: 52 bits fit a double.
_DIGITS = 13


def drawn(seed: int, name: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the row's name only."""
    text = F.concat(F.lit(f"{seed}:"), name)
    digits = F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10)
    return digits.cast("double") / F.lit(float(16**_DIGITS))


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Add ``rank``, from 0, by source in code-point order with null last.

    A range sort keeps ranges apart; the counts of the ranges before give the offset,
    so no task ranks all sources.
    """
    ranged = staged(
        sizes.withColumn("late", F.col("source").isNull())
        .repartitionByRange("late", "source")
        .withColumn("part", F.spark_partition_id()),
        "mix-ranged",
    )
    counts = ranged.groupBy("part").agg(F.count("*").alias("held"))
    # One row per range here, so as many as partitions.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "part", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("part").orderBy("late", "source")
    return (
        ranged.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, "part")
        .withColumn("rank", F.col("place") + F.col("offset"))
        .drop("late", "part", "place", "offset")
    )


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    A round stops the sources whose part at the present level is above their stop and
    raises the level for the rest; a round that stops no more is the last.
    """
    ranked = staged(
        ranked_sources(sizes).select(
            "source",
            "source_size",
            F.element_at(
                F.array(*[F.lit(int(w)) for w in weights]),
                (F.col("rank") % len(weights) + 1).cast("int"),
            ).alias("weight"),
            (F.col("source_size") * most).alias("stop"),
        ),
        "mix-sources",
    )
    all_of_it = ranked.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    mix = share * (all_of_it.n or 0)
    level, stopped = (mix / all_of_it.w if all_of_it.w else 0.0), 0
    while True:
        above = F.col("stop") <= F.col("weight") * F.lit(level)
        seen = ranked.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, F.col("stop"))).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("w"),
        ).first()
        if not seen.w or seen.n == stopped:
            break
        level, stopped = (mix - seen.held) / seen.w, seen.n
    part = F.col("weight") * F.lit(level)
    target = F.when(F.col("stop") <= part, F.col("stop").cast("double")).otherwise(part)
    return ranked.select("source", "source_size", target.alias("target"))


def named(rows: DataFrame) -> DataFrame:
    """Add ``name``, by which a row is drawn, to rows with ``id`` and ``sha``.

    Equal rows are numbered within the partitions that wrote them and moved on by the counts
    of those before, so that no task holds all.
    """
    own = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    several = rows.groupBy(F.col("id").alias("several_id")).agg(F.count("*").alias("n"))
    several = staged(several.filter("n > 1").select("several_id"), "mix-several")
    if several.isEmpty():
        return rows.withColumn("name", own)
    shared = F.col("id").eqNullSafe(F.col("several_id"))
    among = rows.join(several, shared, "left_semi")
    among = staged(among.withColumn("part", F.spark_partition_id()), "mix-shared")
    equal = ["id", "sha"]
    counts = among.groupBy(*equal, "part").agg(F.count("*").alias("held"))
    before = Window.partitionBy(*equal).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("id").alias("of"),
        F.col("sha").alias("of_sha"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("of"))
        & (F.col("sha") == F.col("of_sha"))
        & (F.col("part") == F.col("of_part"))
    )
    inside = Window.partitionBy(*equal, "part").orderBy(F.lit(0))
    numbered = among.withColumn("place", F.row_number().over(inside) - 1).join(offsets, same)
    number = (F.col("place") + F.col("offset")).cast("string")
    apart = numbered.withColumn("name", F.concat_ws(":", own, "sha", number))
    alone = rows.join(several, shared, "left_anti").withColumn("name", own)
    return alone.unionByName(apart.select(*alone.columns))


def taken_rows(
    docs: DataFrame,
    text_col: str,
    id_col: str,
    source_col: str,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
    whole: bool = False,
) -> DataFrame:
    """Per row: id, size, source_size, target, copies, and ``row``, the whole row if asked."""
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text).alias("size"),
        F.sha2(text, 256).alias("sha"),
        F.struct(*[column_of(docs, c) for c in docs.columns]).alias("row"),
    )
    if not whole:
        rows = staged(rows.drop("row"), "mix-sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = targets(per_source, weights, share, most).withColumn("rate", rate)
    wanted = staged(wanted, "mix-targets").withColumnRenamed("source", "of_source")
    joined = named(rows).join(wanted, F.col("source").eqNullSafe(F.col("of_source")))
    floor = F.floor("rate")
    extra = (drawn(seed, F.col("name")) < F.col("rate") - floor).cast("long")
    return joined.select(
        "id",
        "size",
        "source_size",
        "target",
        (floor + extra).alias("copies"),
        *(["row"] if whole else []),
    )


def mixed(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns as given."""
    taken = taken_rows(docs, text_col, id_col, source_col, whole=True, **options)
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    repeated = taken.filter("copies > 0").select("row", F.explode(copies).alias("copy"))
    return repeated.select("row.*")


def report(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """Per row: id, size, source_size, target, copies, taken (size times copies)."""
    taken = taken_rows(docs, text_col, id_col, source_col, **options)
    return taken.withColumn("taken", F.col("size") * F.col("copies")).withColumnRenamed(
        "id", id_col
    )
