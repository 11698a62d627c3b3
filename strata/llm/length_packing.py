"""Batches of documents in length buckets that waste the least padding.

The lengths of all documents are counted in one histogram. Dynamic programming over it
chooses the bucket boundaries: every document is padded to the boundary of its bucket,
and the sum of the padding is the least that ``buckets`` boundaries can reach. Inside a
bucket, batches of a fixed number of rows fill a token budget.

The histogram reaches the driver. It is bounded whatever the corpus: lengths up to
``EXACT`` have a cell each, longer ones share cells of a 512th of their power of two, so
there are at most EXACT + 512 cells per doubling. Boundaries are upper ends of cells.

Batches number the rows of a bucket through, though no task holds a bucket: rows are
dealt to shares of about ``share_rows`` by a hash of the id and the text, numbered inside a
share, and moved on by the counts of the shares before. Only the last batch of a bucket is not
full. A row longer than the budget is a batch by itself; nothing is cut or dropped.

Defined cases: null or empty texts have length zero and go to the first bucket; ties and
rows that repeat an id are placed in the order of a hash; null ids are dealt by their texts; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import staged, whole_text, word_count

EXACT = 1024


def cell_end(length: Column) -> Column:
    """The largest length in the histogram cell of ``length``."""
    power = F.floor(F.log2(F.greatest(length, F.lit(EXACT)))).cast("int")
    # log2 of a long near a power of two may round up.
    power = F.when(F.pow(F.lit(2.0), power) > length, power - 1).otherwise(power)
    width = F.pow(F.lit(2.0), power - 9).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / width).cast("long") * width)


def boundaries(ends: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The ends of at most ``buckets`` runs of cells whose total padded length is least."""
    order = np.argsort(ends)
    ends, total = ends[order].astype(np.float64), np.concatenate([[0], np.cumsum(counts[order])])
    n = len(ends)
    if not n:
        return []
    best = ends * total[1:]  # padded length of the first j + 1 cells, in one run
    cuts = []
    for _ in range(1, min(buckets, n)):
        # A run that ends at cell j and begins after cell i costs ends[j] for each row.
        better, cut = best.copy(), np.full(n, -1)
        for j in range(1, n):
            cost = best[:j] + ends[j] * (total[j + 1] - total[1 : j + 1])
            i = int(cost.argmin())
            if cost[i] < better[j]:
                better[j], cut[j] = cost[i], i
        cuts.append(cut)
        best = better
    chosen, j = [], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            chosen.append(j)
            j = int(cut[j])
    chosen.append(j)
    return sorted({int(ends[k]) for k in chosen})


def _through(rows: DataFrame, share_rows: int) -> DataFrame:
    """Add ``place``, from 0, through all rows of each bucket."""
    held = rows.groupBy("bucket").agg(F.count("*").alias("n"))  # a row for each boundary
    shares = F.greatest(F.lit(1), F.ceil(F.col("n") / share_rows)).cast("long")
    dealt = staged(
        rows.join(F.broadcast(held), "bucket")
        .withColumn("share", F.pmod(F.xxhash64("id", F.lit(3), "text_hash"), shares))
        .drop("n"),
        "pack-dealt",
    )
    counts = dealt.groupBy("bucket", "share").agg(F.count("*").alias("held"))
    upto = Window.partitionBy("bucket").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "bucket", "share", F.coalesce(F.sum("held").over(upto), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("bucket", "share").orderBy(
        F.xxhash64("id", F.lit(5), "text_hash"), "id", "text_hash"
    )
    numbered = dealt.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["bucket", "share"]).withColumn(
        "place", F.col("place") + F.col("offset")
    )


def pack(
    docs: DataFrame,
    length: Column | None = None,
    buckets: int = 16,
    budget: int = 65_536,
    share_rows: int = 100_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_tokens, bucket_length, batch, slot, padding.

    ``length`` counts the tokens of a row, by default its words. ``batch`` numbers the
    batches of one bucket, ``slot`` the rows of one batch.
    """
    length = word_count(whole_text(text_col)) if length is None else length.cast("long")
    sized = staged(
        docs.select(
            F.col(id_col).alias("id"),
            F.xxhash64(whole_text(text_col)).alias("text_hash"),
            F.coalesce(length, F.lit(0)).alias("n_tokens"),
        ),
        "pack-lengths",
    )
    cells = sized.groupBy(cell_end(F.col("n_tokens")).alias("end")).agg(F.count("*").alias("n"))
    histogram = cells.toPandas()
    ends = boundaries(histogram["end"].to_numpy(), histogram["n"].to_numpy(), buckets)
    bucket = F.lit(0)
    for end in ends:
        bucket = bucket + (F.col("n_tokens") > end).cast("int")
    end_of = F.array(*[F.lit(end).cast("long") for end in ends or [0]])
    placed = _through(sized.withColumn("bucket", bucket), share_rows)
    bound = F.element_at(end_of, F.col("bucket") + 1)
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(bound, F.lit(1)))).cast("long")
    return placed.select(
        F.col("id").alias(id_col),
        "n_tokens",
        bound.alias("bucket_length"),
        F.floor(F.col("place") / rows).alias("batch"),
        (F.col("place") % rows).alias("slot"),
        (bound - F.col("n_tokens")).alias("padding"),
    )
