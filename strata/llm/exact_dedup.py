"""Exact duplicates by an extendible-hash index kept as files in the shared folder.

A document's key is a 64-bit hash of its text. An index entry stands for one
distinct text: entries with the same key form a chain, told apart by their bytes.
Entries live in buckets that own a range of the key space. The directory starts
with one bucket and is doubled, in thought, until no bucket holds more than
``capacity`` keys: all depths are counted at once from a fine histogram of the
keys, and a bucket is the shallowest prefix that fits.

First copies are merged into a few parts each by partial aggregates, so a group holding
a third of all rows leaves each task as a few rows. Their keys make the directory, which
leads every part to its bucket. Owner tasks take ranges of buckets and keys, compare the
bytes of the texts under a key, merge equal ones and chain the others: there it is decided
which row stays. A lookup goes the same way, from the key by the directory to a bucket and
there to the entry; it moves rows of id and key only, and adaptive execution splits a hot
key. All of it is DataFrame work.

Defined cases: a null text counts as empty; the empty text is a text like any other;
null ids rank below all others; rows that repeat an id are documents of their own in
the report, and all of them carry ``kept`` if that id stays (:func:`keep_one` keeps
one of them); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import free_name, staged, whole_text

#: A text's copies are merged into at most so many parts before they meet.
PARTS = 8
#: Depth of the histogram beyond the depth that evenly spread keys would need.
SLACK = 6


def hashed(text: Column) -> Column:
    return F.xxhash64(text)


@dataclass
class Index:
    """``entries``: bucket, key, chain, text_sha256, keep_id, group_size.

    ``directory``: cell, local_depth, bucket, for cells of ``depth`` leading bits.
    """

    entries: DataFrame
    directory: DataFrame
    depth: int


def _cell(key: str, depth: int) -> Column:
    return F.shiftrightunsigned(F.col(key), 64 - depth)


def build_directory(keys: DataFrame, capacity: int, entries: int) -> tuple[DataFrame, int]:
    """The bucket of each occupied cell, and the number of leading bits of a cell.

    A bucket is named by its first cell, so buckets sort as the key ranges do. Cells
    number about ``entries / capacity``; a cell still overfull at the full depth
    (equal keys, which no doubling can part) stays one bucket with long chains.
    """
    depth = min(62, max(0, (max(1, entries) // capacity).bit_length()) + SLACK)
    cells = keys.groupBy(_cell("key", depth).alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select(
        "cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth")
    ).withColumn("prefix", F.expr(f"shiftright(cell, {depth} - local_depth)"))
    held = levels.groupBy("local_depth", "prefix").agg(F.sum("n").alias("n"))
    fitting = held.filter((F.col("n") <= capacity) | (F.col("local_depth") == depth))
    directory = (
        levels.drop("n")
        .join(fitting.drop("n"), ["local_depth", "prefix"])
        .groupBy("cell")
        .agg(F.min("local_depth").alias("local_depth"))
        .withColumn(
            "bucket",
            F.expr(
                f"shiftleft(shiftright(cell, {depth} - local_depth), {depth} - local_depth)"
            ),
        )
    )
    return directory, depth


def _keyed(docs: DataFrame, id_col: str, text_col: str, key: Callable) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).withColumn(
        "key", key(F.col("text"))
    )


def _parts(keyed: DataFrame) -> DataFrame:
    """Copies of a text merged into few rows: the largest id, and how many they are."""
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    return (
        keyed.groupBy("key", "text", part.alias("part"))
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("copies"))
        .drop("part")
    )


def _bucketed(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Lead rows with a key to their bucket, by the directory."""
    return rows.withColumn("cell", _cell("key", depth)).join(
        directory.select("cell", "bucket"), "cell"
    )


def _entries(owned: DataFrame) -> DataFrame:
    """The chains of each key: grouping by the text itself compares bytes."""
    merged = owned.groupBy("bucket", "key", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    hashed_text = merged.withColumn("text_sha256", F.sha2("text", 256)).drop("text")
    in_chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    return hashed_text.select(
        "bucket",
        "key",
        F.row_number().over(in_chain).alias("chain"),
        "text_sha256",
        "keep_id",
        "group_size",
    )


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    key: Callable[[Column], Column] = hashed,
) -> Index:
    """Write an index of all texts: a directory, and buckets filled by their owners."""
    parts = staged(_parts(_keyed(docs, id_col, text_col, key)), "dedup-parts")
    keys = staged(parts.select("key").distinct(), "dedup-keys")
    directory, depth = build_directory(keys, capacity, keys.count())
    directory = staged(directory, "dedup-directory")
    # The range that a task owns holds whole keys, so what follows needs no other exchange.
    owned = _bucketed(parts, directory, depth).repartitionByRange("bucket", "key")
    return Index(staged(_entries(owned), "dedup-index"), directory, depth)


def lookup(
    docs: DataFrame,
    index: Index,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: Callable[[Column], Column] = hashed,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, text_sha256, bucket, chain.

    The directory leads each key to its bucket, which holds its entries. A key with one entry needs no text. Only where several texts share a key are the
    texts fetched and compared again; if there are none, that branch is not built.
    """
    keyed = _keyed(docs, id_col, text_col, key)
    at = ["bucket", "key"]
    chained = index.entries.filter(F.col("chain") == 2).select(*at)
    told = ["id", "keep_id", "group_size", "text_sha256", "bucket", "chain"]
    led = _bucketed(keyed.select("id", "key"), index.directory, index.depth)
    if chained.isEmpty():
        return led.join(index.entries, at).select(told)
    alone = index.entries.join(chained, at, "left_anti")
    plain = led.join(alone, at).select(told)
    collided = keyed.join(chained.select("key").distinct(), "key", "left_semi")
    among = staged(_bucketed(collided, index.directory, index.depth), "dedup-chained")
    texts = among.select(*at, "text").distinct()
    of_text = texts.withColumn("text_sha256", F.sha2("text", 256)).join(
        index.entries, [*at, "text_sha256"]
    )
    return plain.unionByName(among.join(of_text, [*at, "text"]).select(told))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    key: Callable[[Column], Column] = hashed,
) -> DataFrame:
    """Build the index and look every document up in it.

    Returns ``id_col``, keep_id (the largest id among equal texts), group_size, kept,
    text_sha256, bucket and chain.
    """
    index = build_index(docs, id_col, text_col, capacity, key)
    found = lookup(docs, index, id_col, text_col, key)
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "bucket",
        "chain",
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    key: Callable[[Column], Column] = hashed,
) -> DataFrame:
    """``docs`` without all but one row of each group of equal texts, columns as given."""
    keep = (
        exact_duplicates(docs, id_col, text_col, capacity, key)
        .filter("kept")
        .select(F.col("keep_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    )
    keep = staged(keep, "dedup-kept")
    sha = free_name(docs, "_sha")
    marked = docs.withColumn(sha, F.sha2(whole_text(text_col), 256))
    same = marked[id_col].eqNullSafe(keep["_kept_id"]) & (marked[sha] == keep["_kept_sha"])
    kept = marked.join(keep, same, "left_semi")
    repeated = keep.groupBy("_kept_id", "_kept_sha").count().filter("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_col, sha])
    return kept.drop(sha)
