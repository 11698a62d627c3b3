"""Near-duplicates by SimHash: fingerprints a few bits apart are linked.

A fingerprint has a bit set if more than half of the document's shingle hashes have
it set. Two fingerprints that differ in at most ``bits`` bits agree on one of
``bits + 1`` blocks of the 64 bits, so all pairs to verify meet in a bucket of equal
blocks. A bucket of more than ``bucket_rows`` fingerprints is divided by blocks of the
bits not yet fixed, by the same argument; what is still too large on the last level is
dealt over tiles, so that each pair of its chunks meets in one task. No pair is lost.

Equal fingerprints are one node. Within a bucket only the edges of a spanning star per
local component are emitted, not the pairs; components are joined up across buckets by
:func:`strata.llm.components.components`.

Defined cases: null text counts as empty; a text without words has fingerprint zero
and is linked as any other; a text of fewer words than a shingle is one shingle; null
ids count only where a component has no other, and its component is then null; rows
that repeat an id are documents of their own, also where one row of each component is
kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, free_name, staged, whole_text
from strata.llm.components import components

SEED = 42
#: Levels of blocks within blocks before an oversized bucket is tiled.
LEVELS = 3
#: Buckets up to this size are compared together, larger ones one by one.
SMALL = 64
_HASHES = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> list[int]:
    if not words:
        return []
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = [0, *ends[: max(0, len(words) - size)].tolist()]
    ends = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64 bits as a signed number. ``bytes.split`` and ``lower`` act on ASCII only."""
    hashes = shingle_hashes(text.lower().split(), shingle)
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _HASHES):
        part = np.array(hashes[at : at + _HASHES], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, fp`` per row of ``docs``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = [
                fingerprint(text or b"", shingle)
                for start, end in chunks(texts, 1 << 22)
                for text in texts.slice(start, end - start).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["id", "fp"]
            )

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return pairs.mapInArrow(compute, f"id {pairs.schema['id'].dataType.simpleString()}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def block_masks(fixed: int, blocks: int) -> list[int]:
    """Masks that add one of ``blocks`` runs of the free bits to the fixed ones."""
    free = [bit for bit in range(64) if not fixed >> bit & 1]
    return [
        fixed | sum(1 << int(bit) for bit in run)
        for run in np.array_split(free, blocks)
        if len(run)
    ]


def _bucketed(nodes: DataFrame, masks: Column) -> DataFrame:
    return nodes.select("fp", F.explode(masks).alias("mask")).withColumn(
        "value", F.col("fp").bitwiseAND(F.col("mask"))
    )


def _tiled(rows: DataFrame, sizes: DataFrame, bucket_rows: int) -> DataFrame:
    """Deal each oversized bucket in chunks, and send a chunk to its tile with each other."""
    k = F.ceil(F.col("n") / bucket_rows).cast("int")
    chunk = F.pmod(F.xxhash64("fp", F.lit(1)), k).cast("int")
    return (
        rows.join(sizes, ["mask", "value"])
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .select(
            "fp",
            "mask",
            "value",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
        )
    )


def buckets(nodes: DataFrame, bits: int, bucket_rows: int) -> DataFrame:
    """``fp, mask, value, i, j``: every pair within ``bits`` bits shares some bucket."""
    masks = block_masks(0, bits + 1)
    rows = _bucketed(nodes, F.array(*[F.lit(_signed(m)) for m in masks]))
    settled = None
    for level in range(LEVELS):
        sizes = rows.groupBy("mask", "value").agg(F.count("*").alias("n"))
        large = staged(sizes.filter(F.col("n") > bucket_rows), "simhash-large")
        if large.isEmpty():
            large = None
            part = rows
        else:
            part = rows.join(large, ["mask", "value"], "left_anti")
        part = part.select("fp", "mask", "value", F.lit(0).alias("i"), F.lit(0).alias("j"))
        settled = part if settled is None else settled.unionByName(part)
        if large is None:
            return settled
        within = rows.join(large, ["mask", "value"], "left_semi")
        if level == LEVELS - 1:
            return settled.unionByName(_tiled(rows, large, bucket_rows))
        children = {m: block_masks(m, bits + 1) for m in masks}
        pairs = []
        for mask, below in children.items():
            pairs += [F.lit(_signed(mask)), F.array(*[F.lit(_signed(m)) for m in below])]
        rows = staged(
            _bucketed(within.select("fp", F.col("mask").alias("up")).select(
                "fp", F.create_map(*pairs)[F.col("up")].alias("masks")), F.col("masks")
            ).distinct(),
            "simhash-rows",
        )
        masks = sorted({m for below in children.values() for m in below})
    return settled


def _stars_of_small(fps: np.ndarray, ends: np.ndarray, bits: int) -> list[tuple]:
    """Compare rows with the next, the one after and so on, for all buckets at once."""
    at = np.arange(len(fps))
    root = at.copy()
    pairs = []
    for offset in range(1, SMALL):
        at = at[at + offset < ends[at]]
        if not len(at):
            break
        near = np.bitwise_count(fps[at] ^ fps[at + offset]) <= bits
        if near.any():
            pairs.append((at[near], at[near] + offset))
    if not pairs:
        return []
    left, right = (np.concatenate(side) for side in zip(*pairs, strict=True))
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return [(fps[linked], fps[root[linked]])] if len(linked) else []


def _stars_of_large(fps: np.ndarray, bits: int) -> list[tuple]:
    """Visit from one row what is near it; each row is compared with the unvisited only."""
    left, stars = fps, []
    while len(left) > 1:
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= bits
            if near.any():
                found, left = left[near], left[~near]
                stars.append((found, np.full(len(found), root)))
                front.extend(found)
    return stars


def linked(rows: DataFrame, bits: int) -> DataFrame:
    """``a, b``: a spanning star for each component inside each bucket."""
    keys = ["mask", "value", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch])
            held = table if held is None else np.concatenate([held, table], axis=1)
            cuts = np.flatnonzero((held[1:, 1:] != held[1:, :-1]).any(0)) + 1
            if len(cuts):  # the last bucket may go on in the next batch
                yield from stars(held[0, : cuts[-1]], cuts)
                held = held[:, cuts[-1] :]
        if held is not None and held.shape[1]:
            yield from stars(held[0], np.array([held.shape[1]]))

    def stars(fps: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        fps = fps.astype(np.uint64)
        sizes = np.diff(ends, prepend=0)
        small = np.repeat(sizes <= SMALL, sizes)
        found = _stars_of_small(
            fps[small], np.repeat(np.cumsum(sizes[sizes <= SMALL]), sizes[sizes <= SMALL]), bits
        )
        for end, size in zip(ends[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            found += _stars_of_large(fps[end - size : end], bits)
        if found:
            a, b = (np.concatenate(side).astype(np.int64) for side in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = rows.select("fp", *keys).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    bucket_rows: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, fingerprint, component_id`` (least id reachable over links) per row."""
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    nodes = staged(nodes, "simhash-nodes")
    roots = components(linked(buckets(nodes.select("fp"), bits, bucket_rows), bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = staged(rooted, "simhash-rooted")
    least = staged(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least"
    )
    named = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    shingle: int = 4,
    bits: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each component, columns as given.

    That of the least id, null ids last; of unlike texts with that id, of the least SHA-256.
    """
    sha = free_name(docs, "_sha")
    marked = docs.withColumn(sha, F.sha2(whole_text(text_col), 256))
    named = marked.select(
        F.struct(
            F.col(id_col).isNull().alias("late"),
            F.col(id_col).alias("id"),
            F.col(sha).alias("sha"),
        ).alias("_row"),
        F.col(text_col).alias("_text"),
    )
    keep = (
        near_duplicates(named, shingle, bits, id_col="_row", text_col="_text")
        .filter("_row = component_id")
        .select(F.col("_row.id").alias("_kept_id"), F.col("_row.sha").alias("_kept_sha"))
    )
    keep = staged(keep, "simhash-kept")
    same = marked[id_col].eqNullSafe(keep["_kept_id"]) & (marked[sha] == keep["_kept_sha"])
    kept = marked.join(keep, same, "left_semi")
    repeated = keep.groupBy("_kept_id", "_kept_sha").count().filter("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([id_col, sha])
    return kept.drop(sha)
