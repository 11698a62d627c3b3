"""Hard negatives for contrastive training, by exact scores over whole tables.

Vectors are of integers: a component x is floor(scale * x). An anchor's positives are its
best other rows of the same label; a positive's negatives are the best rows of other labels
whose score lies within a band below the positive's. A score is the integer inner product;
higher scores come first, ties go by the smaller id, null ids last.

Scoring follows the Four Russians. A block of candidates is kept as bit planes in two's
complement: for each plane and each group of eight dimensions one byte per candidate. For
each anchor and group the sums of all 256 subsets of its eight components are tabled, each
entry from a smaller one by one addition. The bytes index the tables; the sums of a plane
are added, and planes are joined by shift and add, the sign plane with a minus. So each
score is exact and whole, and there is no multiplication.

Anchors are a stated query set against all rows: blocks of anchors meet blocks of
candidates over the number of the candidate block, so a task holds one block of each at a
time. A block answers with its few best rows for each anchor, and a ranking limited per
task merges the answers. The first pass finds positives, the second, with their scores
known, negatives. No row, label or vector gathers in one place, however often it repeats.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take
no part; missing components of shorter vectors count as zero, so an empty vector scores zero;
null ids and ids that do not divide are no anchors; each of several equal rows is a row of its
own, and only the anchor's own row is not its positive; an anchor without positives, or a
positive without negatives in its band, gives no row; an empty table gives an empty result.
Scores are 64-bit: a table whose scores could pass that is refused with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from strata.llm.common import staged

#: Rows of a candidate block, and anchors of an anchor block.
CANDIDATES, ANCHORS = 4096, 64
#: Dimensions of a group: a byte of a bit plane has one bit of each.
GROUP = 8
#: Most tasks that blocks are dealt to.
MOST_PLACES = 10_000
#: Rows scored at once, so that their sums stay in a processor's cache.
_SLICE = 512

_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("rows", pa.list_(pa.int64())),
        ("labels", pa.list_(pa.int64())),
        ("groups", pa.int32()),
        ("planes", pa.binary()),
    ]
)
_ANCHORS = pa.schema(
    [
        ("anchor_ids", pa.list_(pa.int64())),
        ("anchor_rows", pa.list_(pa.int64())),
        ("anchor_labels", pa.list_(pa.int64())),
        ("width", pa.int32()),
        ("vectors", pa.list_(pa.int64())),
        ("bounds", pa.list_(pa.list_(pa.int64()))),
    ]
)
_FOUND = pa.schema(
    [(name, pa.int64()) for name in ("anchor_id", "anchor_row", "bound", "score", "id", "row")]
)


def integers(
    rows: DataFrame,
    scale: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """The rows that take part as (id, label, q, row); ``row`` tells equal rows apart."""
    parts = F.col(vector_col)
    finite = F.forall(
        parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    scaled = F.transform(parts, lambda x: F.floor(x.cast("double") * float(scale)))
    return rows.filter(F.col(label_col).isNotNull() & parts.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        scaled.cast("array<long>").alias("q"),
        F.monotonically_increasing_id().alias("row"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of equal width, shorter ones filled with zeros."""
    lengths = pc.list_value_length(column).to_numpy()
    width = -(-max(int(lengths.max(initial=0)), 1) // GROUP) * GROUP
    filled = np.zeros((len(column), width), np.int64)
    filled[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return filled


def bit_planes(q: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes; the last plane holds the sign."""
    n, width = q.shape
    low, high = int(q.min(initial=0)), int(q.max(initial=0))
    count = max(high.bit_length(), (-1 - low).bit_length()) + 1
    planes = np.empty((count, width // GROUP, n), np.uint8)
    for plane in range(count):
        bits = ((q >> plane) & 1).astype(np.uint8).reshape(n, -1, GROUP)
        planes[plane] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0].T
    return planes


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each group the sum of each subset of its components."""
    n, width = anchors.shape
    table = np.zeros((width // GROUP, 1 << GROUP, n), anchors.dtype)
    parts = anchors.T.reshape(-1, GROUP, n)
    for bit in range(GROUP):
        half = 1 << bit
        table[:, half : 2 * half] = table[:, :half] + parts[:, bit : bit + 1]
    return table


def scores(planes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products; groups that one side lacks are zero there."""
    count, groups, n = planes.shape
    total = np.zeros((n, table.shape[2]), table.dtype)
    for start in range(0, n, _SLICE):
        part = planes[:, :, start : start + _SLICE]
        sums = total[start : start + _SLICE]
        for plane in reversed(range(count)):
            sums <<= 1
            for group in range(min(groups, len(table))):
                sums += table[group].take(part[plane, group], axis=0)
            if plane == count - 1:
                np.negative(sums, out=sums)
    return total


def _narrowest(q: np.ndarray, planes: int) -> type:
    """32 bits where all sums fit them."""
    most = int(np.abs(q).max(initial=0)) * q.shape[1] << planes
    return np.int32 if most < 1 << 31 else np.int64


def _best(score: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """The best of the rows; of equal scores the first ones."""
    if len(rows) > limit:
        score = score[rows]
        least = np.partition(score, len(rows) - limit)[len(rows) - limit]
        above, level = rows[score > least], rows[score == least]
        rows = np.concatenate([above, level[: limit - len(above)]])
    return rows


def candidate_blocks(prepared: DataFrame, size: int = CANDIDATES) -> DataFrame:
    """At most ``size`` rows each, in order of id, as bit planes."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                order = [("id", "ascending"), ("row", "ascending")]
                part = part.take(pc.sort_indices(part, order))
                planes = bit_planes(_matrix(part["q"]))
                block = {
                    "block": batch["row"][start].as_py(),
                    "ids": part["id"].to_pylist(),
                    "rows": part["row"].to_pylist(),
                    "labels": part["label"].to_pylist(),
                    "groups": planes.shape[1],
                    "planes": planes.tobytes(),
                }
                yield pa.RecordBatch.from_pylist([block], _BLOCK)

    return prepared.mapInArrow(compute, from_arrow_schema(_BLOCK))


def anchor_blocks(anchors: DataFrame, size: int = ANCHORS) -> DataFrame:
    """At most ``size`` anchors (id, label, q, row, bounds) each."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                q = _matrix(part["q"])
                block = {
                    "anchor_ids": part["id"].to_pylist(),
                    "anchor_rows": part["row"].to_pylist(),
                    "anchor_labels": part["label"].to_pylist(),
                    "width": q.shape[1],
                    "vectors": q.ravel().tolist(),
                    "bounds": part["bounds"].to_pylist(),
                }
                yield pa.RecordBatch.from_pylist([block], _ANCHORS)

    return anchors.mapInArrow(compute, from_arrow_schema(_ANCHORS))


def best_rows(
    blocks: DataFrame, n_blocks: int, anchors: DataFrame, limit: int, low: int = 0, high: int = 0
) -> DataFrame:
    """The best rows for each anchor (anchor_id, anchor_row, bound, score, id, row).

    Without bounds the rows are others of the anchor's label. With bounds, scores of its
    positives, they are of other labels, and for each bound their score lies within ``low``
    and ``high`` percent of it. Each block of anchors goes to all places, each block of
    candidates to one, and they meet there.
    """
    # A number of partitions is asked for, as small blocks are much work.
    n_places = min(max(1, n_blocks), MOST_PLACES)
    at = F.pmod(F.xxhash64("block"), F.lit(n_places))
    places = F.sequence(F.lit(0).cast("long"), F.lit(n_places - 1).cast("long"))
    met = (
        blocks.withColumn("place", at)
        .repartition(n_places, "place")
        .join(
            anchor_blocks(anchors)
            .withColumn("place", F.explode(places))
            .repartition(n_places, "place"),
            "place",
        )
    )

    def of_pair(pair: dict) -> Iterator[tuple]:
        ids, rows, labels = (pair[name] for name in ("ids", "rows", "labels"))
        planes = np.frombuffer(pair["planes"], np.uint8)
        planes = planes.reshape(-1, pair["groups"], len(rows))
        q = np.array(pair["vectors"], np.int64).reshape(-1, pair["width"])
        found = scores(planes, subset_sums(q.astype(_narrowest(q, len(planes)))))
        found = np.ascontiguousarray(found.T).astype(np.int64)
        rows, labels = np.array(rows), np.array(labels)
        for n, (id_, row, label) in enumerate(
            zip(pair["anchor_ids"], pair["anchor_rows"], pair["anchor_labels"], strict=True)
        ):
            score = found[n]
            if pair["bounds"][n] is None:
                wanted = [(None, (labels == label) & (rows != row))]
            else:
                other, percent = labels != label, 100 * score
                wanted = [
                    (bound, other & (percent >= low * bound) & (percent <= high * bound))
                    for bound in pair["bounds"][n]
                ]
            for bound, among in wanted:
                for k in _best(score, np.flatnonzero(among), limit):
                    yield id_, row, bound, int(score[k]), ids[k], int(rows[k])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                answers = list(of_pair(batch.slice(n, 1).to_pylist()[0]))
                columns = zip(*answers, strict=True) if answers else [[]] * len(_FOUND)
                arrays = [pa.array(list(column), pa.int64()) for column in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=_FOUND)

    answers = met.drop("place", "block").mapInArrow(compute, from_arrow_schema(_FOUND))
    best = Window.partitionBy("anchor_row", "bound").orderBy(
        F.col("score").desc(), F.col("id").asc_nulls_last(), "row"
    )
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= limit)


def mine(
    rows: DataFrame,
    scale: int = 256,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Per anchor and positive the hard negatives, ranked from 1.

    Anchors are the rows whose id is divisible by ``every``. Returns anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score. The rows, their blocks and the
    positives are written once each to the shared folder.
    """
    seen, packed = Observation(), Observation()
    span = [
        F.min(F.array_min("q")).alias("low"),
        F.max(F.array_max("q")).alias("high"),
        F.max(F.size("q")).alias("width"),
    ]
    given = integers(rows, scale, id_col, vector_col, label_col)
    prepared = staged(given.observe(seen, *span), "vectors")
    reach = max(abs(seen.get["low"] or 0), abs(seen.get["high"] or 0))
    if reach**2 * (seen.get["width"] or 0) >= 1 << 56:
        raise ValueError("scores would not fit 64 bits: choose a smaller scale")
    counted = F.count(F.lit(1)).alias("n")
    blocks = staged(candidate_blocks(prepared).observe(packed, counted), "vector-blocks")
    n_blocks = packed.get["n"]

    anchors = prepared.filter(F.col("id") % every == 0)
    unbounded = anchors.withColumn("bounds", F.lit(None).cast("array<long>"))
    found = staged(best_rows(blocks, n_blocks, unbounded, positives), "positives")
    # At most as many scores as an anchor has positives.
    bounds = found.groupBy(F.col("anchor_row").alias("row")).agg(
        F.collect_set("score").alias("bounds")
    )
    bounded = anchors.join(bounds, "row").select(*anchors.columns, "bounds")
    hard = best_rows(blocks, n_blocks, bounded, negatives, low, high).select(
        "anchor_row",
        F.col("bound").alias("positive_score"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    chosen = found.select(
        "anchor_row",
        "anchor_id",
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return chosen.join(hard, ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
