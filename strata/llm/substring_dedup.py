"""Removal of passages that an earlier document holds, by windows of words.

A window is ``window`` consecutive words. A word goes if it is covered by a window whose
words also start, in the same sequence, in a document with a smaller id.

First pass: each task reads its texts once and represents each run of windows by their
smallest hash of a few consecutive words (a function of the window alone, so equal windows
have equal representatives; about one for 20 windows). Counters of a count-min sketch are
summed per task and then merged; the sketch is a table of (row, cell, count) whose width
follows the input, spread over the cluster, never held in one place. Collisions and
representatives shared by different windows only raise an estimate, so every repeated
window is estimated repeated: none is lost.

Second pass: only runs estimated repeated in all rows of the sketch are taken from the
texts and grouped exactly, by a 128-bit digest of their words: first whole runs, which
takes copied passages together before they move, then the windows of the runs that no
earlier document holds whole. The least id of a group is joined back, and the texts
concerned are cut.

Texts that agree in all words are one text for all this: it belongs to the least id, and
the others, if they have a window at all, lose all their words.

Defined cases: a null text has no words; texts shorter than a window are kept whole; a
null id ranks above all ids; rows that repeat an id are judged by their own texts; equal
ids do not remove each other's words; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import chunks, staged

#: Stands for a null id: above all others.
NO_ID = (1 << 63) - 1
#: Words of the hashed shingle that represents a run of windows.
SHINGLE = 8
#: Rows of the sketch, and cells of a row for each representative.
ROWS, CELLS = 2, 4
_CHUNK = 1 << 20

_RNG = np.random.default_rng(50)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            size = np.uint64(len(self.up))
            up = np.uint64(pow(_BASE, int(size), 1 << 64))
            down = np.uint64(pow(_INVERSE, int(size), 1 << 64))
            self.up = np.concatenate([self.up, self.up * up])
            self.down = np.concatenate([self.down, self.down * down])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def representatives(
    lines: list[bytes], counts: np.ndarray, window: int, powers: Powers
) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same representative: document, hash, first and last start.

    ``lines`` hold the words of a text each, joined by one space; ``counts`` their number.
    """
    shingle = min(SHINGLE, window)
    lines = [line for line, count in zip(lines, counts, strict=True) if count]
    which = np.flatnonzero(counts)
    if not lines or counts.sum() < window:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    line = np.frombuffer(b" ".join(lines), np.uint8)
    powers.reach(len(line) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[line] * powers.up[: len(line)])])
    spaces = np.flatnonzero(line == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(line)]])
    a, b = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    least = _sliding_least(_mixed((sums[b] - sums[a]) * powers.down[a]), window - shingle + 1)
    sizes = counts[which]
    doc = np.repeat(which, sizes)[: len(least)]
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)[: len(least)]
    place = np.arange(len(least)) - begin
    inside = place + window <= counts[doc]
    doc, place, least = doc[inside], place[inside], least[inside]
    if not len(doc):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return doc[first], least[first].view(np.int64), place[first], place[last]


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def scan(docs: DataFrame, window: int) -> DataFrame:
    """Per row: id, n_words, sha (of its words), and its runs as arrays hash, first, last.

    The only pass over all texts beside the fetch of those with repeated windows.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for start, end in chunks(texts, _CHUNK):
                words = [(t or b"").split() for t in texts.slice(start, end - start).to_pylist()]
                lines = [b" ".join(w) for w in words]
                counts = np.array([len(w) for w in words])
                doc, least, first, last = representatives(lines, counts, window, powers)
                offsets = np.searchsorted(doc, np.arange(len(lines) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(counts, pa.int64()),
                        pa.array([hashlib.sha256(line).hexdigest() for line in lines]),
                        _lists(least, offsets, pa.int64()),
                        _lists(first, offsets, pa.int32()),
                        _lists(last, offsets, pa.int32()),
                    ],
                    ["id", "n_words", "sha", "hash", "first", "last"],
                )

    return docs.mapInArrow(
        compute,
        "id long, n_words long, sha string, hash array<long>, first array<int>, last array<int>",
    )


def _cell(row: int, width: int) -> Column:
    hashed = F.col("hash") if row == 0 else F.xxhash64("hash", F.lit(row))
    return hashed.bitwiseAND(F.lit(width - 1))


def sketch(runs: DataFrame, width: int) -> DataFrame:
    """Count-min counters that are not zero: row, cell, n; summed per task, then merged."""
    cells = F.array(
        *[F.struct(F.lit(r).alias("row"), _cell(r, width).alias("cell")) for r in range(ROWS)]
    )
    touched = runs.select(F.explode(cells).alias("c")).select("c.row", "c.cell")
    return touched.groupBy("row", "cell").agg(F.count("*").alias("n"))


def estimated_repeated(runs: DataFrame) -> DataFrame:
    """The runs whose representative the sketch counts at least twice in every row."""
    n = runs.count()
    width = 1 << max(10, (CELLS * n).bit_length())
    heavy = staged(sketch(runs, width).filter("n > 1").select("row", "cell"), "substring-heavy")
    for row in range(ROWS):
        of_row = heavy.filter(F.col("row") == row).select(F.col("cell").alias("_cell"))
        runs = runs.withColumn("_own", _cell(row, width))
        runs = runs.join(of_row, F.col("_own") == F.col("_cell"), "left_semi").drop("_own")
    return runs


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, text_key, text, runs`` of the texts wanted; text_key tells texts of one id apart.

    It is computed beside each document, so that many texts of one id do not meet in the join.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for start, end in chunks(texts, _CHUNK):
                given = texts.slice(start, end - start).to_pylist()
                lines = [b" ".join((text or b"").split()) for text in given]
                shas = pa.array([hashlib.sha256(line).hexdigest() for line in lines])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, end - start).columns, shas], ["id", "text", "sha"]
                )

    keyed = docs.select("id", "text").mapInArrow(compute, "id long, text string, sha string")
    keyed = keyed.select("id", F.xxhash64("sha").alias("text_key"), "text")
    found = wanted.join(keyed, ["id", "text_key"])
    return found.select("id", "text_key", "text", "runs")


def _digests(line: bytes, begin: list[int], end: list[int]) -> tuple[pa.Array, pa.Array]:
    digest = xxhash.xxh128_digest
    found = b"".join([digest(line[a:b]) for a, b in zip(begin, end, strict=True)])
    pair = np.frombuffer(found, "<i8").reshape(-1, 2)
    return pa.array(pair[:, 0]), pa.array(pair[:, 1])


def digests(texts: DataFrame, window: int, whole_runs: bool) -> DataFrame:
    """``id, text_key, first, last, d1, d2`` of each run, or of each window of the runs.

    A run's digest is over all words that its windows cover; a window is a run of its own.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(n).to_numpy() for n in (0, 1))
            for row in range(batch.num_rows):
                words = batch.column(2)[row].as_py().split()
                line = b" ".join(words)
                ends = np.cumsum([len(word) + 1 for word in words])
                runs = batch.column(3)[row].as_py()
                if whole_runs:
                    spans = np.unique([(run["first"], run["last"]) for run in runs], axis=0)
                    first, last = spans[:, 0], spans[:, 1]
                else:
                    spans = [np.arange(run["first"], run["last"] + 1) for run in runs]
                    first = last = np.unique(np.concatenate(spans))
                begin = np.concatenate([[0], ends])[first].tolist()
                end = (ends[last + window - 1] - 1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(first), ids[row])),
                        pa.array(np.full(len(first), keys[row])),
                        pa.array(first, pa.int32()),
                        pa.array(last, pa.int32()),
                        *_digests(line, begin, end),
                    ],
                    ["id", "text_key", "first", "last", "d1", "d2"],
                )

    given = texts.select("id", "text_key", F.col("text").cast("binary").alias("text"), "runs")
    return given.mapInArrow(
        compute, "id long, text_key long, first int, last int, d1 long, d2 long"
    )


def _least(rows: DataFrame) -> DataFrame:
    """Digests that several ids have, each with the least of them."""
    found = rows.groupBy("d1", "d2").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    return staged(found.filter("least < most").drop("most"), "substring-least")


def _cut(window: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, shas = [], []
            for row in range(batch.num_rows):
                words = batch.column(2)[row].as_py().encode().split()
                runs = batch.column(3)[row].values
                first, last = (runs.field(n).to_numpy(zero_copy_only=False) for n in (0, 1))
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, first, 1)
                np.add.at(edges, last + window, -1)
                kept = [words[k] for k in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]
                removed.append(len(words) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas)],
                ["id", "text_key", "n_removed", "cut_sha"],
            )

    return compute


def remove_repeats(
    docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 (of the kept words, space-joined)."""
    given = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_col).alias("text"),
    )
    scanned = staged(scan(given, window), "substring-scan")

    # One owner of each text: its least id. Rows of the owner are judged by windows.
    owners = staged(scanned.groupBy("sha").agg(F.min("id").alias("owner")), "substring-owners")
    owned = scanned.join(
        owners.select(F.col("owner").alias("id"), "sha"), ["id", "sha"], "left_semi"
    )
    runs = staged(
        owned.select(
            "id",
            F.xxhash64("sha").alias("text_key"),
            F.explode(F.arrays_zip("hash", "first", "last")).alias("run"),
        ).select("id", "text_key", "run.hash", "run.first", "run.last"),
        "substring-runs",
    )
    wanted = (
        estimated_repeated(runs)
        .groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    )
    texts = staged(_texts(given, wanted), "substring-texts")

    # A run whose words an earlier document holds in one piece is covered whole, and its
    # windows tell the others nothing new: that document has them all.
    whole = staged(digests(texts, window, whole_runs=True), "substring-whole")
    whole = whole.join(_least(whole), ["d1", "d2"], "left")
    whole = staged(whole.select("id", "text_key", "first", "last", "least"), "substring-judged")
    covered = whole.filter("id > least").select("id", "text_key", "first", "last")
    own = (
        whole.filter("least IS NULL OR id = least")
        .groupBy("id", "text_key")
        .agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    )
    own = staged(texts.drop("runs").join(own, ["id", "text_key"]), "substring-own")
    windows = digests(own, window, whole_runs=False)
    windows = windows.join(_least(windows), ["d1", "d2"]).filter("id > least")
    covered = covered.unionByName(windows.select("id", "text_key", "first", "last"))
    starts = covered.groupBy("id", "text_key").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    cut = texts.drop("runs").join(starts, ["id", "text_key"])
    cut = cut.mapInArrow(_cut(window), "id long, text_key long, n_removed long, cut_sha string")
    # Rows that repeat an id and text were cut alike.
    cut = staged(cut.dropDuplicates(["id", "text_key"]), "substring-cut")

    rows = scanned.select("id", "n_words", "sha").join(owners, "sha")
    rows = rows.withColumn("text_key", F.xxhash64("sha")).join(cut, ["id", "text_key"], "left")
    copy = (F.col("id") > F.col("owner")) & (F.col("n_words") >= window)
    return rows.select(
        F.when(F.col("id") < NO_ID, F.col("id")).alias(id_col),
        "n_words",
        F.when(copy, F.col("n_words"))
        .otherwise(F.coalesce("n_removed", F.lit(0)))
        .alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("cut_sha", "sha"))
        .alias("kept_sha256"),
    )
