"""Document fingerprints by MinHash, and near-duplicates by bands of them.

A fingerprint holds the least value of each of ``PERMUTATIONS`` universal hash functions
over the document's shingles of five words, computed in numpy for many documents at once.
The share of equal values estimates the Jaccard similarity of two documents.

:func:`fingerprints` also edits each text (its second half replaced by the start of the
next document) and compares. Documents go to ranges of ids, each closed by a copy of the
next range's first document, so a task meets every document with its successor; texts are
compressed before they move. The bounds of the ranges, four per shuffle partition, pass
the driver; they are taken from a sample of about twenty ids each.

:func:`near_duplicates` joins on bands of the fingerprint. Equal texts are one node. Of
bands that hold the same nodes one is kept, and a bucket of more than ``bucket_rows``
nodes is dealt over tiles in which each pair of its chunks meets. The texts of nodes that
share a band are fetched: a broadcast bitmap of fixed size drops most other rows before
they move, and a join on id and digest the rest. Inside a bucket the exact Jaccard
similarity decides; only a spanning star of each local component is emitted, not the pairs.

Defined cases: a null text counts as empty; a text of fewer words than a shingle is one
shingle, a text without words has none, a fingerprint of largest values, and is like
others without words; null ids come after all others; rows that repeat an id follow each
other in a fixed order; classes are of texts, so unlike texts that share an id, or have
none, are apart, and a class without any id has none; the only document is its own
successor; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks, staged
from strata.llm.components import components

SHINGLE, PERMUTATIONS = 5, 64
BANDS, BAND_ROWS = 16, 4
#: Ids that are looked at to bound each range of ids.
PER_RANGE = 20
#: Stands for a null id: after all others.
NO_ID = (1 << 63) - 1
#: Bits of the bitmap of wanted texts, in words of 64: at most 262,144 rows are broadcast.
MARKS = 1 << 24
_CHUNK = 1 << 20

_RNG = np.random.default_rng(64)
_MULTIPLY = _RNG.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 64, PERMUTATIONS, dtype=np.uint64)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), 1 << 64))])
    return found


class Powers:
    """Powers of the base and its inverse modulo 2^64, kept from call to call."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, and how many each text has."""
    words = [text.split() for text in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    line = np.frombuffer(b" ".join([b" ".join(w) for w in words if w]), np.uint8)
    counts = np.where(sizes == 0, 0, np.maximum(sizes - SHINGLE + 1, 1))
    if not len(line):
        return np.empty(0, np.uint64), counts
    powers.reach(len(line) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[line] * powers.up[: len(line)])])
    spaces = np.flatnonzero(line == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(line)]])
    before = np.cumsum(sizes) - sizes
    first = np.repeat(before - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    last = first + np.repeat(np.minimum(sizes, SHINGLE), counts) - 1
    a, b = starts[first], ends[last]
    return _mixed((sums[b] - sums[a]) * powers.down[a]), counts


def signatures(texts: list[bytes], powers: Powers) -> np.ndarray:
    """A row of PERMUTATIONS least values for each text."""
    hashes, counts = shingle_hashes(texts, powers)
    found = np.full((len(texts), PERMUTATIONS), np.iinfo(np.uint32).max, np.uint32)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        for n in range(PERMUTATIONS):
            permuted = ((hashes * _MULTIPLY[n] + _ADD[n]) >> np.uint64(32)).astype(np.uint32)
            found[some, n] = np.minimum.reduceat(permuted, starts)
    return found


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> tuple[list[int], dict[int, int]]:
    """Bounds of the id ranges; of each range's first id, the range before, in a ring."""
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / n for k in range(1, n)]
    ids = docs.select("id")
    # Bounds need not be exact: some ids per range are enough, however many rows there are.
    fraction = PER_RANGE * n / max(1, ids.count())
    some = ids.sample(fraction, seed=8) if fraction < 1 else ids
    bounds = some.agg(F.percentile_approx("id", shares, 10 * n).alias("b")).first().b
    bounds = sorted(set(bounds or []))
    number = F.lit(0)
    if bounds:
        below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("id"))
        number = F.size(below)
    firsts = docs.groupBy(number.alias("range")).agg(F.min("id").alias("first")).collect()
    firsts = sorted((row["range"], row["first"]) for row in firsts)
    return bounds, {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}


def _dealt(docs: DataFrame, bounds: list[int], before: dict[int, int]) -> DataFrame:
    """``range, tail, id, text`` (compressed); a range's first id is also the tail before it."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        edges, firsts = np.array(bounds, np.int64), np.array(list(before), np.int64)
        to = np.array(list(before.values()), np.int64)
        order = np.argsort(firsts)
        firsts, to = firsts[order], to[order]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = [press.compress(t or b"") for t in batch.column(1).to_pylist()]
            number = np.searchsorted(edges, ids, "left")
            at = np.searchsorted(firsts, ids)
            tails = np.flatnonzero(firsts[np.minimum(at, len(firsts) - 1)] == ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([number, to[at[tails]]]), pa.int64()),
                    pa.array(np.arange(len(ids) + len(tails)) >= len(ids)),
                    pa.array(np.concatenate([ids, ids[tails]])),
                    pa.array(texts + [texts[k] for k in tails], pa.binary()),
                ],
                ["range", "tail", "id", "text"],
            )

    given = docs.select("id", F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(compute, "range long, tail boolean, id long, text binary")


_PRINT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text_sha256", T.BinaryType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("signature", T.BinaryType()),
        T.StructField("edited_signature", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def _compared(ids: list[int], texts: list[str], powers: Powers) -> pa.RecordBatch:
    """Of all texts but the last, which only follows."""
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:], strict=False)]
    plain = [text.encode() for text in texts]
    own = signatures(plain, powers)
    other = signatures(changed, powers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([hashlib.sha256(text).digest() for text in plain[:-1]], pa.binary()),
            pa.array([len(text) for text in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(text).hexdigest() for text in changed]),
            pa.array([row.astype(">u4").tobytes() for row in own[:-1]], pa.binary()),
            pa.array([row.astype(">u4").tobytes() for row in other], pa.binary()),
            pa.array((own[:-1] == other).mean(1)),
            pa.array((own[:-1] == own[1:]).mean(1)),
        ],
        _PRINT.names,
    )


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted ranges, holding about ``_CHUNK`` characters and one text more."""
    powers, open_ = Powers(), zstandard.ZstdDecompressor()
    ids: list[int] = []
    texts: list[str] = []
    number, held, closed = None, 0, False
    for batch in batches:
        for row in range(batch.num_rows):
            range_, tail, id_ = (batch.column(n)[row].as_py() for n in range(3))
            if range_ != number:
                ids, texts, number, held, closed = [], [], range_, 0, False
            if closed:
                continue
            text = open_.decompress(batch.column(3)[row].as_py()).decode()
            ids.append(id_)
            texts.append(text)
            held += len(text)
            if len(texts) > 1 and (tail or held > _CHUNK):
                yield _compared(ids, texts, powers)
                ids, texts, held, closed = ids[-1:], texts[-1:], len(text), tail


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id (NO_ID for null), text_sha256, n_chars, edited_sha256, the signatures of
    the text and the edited text, and the likeness to the edited and to the next text."""
    given = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(text_col).alias("text"),
    )
    bounds, before = _ranges(given)
    if not before:
        return given.sparkSession.createDataFrame([], _PRINT)
    keys = ["range", "tail", "id", "text"]
    dealt = _dealt(given, bounds, before).repartition("range").sortWithinPartitions(*keys)
    return dealt.mapInArrow(_prints, _PRINT)


def _hit_buckets(nodes: DataFrame, bucket_rows: int) -> DataFrame:
    """``band, value, i, j, node``: buckets of at least two nodes, one for each node set."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    width = 4 * BAND_ROWS
    rows = nodes.select("node", "signature", F.explode(bands).alias("band")).select(
        "node",
        "band",
        F.xxhash64(F.substr("signature", F.col("band") * width + 1, F.lit(width))).alias("value"),
    )
    rows = staged(rows, "minhash-bands")
    sizes = rows.groupBy("band", "value").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("set"),
        F.min("node").alias("least"),
    )
    kept = (
        sizes.filter("n > 1")
        .groupBy("n", "set", "least")
        .agg(F.min(F.struct("band", "value")).alias("of"))
        .select("of.band", "of.value", "n")
    )
    kept = staged(kept, "minhash-buckets")
    k = F.ceil(F.col("n") / bucket_rows).cast("int")
    chunk = F.pmod(F.xxhash64("node", F.lit(7)), k).cast("int")
    return (
        rows.join(kept, ["band", "value"])
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), k - 1)))
        .select(
            "band",
            "value",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            "node",
        )
    )


def _stars(nodes: np.ndarray, texts: list[bytes], threshold: float, powers: Powers) -> list[tuple]:
    """A spanning star of each component of texts with Jaccard similarity of the threshold."""
    hashes, counts = shingle_hashes(texts, powers)
    owner = np.repeat(np.arange(len(texts)), counts)
    values, codes = np.unique(hashes, return_inverse=True)
    pairs = np.unique(owner * np.int64(max(1, len(values))) + codes)
    owner, codes = np.divmod(pairs, max(1, len(values)))
    sizes = np.bincount(owner, minlength=len(texts))
    starts = np.searchsorted(owner, np.arange(len(texts)))
    left, stars = np.arange(len(texts)), []
    while len(left) > 1:
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            one = front.pop()
            mark = np.zeros(len(values) + 1, bool)
            mark[codes[starts[one] : starts[one] + sizes[one]]] = True
            common = np.bincount(owner[mark[codes]], minlength=len(texts))[left]
            either = sizes[one] + sizes[left] - common
            near = common >= threshold * either
            found, left = left[near], left[~near]
            stars += [(nodes[k], nodes[root]) for k in found]
            front.extend(found)
    return stars


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column compressed."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        *others, texts = batch.columns
        pressed = pa.array([press.compress(text) for text in texts.to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*others, pressed], batch.schema.names)


def _texts_of(given: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` (compressed) of the rows whose ``least_id, text_sha256`` are wanted."""
    keys = ["least_id", "text_sha256"]
    mark = F.pmod(F.xxhash64(*keys), F.lit(MARKS))
    word, bit = F.shiftright(mark, 6), F.expr("shiftleft(1L, cast(mark & 63 AS int))")
    marked = wanted.withColumn("mark", mark).select(word.alias("word"), bit.alias("bit"))
    marks = F.broadcast(marked.groupBy("word").agg(F.bit_or("bit").alias("bits")))
    maybe = (
        given.withColumn("mark", mark)
        .withColumn("word", word)
        .join(marks, "word")
        .filter(F.col("bits").bitwiseAND(bit) != 0)
        .select(*keys, "text")
    )
    pressed = maybe.mapInArrow(_pressed, "least_id long, text_sha256 binary, text binary")
    return pressed.join(wanted, keys).select("node", "text")


def near_duplicates(
    docs: DataFrame,
    prints: DataFrame | None = None,
    threshold: float = 0.8,
    bucket_rows: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, text_sha256, class_id`` of each distinct id and text.

    ``class_id`` is the least id that links of Jaccard similarity reach; NO_ID if none has one.
    """
    prints = staged(fingerprints(docs, id_col, text_col), "prints") if prints is None else prints
    texts = prints.select("id", "text_sha256", "signature")
    # A node is a distinct text, numbered as it is written; its least id is told beside it.
    owners = texts.groupBy("text_sha256", "signature").agg(F.min("id").alias("least_id"))
    owners = owners.withColumn("node", F.monotonically_increasing_id())
    owners = staged(owners, "minhash-owners")
    hit = staged(_hit_buckets(owners, bucket_rows), "minhash-hit")
    named = owners.select("node", "text_sha256", "least_id")
    wanted = staged(hit.select("node").distinct().join(named, "node"), "minhash-wanted")
    text = F.coalesce(text_col, F.lit("")).cast("binary")
    given = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("least_id"),
        F.unhex(F.sha2(text, 256)).alias("text_sha256"),
        text.alias("text"),
    )
    fetched = staged(_texts_of(given, wanted), "minhash-texts")
    # Rows that repeat id and text, or a text without id, are fetched more than once.
    if fetched.count() > wanted.count():
        fetched = fetched.dropDuplicates(["node"])
    keys = ["band", "value", "i", "j"]
    met = hit.join(fetched, "node").repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, open_ = Powers(), zstandard.ZstdDecompressor()
        bucket, nodes, held = None, [], []

        def stars() -> Iterator[pa.RecordBatch]:
            found = _stars(np.array(nodes, np.int64), held, threshold, powers)
            if found:
                a, b = (pa.array(side, pa.int64()) for side in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

        for batch in batches:
            for row in range(batch.num_rows):
                own = tuple(batch.column(n)[row].as_py() for n in range(4))
                if own != bucket:
                    yield from stars()
                    bucket, nodes, held = own, [], []
                nodes.append(batch.column(4)[row].as_py())
                held.append(open_.decompress(batch.column(5)[row].as_py()))
        yield from stars()

    edges = met.select(*keys, "node", "text").mapInArrow(compare, "a long, b long")
    roots = components(edges)
    rooted = staged(
        named.join(roots, "node", "left").select(
            "text_sha256", "least_id", F.coalesce("root", "node").alias("root")
        ),
        "minhash-rooted",
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("class_id"))
    classes = staged(rooted.join(least, "root").select("text_sha256", "class_id"), "minhash-classes")
    return texts.select("id", "text_sha256").distinct().join(classes, "text_sha256")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints, edits and likenesses of each row, with the class of near-duplicates."""
    prints = staged(fingerprints(docs, id_col, text_col), "prints")
    classes = near_duplicates(docs, prints, id_col=id_col, text_col=text_col)
    classes = staged(classes, "minhash-classed")
    return prints.join(classes, ["id", "text_sha256"]).select(
        F.when(F.col("id") < NO_ID, F.col("id")).alias(id_col),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("signature")).alias("fingerprint"),
        F.lower(F.hex("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(F.col("class_id") < NO_ID, F.col("class_id")).alias("class_id"),
    )
