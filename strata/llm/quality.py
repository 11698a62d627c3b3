"""Quality rules: counts within a document, and lines that many documents share.

Within a document: words, symbols, repeated lines, and words in repeated windows of words.
A document fails the base rules if it has too few words or repeats too much of itself.

Across documents: lines are normalised (white space, ASCII case, digits) and hashed to 64
bits, and for each host the distinct documents of each line are counted. Lines in more
documents than the limits allow are templates and are removed; a document that loses more
than a share of its words, or keeps too few, is depleted and rejected. A host is any
column, such as the host of a url or the source. Copies of one text at a host are one
document: that a text was taken twice does not make its lines templates.

One pass over the texts stages, per document, its counts and its distinct lines as pairs
of arrays, about a tenth of the text. All else moves only those: copies of a text are
merged, lines are counted with partial sums before the shuffle, and the few lines above
the limits are joined back; Spark broadcasts them only if it finds them small, and splits
a hot line otherwise.

Defined cases: a null text has no words and fails; words are runs of anything but ASCII
white space; lines end at line feeds alone, and lines without a word do not count; null
hosts are one host; null and repeated ids are rows of their own; an empty table gives an
empty result; other columns are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks, staged

#: What counts as a symbol.
SYMBOLS = b"#*$%&|<>"

_CHUNK = 1 << 22
#: Bytes of a text that are split into words at a time.
_PIECE = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"
_NORMAL = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", b"abcdefghijklmnopqrstuvwxyz0000000000"
)


@dataclass(frozen=True)
class Rules:
    """Limits; shares are in percent."""

    least_words: int = 10
    #: Words of a window, and the most words that repeated windows may cover.
    window: int = 5
    most_repeated: int = 20
    #: A line is a template in more documents of its host than both of these.
    line_documents: int = 20
    line_share: float = 0.1
    #: A document is depleted if templates hold more of its words.
    most_removed: int = 50


def word_numbers(text: bytes) -> np.ndarray:
    """The words as numbers, equal words alike. A long text is split piece by piece."""
    table: dict[bytes, int] = {}
    parts, start = [np.empty(0, np.int64)], 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        words = text[start:end].split()
        parts.append(
            np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
        )
        start = end
    return np.concatenate(parts)


def repeated_words(numbers: np.ndarray, window: int) -> int:
    """Words inside windows that occur twice or more. Windows are compared exactly."""
    n = len(numbers) - window + 1
    if n < 2:
        return 0
    base, keys, reach = int(numbers.max()) + 1, numbers[:n], int(numbers.max()) + 1
    for k in range(1, window):
        if reach > (1 << 62) // base:  # number the parts anew, so that products fit
            keys = np.unique(keys, return_inverse=True)[1].astype(np.int64)
            reach = int(keys.max()) + 1
        keys, reach = keys * base + numbers[k : n + k], reach * base
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    starts = np.zeros(n, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    edges = np.zeros(len(numbers) + 1, np.int64)
    edges[:n] += starts
    edges[window : window + n] -= starts
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def lines(text: bytes) -> tuple[int, dict[int, int]]:
    """Lines that repeat an earlier one, and each normalised line's hash with its words."""
    seen, repeats, found, start = set(), 0, {}, 0
    while start <= len(text):
        end = text.find(b"\n", start)
        end = len(text) if end < 0 else end
        line = text[start:end]
        start = end + 1
        words = line.split()
        if not words:
            continue
        key = xxhash.xxh3_128_digest(line)
        repeats += key in seen
        seen.add(key)
        normal = xxhash.xxh64_intdigest(b" ".join(words).translate(_NORMAL))
        normal -= (normal >> 63) << 64
        found[normal] = found.get(normal, 0) + len(words)
    return repeats, found


def _counts(text: bytes, rules: Rules) -> tuple:
    bytes_of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    blank = int(bytes_of[list(_SPACES)].sum())
    chars = len(text) - int(bytes_of[0x80:0xC0].sum()) - blank
    numbers = word_numbers(text)
    repeats, found = lines(text)
    return (
        len(numbers),
        chars,
        int(bytes_of[list(SYMBOLS)].sum()),
        repeats,
        repeated_words(numbers, rules.window),
        list(found),
        list(found.values()),
    )


FEATURES = T.StructType(
    [
        *[
            T.StructField(name, T.LongType())
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        T.StructField("line", T.ArrayType(T.LongType())),
        T.StructField("words", T.ArrayType(T.LongType())),
    ]
)


def features(
    docs: DataFrame, rules: Rules, id_col: str, text_col: str, host_col: str
) -> DataFrame:
    """Per document: row, id, host, a digest of the text, and what is counted within it."""
    given = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(host_col).alias("host"),
        F.col(text_col).alias("text"),
    )
    kept = given.select("row", "id", "host").schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.binary())
            for start, end in chunks(texts, _CHUNK):
                part = [text or b"" for text in texts.slice(start, end - start).to_pylist()]
                columns = zip(*(_counts(text, rules) for text in part), strict=True)
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch[name].slice(start, end - start) for name in kept.names],
                        pa.array([xxhash.xxh3_128_digest(text) for text in part], pa.binary()),
                        *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    ],
                    [*kept.names, "digest", *FEATURES.names],
                )

    digest = T.StructField("digest", T.BinaryType())
    return given.mapInArrow(compute, T.StructType([*kept, digest, *FEATURES]))


def template_lines(found: DataFrame, rules: Rules) -> DataFrame:
    """(host, line, documents): the lines above both limits at their host."""
    # Equal texts have equal lines, so any of them stands for all.
    distinct = found.groupBy("host", "digest").agg(F.first("line").alias("line"))
    counted = distinct.select("host", F.explode("line").alias("line")).groupBy("host", "line")
    many = counted.agg(F.count("*").alias("documents"))
    many = many.filter(F.col("documents") > rules.line_documents)
    texts = found.select(F.col("host").alias("of"), "digest").distinct()
    sizes = texts.groupBy("of").agg(F.count("*").alias("size"))
    return (
        many.join(sizes, many["host"].eqNullSafe(sizes["of"]))
        .filter(F.col("documents") * 100.0 > F.col("size") * F.lit(float(rules.line_share)))
        .select("host", "line", "documents")
    )


def verdicts(
    docs: DataFrame,
    rules: Rules = Rules(),
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """A row per document: id, the counts, n_removed (words in template lines),
    base_failed, depleted, kept."""
    found = staged(features(docs, rules, id_col, text_col, host_col), "quality")
    templates = staged(template_lines(found, rules), "templates")
    templates = templates.select(F.col("host").alias("of"), F.col("line").alias("template"))
    pairs = found.select("row", "host", F.explode(F.arrays_zip("line", "words")).alias("one"))
    pairs = pairs.select("row", "host", "one.line", "one.words")
    on = pairs["line"].eqNullSafe(templates["template"]) & pairs["host"].eqNullSafe(templates["of"])
    removed = (
        pairs.join(templates, on, "left_semi")
        .groupBy("row")
        .agg(F.sum("words").alias("n_removed"))
        .withColumnRenamed("row", "at")
    )
    n_words, gone = F.col("n_words"), F.coalesce("n_removed", F.lit(0).cast("long"))
    return (
        found.drop("line", "words", "digest")
        .join(removed, F.col("row") == F.col("at"), "left")
        .select(
            F.col("id").alias(id_col),
            *FEATURES.names[:5],
            gone.alias("n_removed"),
            base_failed(rules).alias("base_failed"),
            (
                (gone * 100 > n_words * rules.most_removed)
                | (n_words - gone < rules.least_words)
            ).alias("depleted"),
        )
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )


def base_failed(rules: Rules) -> Column:
    few = F.col("n_words") < rules.least_words
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.most_repeated)
