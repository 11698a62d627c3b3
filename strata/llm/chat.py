"""Chat formatting with a loss mask aligned to token offsets.

A conversation is rendered whole, from its turns in order:

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>\\n

and encoded once, with the offsets of each token. The marks are special tokens, so no
token straddles a mark. The sorted spans of the turns' texts are then intersected with
the sorted token spans by binary search: a token bears loss if it overlaps the text of an
assistant turn, and ``loss_spans`` are the overlaps, in code points.

Inside roles and texts the strings that could be taken for marks are escaped: a backslash
is doubled, and ``<|`` becomes ``<\\|``. :func:`unescape` takes that back, so a rendered
conversation can be read back exactly (:func:`parse`).

Defined cases: null role or text counts as empty; an empty text is a turn without tokens;
turns with the same number are ordered by role, then text; repeated rows are turns of
their own; rows without conversation id are one conversation; an empty table gives an
empty result. A conversation is one training text, so it is rendered in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import chunks

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
AFTER = "\n"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
_TURN = re.compile(
    re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END) + AFTER, re.S
)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The formatted text, and the span of each turn's text in it with the role."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        parts += [head, body, END + AFTER]
        at = spans[-1][1] + len(END + AFTER)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    found = Tokenizer.from_file(path)
    found.add_special_tokens([AddedToken(mark, normalized=False) for mark in (START, SEP, END)])
    return found


def loss_mask(
    offsets: np.ndarray, spans: list[tuple[int, int, str]], role: str
) -> tuple[np.ndarray, list[list[int]]]:
    """Which tokens bear loss, and the loss-bearing spans of code points.

    ``offsets`` has the start and end of each token, in order. Tokens of one span follow
    each other; pieces of one character share its span.
    """
    mask, found = np.zeros(len(offsets), bool), []
    starts, ends = offsets[:, 0], offsets[:, 1]
    for begin, end, who in spans:
        if who != role or begin == end:
            continue
        first = int(np.searchsorted(ends, begin, "right"))
        last = int(np.searchsorted(starts, end, "left"))
        mask[first:last] = True
        reached = begin
        for a, b in offsets[first:last].tolist():
            a, b = max(a, reached), min(b, end)
            if a < b:
                if found and found[-1][1] == a and a > begin:
                    found[-1][1] = b
                else:
                    found.append([a, b])
                reached = b
    return mask, found


#: Bytes of text that are encoded at a time; a longer conversation is encoded alone.
_CHUNK = 1 << 20


def _runs(texts: pa.ListArray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lists of texts hold about ``most_bytes``."""
    sizes = pc.binary_length(texts.flatten()).to_numpy(zero_copy_only=False)
    held = np.concatenate([[0], np.cumsum(sizes)])
    counts = pc.list_value_length(texts).to_numpy(zero_copy_only=False)
    reached = held[np.concatenate([[0], np.cumsum(counts)])]
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(reached, reached[start] + most_bytes, "right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end
        start = end


SCHEMA = T.StructType(
    [
        T.StructField("formatted", T.StringType()),
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss", T.ArrayType(T.BooleanType())),
        T.StructField("loss_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


def formatted(
    rows: DataFrame,
    role: str = "assistant",
    tokenizer_path: str = TOKENIZER,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation: id, formatted, token_ids, loss (a flag per token), loss_spans."""
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    whole = rows.groupBy(F.col(id_col).alias("id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    whole = whole.select("id", "turns.role", "turns.text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        for batch in batches:
            for start, end in _runs(batch.column(2), _CHUNK):
                part = batch.slice(start, end - start)
                turns = zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
                rendered = [render(list(zip(*own, strict=True))) for own in turns]
                texts = [text for text, _ in rendered]
                encoded = encoder.encode_batch(texts, add_special_tokens=False)
                masks, found = [], []
                for (_, spans), one in zip(rendered, encoded, strict=True):
                    offsets = np.array(one.offsets, np.int64).reshape(-1, 2)
                    mask, loss_spans = loss_mask(offsets, spans, role)
                    masks.append(mask)
                    found.append(loss_spans)
                ends = np.cumsum([0, *map(len, masks)])
                ids = np.fromiter(
                    (i for one in encoded for i in one.ids), np.int32, int(ends[-1])
                )
                flags = np.concatenate(masks) if masks else np.empty(0, bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(texts, pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flags)),
                        pa.array(found, pa.list_(pa.list_(pa.int32()))),
                    ],
                    ["id", *SCHEMA.names],
                )

    done = whole.mapInArrow(compute, T.StructType([whole.schema["id"], *SCHEMA]))
    return done.withColumnRenamed("id", id_col)


def digest(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Read turns and loss text back from the output of :func:`formatted`.

    Returns id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens,
    n_loss_tokens.
    """
    given = conversations.select(id_col, "formatted", "loss_spans", "loss")
    fields = [
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_loss_tokens", T.LongType()),
    ]

    def read(text: str, spans: list[list[int]], loss: list[bool]) -> tuple:
        turns = parse(text)
        said = "".join(f"{role}\n{body}\n" for role, body in turns)
        masked = unescape("".join(text[a:b] for a, b in spans))
        return (
            len(turns),
            hashlib.sha256(said.encode()).hexdigest(),
            len(masked),
            hashlib.sha256(masked.encode()).hexdigest(),
            len(text),
            len(loss),
            sum(loss),
        )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in chunks(batch.column(1), 1 << 22):
                part = batch.slice(start, end - start)
                found = map(read, *(part.column(n).to_pylist() for n in (1, 2, 3)))
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, columns)],
                    [id_col, *[field.name for field in fields]],
                )

    return given.mapInArrow(compute, T.StructType([given.schema[id_col], *fields]))
