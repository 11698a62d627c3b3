from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat

texts = st.text(
    st.one_of(st.sampled_from("<|\\>\n a"), st.characters(exclude_categories=["Cs"])), max_size=30
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(texts, st.one_of(texts, st.just(chat.END + chat.START))), max_size=4))
def test_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    for (role, text), (a, b, who) in zip(turns, spans, strict=True):
        assert role == who and chat.unescape(formatted[a:b]) == text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), texts), max_size=4))
def test_loss_covers_assistant_texts_alone(turns):
    formatted, spans = chat.render(turns)
    encoded = chat.tokenizer(chat.TOKENIZER).encode(formatted, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    mask, found = chat.loss_mask(offsets, spans, "assistant")
    assert chat.unescape("".join(formatted[a:b] for a, b in found)) == "".join(
        text for role, text in turns if role == "assistant"
    )
    for (a, b), flag in zip(offsets.tolist(), mask, strict=True):
        inside = any(r == "assistant" and a < y and x < b for x, y, r in spans)
        assert flag == inside  # no token straddles a mark


def told(rows):
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return (
        len(rows),
        hashlib.sha256(said.encode()).hexdigest(),
        len(loss),
        hashlib.sha256(loss.encode()).hexdigest(),
    )


def test_odd_conversations(spark):
    long = "word " * 20_000
    rows = [
        (1, 0, "user", None),
        (1, 1, "assistant", ""),
        (1, 2, "assistant", "\n\n  <|im_sep|> \\ é🦆"),
        (2, 5, None, "no role"),
        (2, 5, "assistant", "tie"),
        (2, None, "system", "null turn"),
        (3, 0, "assistant", long),
        (None, 0, "user", "no id"),
        (4, 0, "user", "again"),
        (4, 0, "user", "again"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS id", "'y' AS formatted")
    found = {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
        for r in chat.digest(chat.formatted(table)).collect()
    }
    pairs = lambda *turns: told(list(turns))
    assert found == {
        1: pairs(("user", ""), ("assistant", ""), ("assistant", "\n\n  <|im_sep|> \\ é🦆")),
        2: pairs(("system", "null turn"), ("", "no role"), ("assistant", "tie")),
        3: pairs(("assistant", long)),
        4: pairs(("user", "again"), ("user", "again")),
        None: pairs(("user", "no id")),
    }


def test_output_has_a_flag_per_token(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "hi there"), (1, 1, "assistant", "good day")]
    row = chat.formatted(spark.createDataFrame(rows, schema)).first()
    assert len(row.token_ids) == len(row.loss) > sum(row.loss) > 0
    encoder = chat.tokenizer(chat.TOKENIZER)
    loss = [t for t, flag in zip(row.token_ids, row.loss, strict=True) if flag]
    assert encoder.decode(loss, skip_special_tokens=False) == "good day"


def test_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.formatted(table)).count() == 0


@pytest.mark.parametrize("text", ["<|", "\\<|", "\\\\", "<\\|", "<|im_end|>"])
def test_escapes(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
