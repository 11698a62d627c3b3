from __future__ import annotations

import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import quality
from strata.llm.quality import Rules

from tests.llm.helpers import SCHEMA, WORD, frame, odd_rows, prose, words

TABLE = str.maketrans(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000"
)


def repeated(found, window=5):
    windows = [tuple(found[i : i + window]) for i in range(len(found) - window + 1)]
    counts = Counter(windows)
    covered = {
        i + k for i, key in enumerate(windows) if counts[key] > 1 for k in range(window)
    }
    return len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40), st.integers(1, 6))
def test_repeated_words(letters, window):
    numbers = quality.word_numbers(" ".join(letters).encode())
    assert quality.repeated_words(numbers, window) == repeated(letters, window)


def test_many_words_are_numbered_anew():
    rng = random.Random(2)
    found = [str(rng.randrange(50_000)) for _ in range(60_000)]
    found[40_000:40_100] = found[100:200]
    numbers = quality.word_numbers(" ".join(found).encode())
    assert quality.repeated_words(numbers, 5) == repeated(found)


def test_long_texts_are_split_between_words(monkeypatch):
    text = prose(random.Random(1), 500).encode()
    whole = quality.word_numbers(text)
    monkeypatch.setattr(quality, "_PIECE", 7)
    assert (quality.word_numbers(text) == whole).all()


def expected(rows, rules):
    """The report of each row, in plain Python."""
    lines = []
    for _, text, _, source, _ in rows:
        own = [line for line in (text or "").split("\n") if WORD.search(line)]
        lines.append([(line, " ".join(WORD.findall(line)).translate(TABLE)) for line in own])
    documents, texts = defaultdict(set), defaultdict(set)
    for (_, text, _, source, _), own in zip(rows, lines, strict=True):
        texts[source].add(text or "")
        for _, normal in own:
            documents[source, normal].add(text or "")
    told = []
    for (id_, text, _, source, _), own in zip(rows, lines, strict=True):
        found, text = words(text), text or ""
        gone = sum(
            len(words(line))
            for line, normal in own
            if len(documents[source, normal]) > rules.line_documents
            and len(documents[source, normal]) * 100.0 > len(texts[source]) * rules.line_share
        )
        n, again = len(found), repeated(found, rules.window)
        failed = n < rules.least_words or again * 100 > n * rules.most_repeated
        depleted = gone * 100 > n * rules.most_removed or n - gone < rules.least_words
        told.append(
            (
                id_,
                n,
                sum(map(len, found)),
                sum(text.count(c) for c in "#*$%&|<>"),
                len(own) - len({line for line, _ in own}),
                again,
                gone,
                failed,
                not failed and not depleted,
            )
        )
    return Counter(told)


NAMES = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_removed", "base_failed", "kept",
)


def told(df):
    return Counter(tuple(row[n] for n in NAMES) for row in df.collect())


def templated(seed=4):
    """Documents around template lines, some of them of little else; one hot source."""
    rng = random.Random(seed)
    template = ["Licensed under X %d." % n for n in range(3)] + ["All  Rights\tReserved"]
    rows = []
    for n in range(90):
        own = [prose(rng, rng.randint(1, 12)) for _ in range(rng.randint(0, 4))]
        lines = own + [rng.choice(template) for _ in range(rng.randint(0, 6))]
        rng.shuffle(lines)
        source = rng.choice(["hot", "hot", None, "b"])
        rows.append((n, "\n".join(lines), None, source, None))
    copied = (prose(rng, 30) + "\n" + prose(rng, 15), None, "hot", None)
    return rows + [(200 + n, *copied) for n in range(40)]


def test_against_plain_python(spark):
    rows = templated() + odd_rows()
    for rules in (Rules(line_documents=5, line_share=3.0), Rules(window=3, most_removed=90)):
        found = told(quality.verdicts(frame(spark, rows), rules))
        assert found == expected(rows, rules)


def test_templates_go_by_host_and_copies_are_one_document(spark):
    rows, rules = templated(), Rules(line_documents=5, line_share=3.0)
    found = quality.verdicts(frame(spark, rows), rules).collect()
    by_id = {row.doc_id: row for row in found}
    assert all(by_id[200 + n].kept and not by_id[200 + n].n_removed for n in range(40))
    assert any(row.depleted and not row.base_failed for row in found)
    assert any(row.kept and row.n_removed for row in found)


def test_columns_of_any_name(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    for name in ("row", "host", "digest", "line", "words", "template", "of", "at", "n_words"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    assert told(quality.verdicts(docs)) == expected(rows, Rules())


def test_empty(spark):
    assert quality.verdicts(spark.createDataFrame([], SCHEMA)).count() == 0
