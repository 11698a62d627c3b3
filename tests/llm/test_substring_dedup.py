from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import substring_dedup
from strata.llm.queries import QUERIES

from tests.llm.helpers import SCHEMA, SF, documents, frame, odd_rows, prose, words


def expected(rows, window):
    first = {}
    for id_, text in rows:
        found = words(text)
        for s in range(len(found) - window + 1):
            key = tuple(found[s : s + window])
            id_key = float("inf") if id_ is None else id_
            first[key] = min(first.get(key, id_key), id_key)
    told = []
    for id_, text in rows:
        found = words(text)
        mask = np.zeros(len(found), bool)
        for s in range(len(found) - window + 1):
            if first[tuple(found[s : s + window])] < (float("inf") if id_ is None else id_):
                mask[s : s + window] = True
        kept = " ".join(w for w, gone in zip(found, mask, strict=True) if not gone)
        told.append(
            (id_, len(found), int(mask.sum()), hashlib.sha256(kept.encode()).hexdigest())
        )
    return Counter(told)


def told(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("window", [50, 5])
def test_odd_rows(spark, window):
    rows = odd_rows()
    found = substring_dedup.remove_repeats(frame(spark, rows), window)
    assert told(found) == expected([row[:2] for row in rows], window)


def test_passages_that_many_share(spark):
    rng = random.Random(2)
    passages = [prose(rng, 80) for _ in range(3)]
    rows = []
    for n in range(120):
        parts = [prose(rng, rng.randint(0, 60)), rng.choice(passages), prose(rng, 30)]
        rows.append((n, "\n".join(parts)))
    rows += [(500, rows[0][1]), (7, rows[3][1]), (7, prose(rng, 90))]  # repeated ids
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = told(substring_dedup.remove_repeats(docs, 50))
    wanted = expected(rows, 50)
    assert found == wanted
    assert sum(row[2] > 0 for row in wanted) > 100


def test_many_texts_without_id(spark):
    """They do not meet each other when the texts are fetched."""
    rng = random.Random(4)
    passage = prose(rng, 60)
    rows = [(None, f"{prose(rng, 20)} {passage}") for _ in range(40)] + [(1, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert told(substring_dedup.remove_repeats(docs, 50)) == expected(rows, 50)
    wanted = "id long, text_key long, runs array<struct<first:int,last:int>>"
    found = substring_dedup._texts(
        docs.selectExpr("doc_id AS id", "text"), spark.createDataFrame([], wanted)
    )
    plan = found._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and "text_key" in joins[0]


def test_query(spark):
    rows = [(row.doc_id, row.text) for row in documents(spark).collect()]
    assert told(QUERIES["op7_substring_dedup"](spark, SF)) == expected(rows, 50)


def test_equal_windows_have_equal_representatives():
    rng = random.Random(9)
    passage = prose(rng, 70)
    lines = [f"{prose(rng, n)} {passage} {prose(rng, n)}".encode() for n in (1, 13, 40)]
    counts = np.array([len(line.split()) for line in lines])
    doc, least, first, last = substring_dedup.representatives(
        lines, counts, 50, substring_dedup.Powers()
    )
    of = {}
    for d, h, a, b in zip(doc, least, first, last, strict=True):
        for s in range(a, b + 1):
            of[d, s] = h
    for start, doc_number in ((1, 0), (13, 1), (40, 2)):
        assert [of[doc_number, start + k] for k in range(21)] == [of[0, 1 + k] for k in range(21)]
    assert all((d, s) in of for d in range(3) for s in range(counts[d] - 49))


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeats(docs).count() == 0
