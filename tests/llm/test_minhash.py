from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import minhash
from strata.llm.queries import QUERIES

from tests.llm.helpers import SCHEMA, SF, documents, frame, odd_rows, prose, union_find, words


def shingles(text):
    found = words(text)
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def classes(texts, threshold=0.8):
    """Texts to the first text reached, over all pairs."""
    sets = [shingles(text) for text in texts]
    pairs = [
        (a, b)
        for a in range(len(texts))
        for b in range(a)
        if jaccard(sets[a], sets[b]) >= threshold
    ]
    return union_find(pairs, range(len(texts)))


def test_query(spark):
    rows = sorted((row.doc_id, row.text or "") for row in documents(spark).collect())
    found = {row.doc_id: row for row in QUERIES["op8_minhash"](spark, SF).collect()}
    assert len(found) == len(rows)
    root = classes([text for _, text in rows])
    errors = []
    for n, (id_, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        row = found[id_]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors.append(abs(row.near_edited - jaccard(shingles(text), shingles(changed))))
        errors.append(abs(row.near_next - jaccard(shingles(text), shingles(after))))
        assert row.class_id == rows[root[n]][0]
    assert np.mean(errors) < 0.06 and max(errors) < 0.3


def test_odd_rows(spark):
    rows = odd_rows()
    found = minhash.report(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    of_text = defaultdict(set)
    texts = {(row[0], len(row[1] or "")): row[1] or "" for row in rows}
    for row in found:
        of_text[texts[row.doc_id, row.n_chars]].add(row.fingerprint)
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert all(len(prints) == 1 for prints in of_text.values())
    distinct = sorted({(row[0], row[1] or "") for row in rows if row[0] is not None})
    root = classes([text for _, text in distinct])
    wanted = {id_: distinct[root[n]][0] for n, (id_, _) in enumerate(distinct)}
    for row in found:
        if row.doc_id is not None:
            assert row.class_id == wanted[row.doc_id]


@pytest.mark.parametrize("partitions", ["1", "9"])
def test_each_document_meets_its_successor(spark, partitions):
    rows = [(7 * n, f"text number {n} " * (n % 5)) for n in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {row.id: row for row in minhash.fingerprints(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for n, (id_, text) in enumerate(rows):
        changed = minhash.edited(text, rows[(n + 1) % len(rows)][1])
        assert found[id_].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()


def test_tiles_lose_no_link(spark):
    base = " ".join(f"w{n}" for n in range(200))
    rows = [(n, base.replace(f"w{n} ", f"x{n} ", 1)) for n in range(0, 150)]
    rows += [(1000 + n, f"alone {n} " + " ".join(f"{n}v{k}" for k in range(30))) for n in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, bucket_rows=4).collect()
    root = classes([text for _, text in rows])
    assert {r.id: r.class_id for r in found} == {
        id_: rows[root[n]][0] for n, (id_, _) in enumerate(rows)
    }


def test_texts_without_ids_of_their_own_stay_apart(spark):
    """A third of the rows without an id, some ids shared by unlike texts."""
    rng = random.Random(6)
    base = [prose(rng, 60) for _ in range(40)]
    rows = [(n, text) for n, text in enumerate(base)]
    rows += [(None, base[n] + " more") for n in range(0, 40, 4)]  # near copies of some
    rows += [(None, prose(rng, 60)) for _ in range(20)]  # like none
    rows += [(3, prose(rng, 60)), (3, prose(rng, 60)), (5, base[9] + " end")]
    rows += [(None, base[0] + " more")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minhash.near_duplicates(docs).collect()
    distinct = sorted({text for _, text in rows})
    root, least = classes(distinct), defaultdict(lambda: minhash.NO_ID)
    place = {text: root[n] for n, text in enumerate(distinct)}
    for id_, text in rows:
        if id_ is not None:
            least[place[text]] = min(least[place[text]], id_)
    wanted = {hashlib.sha256(t.encode()).digest(): least[place[t]] for t in distinct}
    assert {bytes(row.text_sha256): row.class_id for row in found} == wanted
    report = minhash.report(docs).collect()
    assert len(report) == len(rows)
    assert sum(row.class_id is None for row in report) == 20


def test_only_texts_of_shared_bands_are_shuffled(spark, monkeypatch):
    """Few near copies among many texts that are like none; no side is small enough to broadcast."""
    rng = random.Random(9)
    rows = [(n, prose(rng, 60)) for n in range(300)]
    rows += [(1000 + n, rows[n][1] + " more") for n in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, staged = [], minhash.staged

    def noted(df, label):
        if label == "minhash-texts":
            df.collect()
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            plans.append(df._jdf.queryExecution().explainString(mode))
        return staged(df, label)

    monkeypatch.setattr(minhash, "staged", noted)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        found = {row.id: row.class_id for row in minhash.near_duplicates(docs).collect()}
    finally:
        spark.conf.set(threshold, before)
    assert found == {id_: id_ % 1000 for id_, _ in rows}
    (plan,) = plans
    final = plan[: plan.index("== Initial Plan ==")]
    shuffled = re.findall(r"ShuffleQueryStage.*rowCount=([\dE.+]+)", final)
    assert shuffled and max(map(float, shuffled)) < 100


def test_empty(spark):
    assert minhash.report(spark.createDataFrame([], SCHEMA)).count() == 0
