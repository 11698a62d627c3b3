from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity

from tests.llm.helpers import SCHEMA, frame, odd_rows, prose

BAD = ["grobia", "grobis", "vexu"]


def made(n, seed):
    """Half of the texts hold two words of a stem, with endings of their own."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        found = prose(rng, rng.randint(20, 150)).split()
        if k % 2:
            for _ in range(2):
                found.insert(rng.randrange(len(found)), rng.choice(BAD) + rng.choice("abcdef"))
        rows.append((k, " ".join(found), k % 2))
    return rows


@pytest.fixture(scope="module")
def network():
    rows = made(500, 1)
    return toxicity.train([r[1] for r in rows], [r[2] for r in rows], 0.3)


def test_held_out_accuracy(network):
    rows = made(300, 2)
    scores = toxicity.worst_windows(network, [r[1] for r in rows])
    label = np.array([r[2] for r in rows], bool)
    assert ((scores >= toxicity.THRESHOLD) == label).mean() > 0.95


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    network = toxicity.Network(1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    toxicity_float, toxicity._FLOAT = toxicity._FLOAT, np.float64
    try:
        x = rng.standard_normal((9, 2 * toxicity.EMBEDDING))
        ids = rng.integers(0, 9, (4, 12))
        label = np.array([0.0, 1.0, 1.0, 0.0])

        def loss():
            gates = {way: network._gates(x, way) for way in ("ahead", "back")}
            logit = network.logits(gates, ids).astype(np.float64)
            return (np.logaddexp(0, logit) - label * logit).mean()

        g, d_x = network.gradients(x, ids, label)
        for value, slope in [(network.p[k], g[k]) for k in g] + [(x, d_x)]:
            for at in rng.integers(0, value.size, 5):
                spot = np.unravel_index(at, value.shape)
                old, step = value[spot], 1e-5
                value[spot] = old + step
                up = loss()
                value[spot] = old - step
                found = (up - loss()) / (2 * step)
                value[spot] = old
                assert abs(found - slope[spot]) < 1e-6
    finally:
        toxicity._FLOAT = toxicity_float


@pytest.mark.parametrize("n", [0, 1, 39, 40, 41, 69, 70, 71, 100, 1000])
def test_windows_cover_the_text(n):
    found = toxicity.windows(np.arange(1, n + 1))
    assert set(found.ravel()) - {0} == set(range(1, n + 1))
    assert found.shape[1] == toxicity.WINDOW
    if n > toxicity.WINDOW:
        starts = found[:, 0]
        assert (np.diff(starts) < toxicity.WINDOW).all()


def test_a_late_word_is_found(network):
    rng = random.Random(3)
    clean = prose(rng, 5000)
    scores = toxicity.worst_windows(network, [clean, clean + " grobiab vexuc"])
    assert scores[1] >= toxicity.THRESHOLD > scores[0]


def test_held_out_rows(spark):
    ids = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("x"))
    assert all(row.x == (zlib.crc32(str(row.id).encode()) % 4 == 2) for row in ids.collect())


def test_fit_learns_from_bounded_allowed_rows(spark):
    rows = made(400, 4)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    texts, label, prior = toxicity.training_rows(
        docs, labels, 60, 10_000, "doc_id", "text", "toxic"
    )
    assert len(texts) == 120 and sum(label) == 60 and abs(prior - 0.5) < 0.1
    held = {r[1] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2}
    assert not held & set(texts)
    again = toxicity.training_rows(docs, labels, 60, 10_000, "doc_id", "text", "toxic")
    assert again == (texts, label, prior)


def test_odd_rows(spark, network):
    docs = frame(spark, odd_rows())
    scores = toxicity.scores(docs, network).collect()
    assert len(scores) == len(odd_rows()) and all(0 <= r.score <= 1 for r in scores)
    kept = toxicity.clean_documents(docs, network)
    assert kept.schema == docs.schema
    assert kept.count() == sum(r.score < toxicity.THRESHOLD for r in scores)
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.scores(empty, network).count() == 0
    assert toxicity.clean_documents(empty, None).count() == 0


def test_without_labels(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int")
    network = toxicity.fit(docs, labels)
    assert network is None
    assert {r.score for r in toxicity.scores(docs, network).collect()} == {0.0}
