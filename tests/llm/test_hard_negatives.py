from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 9), st.integers(1, 20), st.integers(1, 2**20))
def test_scores_are_inner_products(n, m, width, most):
    rng = np.random.default_rng(n * 1000 + width)
    width = -(-width // 8) * 8
    q = rng.integers(-most, most + 1, (n, width))
    anchors = rng.integers(-most, most + 1, (m, width))
    planes = hard_negatives.bit_planes(q)
    found = hard_negatives.scores(planes, hard_negatives.subset_sums(anchors))
    assert (found == q @ anchors.T).all()


def test_narrow_tables_hold_the_sums():
    q = np.full((3, 64), -147)
    planes = hard_negatives.bit_planes(q)
    assert hard_negatives._narrowest(q, len(planes)) is np.int32
    assert hard_negatives._narrowest(q * 10_000, len(planes)) is np.int64


def brute_force(rows, every=4, positives=5, negatives=5, low=80, high=100):
    kept = []
    for row, (id_, vector, label) in enumerate(rows):
        if label is None or vector is None:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        kept.append((id_, [int(np.floor(256 * float(np.float32(x)))) for x in vector], label, row))

    def first(scored, n):
        return sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:n]

    told = []
    for id_, q, label, row in kept:
        if id_ is None or id_ % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(q, other, strict=False)), i, l == label)
            for i, other, l, r in kept
            if r != row
        ]
        best = first([s for s in scored if s[2]], positives)
        for score, positive, _ in best:
            band = [s for s in scored if not s[2] and low * score <= 100 * s[0] <= high * score]
            for rank, (value, negative, _) in enumerate(first(band, negatives), 1):
                told.append((id_, positive, rank, negative, score, value))
    return sorted(told, key=repr)


def vectors(seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for id_ in range(n):
        vector = [rng.gauss(0.1, 0.3) for _ in range(11)]
        rows.append((id_, vector, rng.randrange(3)))
    hot = rows[17][1]
    rows += [(n + k, hot, k % 2) for k in range(60)]  # one vector, many times
    rows += [
        (None, rows[5][1], 1),
        (2000, None, 1),
        (2004, rows[6][1], None),
        (2008, [], 2),
        (2012, [0.5] * 3, 0),
        (2016, [float("nan")] * 11, 0),
        (2020, [float("inf")] * 11, 0),
        (2024, [None] * 11, 0),
        rows[9],
        rows[9],
    ]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("id", "row", "q", "score", "block", "place", "bounds", "rank"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


NAMES = (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
)


def told(df):
    assert tuple(df.columns) == NAMES
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_against_brute_force(spark):
    rows = vectors()
    found = told(hard_negatives.mine(frame(spark, rows), every=4))
    assert found and found == brute_force(rows)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = vectors(4, 150)
    prepared = hard_negatives.integers(frame(spark, rows), 256)
    whole = hard_negatives.candidate_blocks(prepared, 4096).collect()
    parts = hard_negatives.candidate_blocks(prepared, 8).collect()
    assert sum(len(b.ids) for b in whole) == sum(len(b.ids) for b in parts)
    assert max(len(b.ids) for b in parts) == 8
    monkeypatch.setattr(hard_negatives.candidate_blocks, "__defaults__", (8,))
    monkeypatch.setattr(hard_negatives.anchor_blocks, "__defaults__", (3,))
    assert told(hard_negatives.mine(frame(spark, rows), every=4)) == brute_force(rows)


def test_large_components_are_refused(spark):
    rows = [(0, [1e30], 1), (1, [1.0], 1)]
    with pytest.raises(ValueError):
        hard_negatives.mine(frame(spark, rows))


def test_empty(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).count() == 0
