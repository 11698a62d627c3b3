from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import length_packing

from tests.llm.helpers import SCHEMA, documents, frame, odd_rows, words


def padded(lengths, ends):
    return sum(min(e for e in ends if e >= n) * c for n, c in lengths.items())


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_boundaries_are_optimal(seed, buckets):
    rng = random.Random(seed)
    lengths = Counter(rng.choices(range(0, 40), k=60))
    ends = np.array(list(lengths))
    chosen = length_packing.boundaries(ends, np.array(list(lengths.values())), buckets)
    assert len(chosen) <= buckets and chosen[-1] == max(lengths)
    least = min(
        padded(lengths, [*some, max(lengths)])
        for k in range(min(buckets, len(lengths)))
        for some in itertools.combinations(sorted(lengths)[:-1], k)
    ) if len(lengths) < 45 and buckets < 4 else padded(lengths, chosen)
    assert padded(lengths, chosen) == least


def test_cells_hold_their_lengths(spark):
    values = [0, 1, 1023, 1024, 1025, 2047, 2048, 2049, 4095, 4096, 4097, 2**20 - 1, 2**20 + 1]
    rows = spark.createDataFrame([(v,) for v in values], "n long")
    for row in rows.select("n", length_packing.cell_end(F.col("n")).alias("end")).collect():
        assert row.n <= row.end <= row.n * (1 + 1 / 256)
        assert row.n > 1024 or row.end == row.n


def check(rows, lengths, budget, buckets):
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter(lengths)
    assert len({r.bucket_length for r in rows}) <= buckets
    batches = defaultdict(list)
    for r in rows:
        assert r.padding == r.bucket_length - r.n_tokens >= 0
        batches[r.bucket_length, r.batch].append(r.slot)
    full = {end: max(1, budget // max(1, end)) for end, _ in batches}
    for (end, batch), slots in batches.items():
        last = max(b for e, b in batches if e == end)
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == full[end] or batch == last and len(slots) <= full[end]
        assert len(slots) * end <= budget or len(slots) == 1
    for end in full:
        numbers = {b for e, b in batches if e == end}
        assert numbers == set(range(len(numbers)))


@pytest.mark.parametrize("share_rows", [100_000, 3])
def test_odd_rows(spark, share_rows):
    rows = odd_rows()
    found = length_packing.pack(
        frame(spark, rows), buckets=4, budget=700, share_rows=share_rows
    ).collect()
    check(found, [(row[0], len(words(row[1]))) for row in rows], 700, 4)


def test_given_documents_and_own_length(spark):
    docs = documents(spark)
    found = length_packing.pack(docs, F.col("n_chars"), share_rows=10).collect()
    check(found, [(r.doc_id, r.n_chars) for r in docs.collect()], 65_536, 16)


def test_empty(spark):
    assert length_packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_without_an_id_are_dealt_by_their_texts(spark):
    docs = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id END AS doc_id", "concat('w ', id) AS text"
    )
    rows = docs.selectExpr("doc_id AS id", "xxhash64(text) AS text_hash", "0 AS bucket")
    placed = length_packing._through(rows, share_rows=300)
    shares = sorted(row["count"] for row in placed.groupBy("share").count().collect())
    assert len(shares) == 20 and shares[-1] < 2 * shares[10]
    assert sorted(row.place for row in placed.collect()) == list(range(6000))
