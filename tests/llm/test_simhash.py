from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash

from strata.llm import simhash
from strata.llm.components import components

from tests.llm.helpers import SCHEMA, documents, frame, odd_rows, prose, union_find, words


def plain_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words(low)
    shingles = [" ".join(found[k : k + size]) for k in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles] if found else []
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def expected(rows, bits=4):
    prints = [plain_fingerprint(text) for _, text in rows]
    nodes = sorted(set(prints))
    pairs = [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= bits]
    root = union_find(pairs, nodes)
    least = {}
    for (id_, _), one in zip(rows, prints, strict=True):
        if id_ is not None:
            least[root[one]] = min(least.get(root[one], id_), id_)
    return Counter(
        (id_, f"{one:016x}", least.get(root[one]))
        for (id_, _), one in zip(rows, prints, strict=True)
    )


def told(df):
    return Counter((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_odd_rows(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(frame(spark, rows))
    assert told(found) == expected([row[:2] for row in rows])


@pytest.mark.parametrize("bucket_rows", [2048, 3])
def test_against_all_pairs(spark, bucket_rows):
    """With tiny buckets all levels and the tiles are in use."""
    docs = documents(spark)
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    near = [(10_000 + i, f"{text} x{i}") for i, text in rows[:60]]
    docs = spark.createDataFrame(rows + near, "doc_id long, text string")
    found = simhash.near_duplicates(docs, bucket_rows=bucket_rows)
    wanted = expected(rows + near)
    assert told(found) == wanted
    assert len({row[2] for row in wanted}) < len(rows + near) - 20


def test_large_buckets_visit_all(spark):
    chain = [(1 << n) - 1 for n in range(0, 60, 3)] * 2 + [(1 << 63) + n for n in range(100)]
    fps = sorted(set(chain))
    signed = [(simhash._signed(fp),) for fp in fps]
    nodes = spark.createDataFrame(signed, "fp long")
    edges = simhash.linked(simhash.buckets(nodes, 4, 2048), 4)
    root = {row.node: row.root for row in components(edges).collect()}
    groups = {root.get(fp, fp) for (fp,) in signed}
    pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4]
    assert len(groups) == len(set(union_find(pairs, fps).values()))


def test_keep_one(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    wanted = {c for _, _, c in expected([row[:2] for row in rows])}
    assert sorted(row.doc_id for row in kept.collect()) == sorted(wanted)


def test_keep_one_without_ids_of_their_own(spark):
    """Unlike texts without an id all stay, and so do unlike texts that share one."""
    rng = random.Random(3)
    clean = [prose(rng, 60) for _ in range(8)]
    rows = [(None, text) for text in clean[:5]] + [(None, clean[0]), (7, clean[0])]
    rows += [(3, clean[5]), (3, clean[6]), (3, clean[6]), (1, clean[6]), (3, clean[7])]
    docs = frame(spark, [(*row, "en", "a", None) for row in rows])
    wanted = [(None, text) for text in clean[1:5]]
    wanted += [(7, clean[0]), (3, clean[5]), (1, clean[6]), (3, clean[7])]
    kept = simhash.keep_one(docs).select("doc_id", "text").collect()
    assert Counter(map(tuple, kept)) == Counter(wanted)
    spread = [(3, "one two three four"), (3, "ONE two three four"), (None, "one  two three four")]
    kept = simhash.keep_one(frame(spark, [(*row, None, None, None) for row in spread]))
    assert [row.doc_id for row in kept.collect()] == [3]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    wanted = [(n, 0) for n in range(1, 41)] + [(101, 100), (102, 100)]
    assert sorted((r.node, r.root) for r in found.collect()) == wanted
