from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import exact_dedup
from strata.llm.common import staged

from tests.llm.helpers import SCHEMA, frame, odd_rows


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    told = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        told += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return Counter(told)


def told(df):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return Counter(tuple(row[c] for c in names) for row in df.collect())


def test_report(spark):
    rows = odd_rows()
    assert told(exact_dedup.exact_duplicates(frame(spark, rows))) == expected(rows)


def test_colliding_keys_are_chained_and_compared(spark):
    rows = odd_rows()
    weak = exact_dedup.exact_duplicates(
        frame(spark, rows), capacity=2, key=lambda text: F.pmod(F.xxhash64(text), F.lit(3))
    )
    assert told(weak) == expected(rows)
    assert weak.agg(F.max("chain")).first()[0] > 2


def test_directory_splits_overfull_buckets(spark):
    docs = spark.range(500).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")
    )
    index = exact_dedup.build_index(docs, capacity=8)
    sizes = [row["count"] for row in index.entries.groupBy("bucket").count().collect()]
    assert sum(sizes) == 500
    assert max(sizes) <= 8
    assert len({row.local_depth for row in index.directory.collect()}) > 1
    ordered = index.entries.select("bucket", F.shiftrightunsigned("key", 1).alias("key"))
    spans = ordered.groupBy("bucket").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    spans = sorted((row.bucket, row.a, row.b) for row in spans.collect())
    assert all(x[2] < y[1] for x, y in zip(spans, spans[1:], strict=False))


def test_the_answer_goes_through_the_directory(spark):
    """A cell that leads to another bucket loses its documents."""
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('text ', id % 200) AS text")
    index = exact_dedup.build_index(docs, capacity=8)
    assert exact_dedup.lookup(docs, index).count() == 300
    cell = index.directory.first().cell
    wrong = F.when(F.col("cell") == cell, F.col("bucket") + 1).otherwise(F.col("bucket"))
    index.directory = index.directory.withColumn("bucket", wrong)
    assert exact_dedup.lookup(docs, index).count() < 300


def test_owners_need_one_exchange(spark):
    """What comes after the ranges of buckets and keys is decided inside them."""
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('text ', id % 200) AS text")
    keyed = exact_dedup._keyed(docs, "doc_id", "text", exact_dedup.hashed)
    parts = staged(exact_dedup._parts(keyed), "test")
    owned = parts.withColumn("bucket", F.col("key") % 4).repartitionByRange("bucket", "key")
    plan = exact_dedup._entries(owned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("rangepartitioning") == 1


def test_keep_one(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    found = [(row.doc_id, row.text or "") for row in kept.collect()]
    best = {}
    for id_, text, *_ in rows:
        text = text or ""
        best[text] = max(best.get(text, -1), -1 if id_ is None else id_)
    assert sorted(found) == sorted((id_, text) for text, id_ in best.items())


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.exact_duplicates(docs).count() == 0
    assert exact_dedup.keep_one(docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_dedup.exact_duplicates(frame(spark, odd_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
