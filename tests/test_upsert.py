from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.upsert import ambiguous_matches, upsert

from tests.helpers import rows_of

SCHEMA = "a string, b string, v int"
KEYS = ["a", "b"]


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def test_null_keys_match(spark):
    target = frame(spark, (None, "x", 1), ("k", None, 2), (None, None, 3), ("k", "x", 4))
    source = frame(spark, (None, "x", 10), ("k", None, 20), (None, None, 30), ("n", "x", 40))
    assert rows_of(upsert(target, source, KEYS)) == sorted(
        [(None, "x", 10), ("k", None, 20), (None, None, 30), ("k", "x", 4), ("n", "x", 40)],
        key=repr,
    )


def test_null_values_overwrite(spark):
    merged = upsert(frame(spark, ("k", "x", 1)), frame(spark, ("k", "x", None)), KEYS)
    assert rows_of(merged) == [("k", "x", None)]


def test_every_target_row_of_a_matched_key_is_updated(spark):
    target = frame(spark, ("k", "x", 1), ("k", "x", 2), ("j", "x", 3))
    merged = upsert(target, frame(spark, ("k", "x", 9)), KEYS)
    assert rows_of(merged) == [("j", "x", 3), ("k", "x", 9), ("k", "x", 9)]


def test_unmatched_duplicates_are_all_inserted(spark):
    source = frame(spark, ("n", None, 1), ("n", None, 1), ("n", None, 2))
    merged = upsert(frame(spark, ("k", "x", 0)), source, KEYS)
    assert rows_of(merged) == [("k", "x", 0), ("n", None, 1), ("n", None, 1), ("n", None, 2)]


@pytest.mark.parametrize("action", ["collect", "count"])
def test_several_source_rows_for_one_target_row_fail(spark, action):
    source = frame(spark, ("k", None, 1), ("k", None, 2))
    merged = upsert(frame(spark, ("k", None, 0)), source, KEYS)
    with pytest.raises(Exception, match="several source rows match the key"):
        getattr(merged, action)()


def test_ambiguous_matches_report(spark):
    target = frame(spark, ("k", None, 0), ("j", "x", 0))
    source = frame(spark, ("k", None, 1), ("k", None, 2), ("j", "x", 1), ("n", "x", 1), ("n", "x", 2))
    assert rows_of(ambiguous_matches(target, source, KEYS)) == [("k", None, 2)]


def test_columns_of_one_side_only(spark):
    target = frame(spark, (1, "old", "t"), (2, "old", "t"), schema="k int, v string, only_t string")
    source = frame(spark, (1, "new", "s"), (3, "new", "s"), schema="k int, v string, only_s string")
    merged = upsert(target, source, ["k"])
    assert merged.columns == ["k", "v", "only_t", "only_s"]
    assert rows_of(merged) == [
        (1, "new", "t", "s"),
        (2, "old", "t", None),
        (3, "new", None, "s"),
    ]


key = st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None]))
target_rows = st.lists(st.tuples(key, st.integers(0, 9)), max_size=8)
source_rows = st.dictionaries(key, st.integers(10, 19), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target_rows, source_rows)
def test_against_a_row_by_row_merge(spark, target, source):
    old = frame(spark, *[(*k, v) for k, v in target])
    new = frame(spark, *[(*k, v) for k, v in source.items()])
    once = upsert(old, new, KEYS)
    expected = Counter((*k, source.get(k, v)) for k, v in target)
    known = {k for k, _ in target}
    expected.update((*k, v) for k, v in source.items() if k not in known)
    assert Counter(tuple(row) for row in once.collect()) == expected
    twice = upsert(once, new, KEYS)
    assert Counter(tuple(row) for row in twice.collect()) == expected


@pytest.fixture
def small_thresholds(spark):
    """No broadcasts, and skew handling already at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def spread(hot):
    """Keys and values from an id; where ``hot``, all share one key with a NULL."""
    return (
        F.when(F.expr(hot), F.lit(None)).otherwise(F.col("id").cast("string")).alias("a"),
        F.lit("x").alias("b"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )


@pytest.mark.parametrize(
    ("hot_target", "hot_source"), [("id % 3 = 0", "false"), ("false", "id % 3 = 0")]
)
def test_a_hot_key_is_split(spark, small_thresholds, hot_target, hot_source):
    """A third of one side shares a key: its join partition is split, not one task."""
    target = spark.range(0, 60_000, 1, 8).select(*spread(hot_target))
    source = spark.range(30_000, 90_000, 1, 8).select(*spread(hot_source))
    merged = upsert(target, source, KEYS)
    assert len(merged.collect()) == 60_000 + 40_000  # 20,000 matched
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert "NestedLoop" not in final and "Cartesian" not in final
    assert "SortMergeJoin(skew=true)" in final


def test_a_small_batch_moves_no_target_row(spark, tmp_path):
    target_path, source_path = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(0, 2000, 1, 4).select(*spread("false")).write.parquet(target_path)
    spark.range(1990, 2010, 1, 1).select(*spread("false")).write.parquet(source_path)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "20k")
    try:
        merged = upsert(spark.read.parquet(target_path), spark.read.parquet(source_path), KEYS)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "LeftOuter, BuildRight" in plan and "LeftSemi, BuildRight" in plan
        assert merged.count() == 2010
    finally:
        spark.conf.set(threshold, before)


def test_the_guard_moves_keys_and_not_the_target(spark, small_thresholds, tmp_path):
    """Many target rows per key: two joins read them, the guard only the keys that met."""
    target_path, source_path = str(tmp_path / "t"), str(tmp_path / "s")
    many = spark.range(0, 20_000, 1, 8).selectExpr("string(id % 50) a", "'x' b", "id v")
    many.write.parquet(target_path)
    few = spark.range(0, 100, 1, 2).selectExpr("string(id) a", "'x' b", "-id v")
    few.unionByName(few.filter("id >= 50")).write.parquet(source_path)
    merged = upsert(spark.read.parquet(target_path), spark.read.parquet(source_path), KEYS)
    assert len(merged.collect()) == 20_000 + 100
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert sum("FileScan" in line and target_path in line for line in final.splitlines()) == 2
