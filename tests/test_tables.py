from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata import model
from strata.operators.periods import periods
from strata.plans import quotes
from strata.session import scratch_dir
from strata.sources import tables

from tests.helpers import bronze, rows_of


def parquet_files(path):
    return sorted(path.rglob("*.parquet"))


def test_missing_table(spark, tmp_path):
    root = str(tmp_path / "none")
    assert not tables.table_exists(spark, root)
    with pytest.raises(tables.MissingTable, match="load it first"):
        tables.read_table(spark, root, model.BRONZE)


def test_uncommitted_generation_is_not_read(spark, tmp_path):
    root = tmp_path / "t"
    tables.overwrite_table(spark.range(3), str(root))
    broken = root / "gen-99999999999999999999"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half a file")
    schema = spark.range(0).schema
    assert tables.read_table(spark, str(root), schema).count() == 3


def test_overwrite_replaces_data_and_schema(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), root)
    newer = spark.range(2).select(F.col("id").cast("string").alias("name"))
    tables.overwrite_table(newer, root)
    assert rows_of(tables.read_table(spark, root, newer.schema)) == [("0",), ("1",)]


def test_table_may_be_rewritten_from_itself(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), root)
    schema = spark.range(0).schema
    for _ in range(3):
        stored = tables.read_table(spark, root, schema)
        tables.overwrite_table(stored.union(stored), root)
    assert tables.read_table(spark, root, schema).count() == 24


def test_partition_overwrite_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("p"))
    tables.overwrite_table(rows, root, ["p"])
    tables.overwrite_partitions(rows.filter("id = 4"), root, ["p"])
    kept = tables.read_table(spark, root, rows.schema)
    assert sorted(row.id for row in kept.collect()) == [0, 2, 3, 4, 5, 6, 8, 9]


def test_partitioned_round_trip_keeps_text_and_column_order(spark, tmp_path):
    root = str(tmp_path / "silver")
    silver = quotes.build_silver(
        bronze(spark, {"casa": "007"}, {"casa": "a=b/c d"}, {"casa": None}, {"casa": "1e3"})
    )
    tables.overwrite_table(silver, root, model.SILVER_LAYOUT)
    stored = tables.read_table(spark, root, model.SILVER)
    assert stored.columns == silver.columns
    assert rows_of(stored) == rows_of(silver)
    assert {row.venue for row in stored.collect()} == {"007", "a=b/c d", "desconocida", "1e3"}


def test_partition_filters_prune_folders(spark, tmp_path):
    root = str(tmp_path / "silver")
    silver = quotes.build_silver(
        bronze(
            spark,
            {"fechaActualizacion": "2028-08-05T10:00:00Z"},
            {"fechaActualizacion": "2028-09-05T10:00:00Z"},
        )
    )
    tables.overwrite_table(silver, root, model.SILVER_LAYOUT)
    stored = tables.read_table(spark, root, model.SILVER)
    stored = periods(stored.filter("month = 9"), ("year", "month")).select(stored)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [row.month for row in stored.collect()] == [9]


def test_layout_gives_few_files_per_partition(spark, tmp_path):
    root = tmp_path / "t"
    rows = spark.range(0, 10_000, 1, 8).select("id", (F.col("id") % 5).alias("p"))
    tables.overwrite_table(rows, str(root), ["p"])
    assert len(parquet_files(root)) == 5


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Most rows in one folder: the write splits them by size, and keeps them all."""
    root = tmp_path / "t"
    rows = spark.range(0, 400_000, 1, 8).select(
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 7).alias("p"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        tables.overwrite_table(rows, str(root), ["p"])
    finally:
        spark.conf.set(size, before)
    assert len(parquet_files(next(root.glob("gen-*")) / "p=0")) > 3
    assert tables.read_table(spark, str(root), rows.schema).count() == 400_000


def test_periods(spark):
    rows = spark.createDataFrame(
        [(2028, 9, 1), (2025, 1, 7), (2028, 9, 1), (2028, 9, 2)], "year int, month int, day int"
    )
    days = periods(rows.filter("day < 7"), ("year", "month", "day"))
    assert (days.first, days.last) == (20280901, 20280902)
    assert rows_of(days.select(rows)) == [(2028, 9, 1), (2028, 9, 1), (2028, 9, 2)]
    months = days.coarser(("year", "month"))
    assert (months.first, months.last) == (20280900, 20280900)
    assert months.select(rows).count() == 3
    assert periods(rows.filter("false"), ("year", "month")).select(rows).count() == 0


def test_a_clock_set_back_does_not_hide_a_write(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.overwrite_table(spark.range(3), root)
    monkeypatch.setattr("time.time_ns", lambda: 0)
    tables.overwrite_table(spark.range(5), root)
    assert tables.read_table(spark, root, spark.range(0).schema).count() == 5
    assert len(list((tmp_path / "t").glob("gen-*"))) == 2
    tables.drop_old_generations(spark, root, 1)
    assert tables.read_table(spark, root, spark.range(0).schema).count() == 5
    assert len(list((tmp_path / "t").glob("gen-*"))) == 1


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared) and one != two
