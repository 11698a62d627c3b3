"""Run state: the high-water mark, and how far the last run got."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.times import parse_utc, read_mark
from strata.model import QUOTE_TIME_FIELD, STATE
from strata.sources.tables import overwrite_table, read_table, table_exists

PROGRESS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("batch_id", "stage", "merging")]
)
COLUMNS = T.StructType([T.StructField("names", T.ArrayType(T.StringType()))])


def _read_row(spark: SparkSession, root: str, schema: T.StructType) -> Row | None:
    if not table_exists(spark, root):
        return None
    return read_table(spark, root, schema, fmt="json").first()


def _write_row(spark: SparkSession, root: str, schema: T.StructType, values: tuple) -> None:
    row = spark.range(0, 1, 1, numPartitions=1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema, values, strict=True)]
    )
    overwrite_table(row, root, fmt="json")


def read_state(spark: SparkSession, root: str) -> Row | None:
    return _read_row(spark, root, STATE)


def load_high_water(spark: SparkSession, root: str) -> datetime | None:
    """The stored mark; None if there is none or it does not parse.

    A mark without offset is UTC.
    """
    if not table_exists(spark, root):
        return None
    stored = read_table(spark, root, STATE, fmt="json").select(
        parse_utc(F.col("watermark")).alias("high_water"),
        F.col("last_records").alias("records"),
    )
    return read_mark(stored).high_water


def save_state(
    spark: SparkSession,
    root: str,
    high_water: datetime | None,
    mode: str,
    records: int,
    run_at: datetime | None = None,
) -> None:
    """Store mark and run info; a batch without a mark keeps the stored one."""
    mark = high_water.isoformat() if high_water else None
    if mark is None:
        previous = read_state(spark, root)
        mark = previous.watermark if previous else None
    run_at = run_at or datetime.now(timezone.utc)
    _write_row(spark, root, STATE, (mark, QUOTE_TIME_FIELD, run_at.isoformat(), mode, records))


def read_columns(spark: SparkSession, root: str) -> list[str] | None:
    """The columns a table has gained beyond its contract; None if that was never noted."""
    row = _read_row(spark, root, COLUMNS)
    return None if row is None else list(row.names)


def save_columns(spark: SparkSession, root: str, names: Sequence[str]) -> None:
    _write_row(spark, root, COLUMNS, (list(names),))


def read_progress(spark: SparkSession, root: str) -> Row | None:
    return _read_row(spark, root, PROGRESS)


def save_progress(
    spark: SparkSession, root: str, batch_id: str, stage: str, merging: str | None = None
) -> None:
    """``merging`` names staged rows that are about to replace Bronze partitions."""
    _write_row(spark, root, PROGRESS, (batch_id, stage, merging))
