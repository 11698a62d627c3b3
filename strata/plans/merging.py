"""Merge of a batch into a stored, partitioned table: what changes, and what it replaces."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.periods import Periods, periods
from strata.operators.upsert import changed_rows, upsert
from strata.sources import tables


@dataclass(frozen=True)
class StagedMerge:
    """Merged rows, written beside the table, that are to replace some of its periods."""

    path: str
    touched: Periods
    #: Rows of the batch that change the table.
    rows: int


def joined_schema(stored: T.StructType, batch: T.StructType) -> T.StructType:
    """The columns of the table, then those that the batch brings."""
    new = [field for field in batch if field.name not in stored.names]
    return T.StructType([*stored, *new])


def stored_schema(spark: SparkSession, root: str, base: T.StructType) -> T.StructType:
    """The schema of a stored table whose files may have come to differ.

    Known columns keep their type: that of a partition column is not told by its folders.
    This reads the footers of all files; a caller that merges often notes the result.
    """
    found = spark.read.option("mergeSchema", True).parquet(tables.table_path(spark, root)).schema
    return joined_schema(base, found)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_merge(
    incoming: DataFrame,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    layout: Sequence[str],
    stage: str,
    compare: Sequence[str] | None = None,
) -> StagedMerge:
    """Merge the batch into the periods of the table it falls in; nothing is replaced yet.

    ``schema`` is that of the stored table. Columns that only the batch has are gained, with
    NULL in the old rows; those that only the table has stay. With ``compare``, batch rows
    that agree with the table in these columns are taken out first, so that only periods
    with a change are rewritten. The batch holds each key once.
    """
    spark, seen = incoming.sparkSession, Observation()
    whole = joined_schema(schema, incoming.schema)
    incoming = _staged(
        incoming.observe(seen, F.count(F.lit(1)).alias("rows")), f"{stage}/incoming"
    )
    touched, rows = periods(incoming, layout, f"{stage}/periods"), seen.get["rows"]
    stored = tables.read_table(spark, root, whole)
    if compare:
        changed = Observation()
        fresh = changed_rows(touched.select(stored), incoming, keys, compare)
        incoming = _staged(
            fresh.observe(changed, F.count(F.lit(1)).alias("rows")), f"{stage}/changed"
        )
        if changed.get["rows"] < rows:
            rows = changed.get["rows"]
            touched = periods(incoming, layout, f"{stage}/changed-periods")
    merging = f"{stage}/merged"
    if not touched.none:
        merged = upsert(touched.select(stored).select(*whole.names), incoming, keys)
        tables.overwrite_table(merged.select(*whole.names), merging)
    return StagedMerge(merging, touched, rows)


def replace_periods(spark: SparkSession, path: str, root: str, layout: Sequence[str]) -> None:
    """Put the merged rows in place of the periods they fall in."""
    schema = spark.read.parquet(tables.table_path(spark, path)).schema
    tables.overwrite_partitions(tables.read_table(spark, path, schema), root, layout)


def merge_into(
    incoming: DataFrame,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    layout: Sequence[str],
    stage: str,
    compare: Sequence[str] | None = None,
) -> StagedMerge:
    """:func:`stage_merge` and :func:`replace_periods` at once."""
    merged = stage_merge(incoming, root, schema, keys, layout, stage, compare)
    if not merged.touched.none:
        replace_periods(incoming.sparkSession, merged.path, root, layout)
    return merged
