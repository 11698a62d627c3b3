"""Tables of the catalog that are bucketed by a merge key, so that a merge leaves them in place.

The key columns are kept as one text too, in which NULL is a value like others; equal texts
are equal keys. The table is dealt into buckets by that text when it is written. A merge
then shuffles the batch into as many buckets and joins them one by one: no row of the table
moves, however large the batch. The merged rows come out in the same buckets, and are
written as they are.

A table is a name in the session's catalog. With a catalog that lasts, such as Hive's, it
outlives the session; the files are under ``path``, or in the warehouse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.upsert import upsert

MERGE_KEY = "merge_key"


def merge_key(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def _save(df: DataFrame, table: str, buckets: int, path: str | None) -> None:
    writer = df.write.format("parquet").bucketBy(buckets, MERGE_KEY).sortBy(MERGE_KEY)
    if path:
        writer = writer.option("path", path)
    writer.mode("error").saveAsTable(table)


def create(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> None:
    """Store ``df`` in buckets, a file each."""
    keyed = df.withColumn(MERGE_KEY, merge_key(keys)).repartition(buckets, MERGE_KEY)
    _save(keyed, table, buckets, path)


def merged(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after :func:`upsert` of the batch, still in its buckets."""
    keyed = batch.withColumn(MERGE_KEY, merge_key(keys))
    return upsert(spark.table(table), keyed, [MERGE_KEY], null_safe=False)


def merge(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    into: str,
    path: str | None = None,
) -> None:
    """Merge the batch into the table, as a new table with the same buckets."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'")
    _save(merged(spark, table, batch, keys), into, int(rows.first().data_type), path)


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(MERGE_KEY)
