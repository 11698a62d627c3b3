"""Which landed files have been read: the newest file time per landing path.

File times are coarse in some stores, so the mark is a time and the files of that time.
Older files are pruned from the listing, before anything of them is read; files of the
very time are told apart by name. Files are taken as written once: one that is copied in
with an older time than the mark is not seen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.times import from_micros
from strata.sources.tables import overwrite_table, read_table, table_exists

FILE_MARKS = T.StructType(
    [
        T.StructField("landing", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("landed_as", T.StringType()),
    ]
)


def read_files(spark: SparkSession, root: str) -> DataFrame | None:
    """The files at the mark of each landing path; None before any run."""
    return read_table(spark, root, FILE_MARKS) if table_exists(spark, root) else None


def file_times(files: DataFrame | None, paths: Sequence[str]) -> dict[str, datetime]:
    """The mark of each of the paths that have one."""
    if files is None:
        return {}
    found = (
        files.filter(F.col("landing").isin(*paths))
        .groupBy("landing")
        .agg(F.unix_micros(F.max("landed_at")).alias("micros"))
    )
    return {row.landing: from_micros(row.micros) for row in found.collect()}


def unread(payloads: DataFrame, path: str, marks: Mapping[str, datetime]) -> DataFrame:
    """Drop the files of a path older than its mark. Spark prunes them by their metadata."""
    if path not in marks:
        return payloads
    return payloads.filter(F.col("_metadata.file_modification_time") >= F.lit(marks[path]))


def save_files(read: DataFrame, root: str) -> None:
    """Move the marks over the rows just read (landing, landed_at, landed_as)."""
    seen = read.select(*FILE_MARKS.names).distinct()
    before = read_files(read.sparkSession, root)
    if before is not None:
        seen = seen.unionByName(before).distinct()
    newest = Window.partitionBy("landing").orderBy(F.col("landed_at").desc())
    kept = seen.withColumn("_place", F.rank().over(newest)).filter("_place = 1").drop("_place")
    overwrite_table(kept, root)
