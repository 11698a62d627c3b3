"""Parquet tables in folders: each full write is a new generation.

A table is ``root/gen-<number>``; the newest generation that Spark has marked as
committed is the table. So a job may rewrite the table it reads, and a write that dies
leaves the old table in place. Nothing old is deleted unless asked for. Replacing some
partitions is done in place, and takes files away from who reads them meanwhile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MARK_COMMIT = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


class MissingTable(RuntimeError):
    """A table was read before anything was loaded into it."""


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _numbered(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """All generations by number, committed or not."""
    fs, folder = _file_system(spark, root)
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return sorted(
        (int(name.removeprefix("gen-")), f"{root}/{name}")
        for name in names
        if name.startswith("gen-")
    )


def _generations(spark: SparkSession, root: str) -> list[str]:
    """Committed generations, oldest first."""
    return [
        path for _, path in _numbered(spark, root) if path_exists(spark, f"{path}/_SUCCESS")
    ]


def table_exists(spark: SparkSession, root: str) -> bool:
    return bool(_generations(spark, root))


def table_path(spark: SparkSession, root: str) -> str:
    generations = _generations(spark, root)
    if not generations:
        raise MissingTable(f"no table at {root}: load it first")
    return generations[-1]


def read_table(
    spark: SparkSession, root: str, schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """Scan the current generation. The schema is explicit, so partition values
    keep their type and column order does not depend on the layout."""
    path = table_path(spark, root)
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.names)


def _laid_out(df: DataFrame, layout: Sequence[str]) -> DataFrame:
    """One shuffle so a partition gets few files; adaptive execution splits the
    large ones by size, so a hot partition is not one task."""
    return df.hint("rebalance", *layout) if layout else df


def overwrite_table(
    df: DataFrame,
    root: str,
    layout: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Replace data and schema by a generation numbered after all that are there.

    Two writers at once would choose the same number; the second then fails.
    """
    last = max((number for number, _ in _numbered(df.sparkSession, root)), default=0)
    writer = _laid_out(df, layout).write.format(fmt).option(MARK_COMMIT, "true")
    writer.mode("error").partitionBy(*layout).save(f"{root}/gen-{last + 1:020d}")


def drop_old_generations(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the newest ``keep`` committed generations; readers of those fail."""
    if keep < 1:
        raise ValueError("keep at least one generation")
    for old in _generations(spark, root)[:-keep]:
        drop_path(spark, old)


def overwrite_partitions(df: DataFrame, root: str, layout: Sequence[str]) -> None:
    """Replace, in place, just the partitions the rows fall in.

    The rows must not come from those partitions: stage them first.
    """
    spark = df.sparkSession
    (
        _laid_out(df, layout)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(MARK_COMMIT, "true")
        .partitionBy(*layout)
        .parquet(table_path(spark, root))
    )
