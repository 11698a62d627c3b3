"""What several of the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

#: A word of the text contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts lineage and survives the loss of an executor. It is
    left there: the returned frame reads it whenever it is evaluated.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not, for a column that is to go again."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def column_of(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def whole_text(column: str) -> Column:
    """The text, with null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def chunks(column: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most_bytes`` of text; a longer text has its own range."""
    start, held = 0, 0
    for row, value in enumerate(column):
        length = len(value.as_buffer()) if value.is_valid else 0
        if held and held + length > most_bytes:
            yield start, row
            start, held = row, 0
        held += length
    if start < len(column):
        yield start, len(column)
