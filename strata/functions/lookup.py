"""Lookups: short fixed ones as expressions, others as a join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_lookup(value: Column, tags: Mapping[str, str], default: str) -> Column:
    """A CASE chain over a short dict, so the lookup needs no join."""
    branches = iter(tags.items())
    first, tag = next(branches)
    chain = F.when(value == first, F.lit(tag))
    for key, tag in branches:
        chain = chain.when(value == key, F.lit(tag))
    return chain.otherwise(F.lit(default))


def tags_joined(
    df: DataFrame, column: str, mapping: DataFrame, default: str, name: str = "tags"
) -> DataFrame:
    """Add the tag of ``column`` from a mapping table (value, tag), by a left join.

    The table holds each value once; Spark broadcasts it if it finds it small.
    """
    tags = mapping.select(F.col("value").alias("_value"), F.col("tag").alias("_tag"))
    return (
        df.join(tags, df[column] == tags["_value"], "left")
        .withColumn(name, F.coalesce("_tag", F.lit(default)))
        .drop("_value", "_tag")
    )
