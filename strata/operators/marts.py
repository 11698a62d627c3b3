"""Source preference, period metrics, and the gap to a reference row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefer_source(df: DataFrame, applies: Column, preferred: Column) -> DataFrame:
    """Where ``applies`` holds keep only preferred rows; elsewhere keep all.

    One filter, so one scan. Rows for which ``applies`` is NULL drop out.
    """
    return df.filter((applies & preferred) | ~applies)


def union_preferred(df: DataFrame, applies: Column, preferred: Column) -> DataFrame:
    """The same rows as the union of the two arms, for inputs that come apart."""
    return df.filter(applies & preferred).unionByName(
        df.filter(~applies), allowMissingColumns=True
    )


def period_metrics(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    ranges: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Aggregate per key; ``ranges`` adds differences of two of the metrics."""
    grouped = df.groupBy(*keys).agg(*[metric.alias(name) for name, metric in metrics.items()])
    return grouped.withColumns(
        {name: F.col(high) - F.col(low) for name, (high, low) in (ranges or {}).items()}
    )


def gap_to_reference(
    df: DataFrame,
    reference: Column,
    measure: str,
    applies: Column,
    reference_name: str = "reference",
    gap_name: str = "gap_pct",
) -> DataFrame:
    """Percentage gap of each row's measure to that of the reference row.

    The reference is one scalar, taken as a subquery: no join. No reference row
    gives no rows at all; if several match, the largest measure counts. The gap
    is NULL where it does not apply or the reference is not above zero.
    """
    found = df.filter(reference).agg(
        F.struct(F.count("*").alias("n"), F.max(measure).alias("value")).alias("found")
    )
    base = F.col(reference_name)
    return (
        df.withColumn("_found", found.scalar())
        .filter(F.col("_found.n") > 0)
        .withColumn(reference_name, F.col("_found.value"))
        .withColumn(
            gap_name,
            F.when(applies & (base > 0), (F.col(measure) - base) / base * F.lit(100.0)),
        )
        .drop("_found")
    )
