"""High-water mark: which rows are new, and where the mark moves to."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newer_than(df: DataFrame, ts: Column, mark: datetime | None) -> DataFrame:
    """Rows strictly after the mark; rows without a time drop out.

    Without a mark everything passes, rows without a time included.
    """
    return df if mark is None else df.filter(ts > F.lit(mark))


def newer_with_ties(
    df: DataFrame, ts: Column, mark: datetime | None, keys: Sequence[str], seen: DataFrame
) -> DataFrame:
    """Rows after the mark, and those of its very time whose keys are not among ``seen``.

    :func:`newer_than` loses rows that share the mark's time and came after it. Keys
    compare null-safe; only rows of the mark's time can be dropped by them.
    """
    if mark is None:
        return df
    at = F.lit(mark)
    tied = seen.select(F.struct(*keys).alias("_key"), F.lit(True).alias("_tied")).distinct()
    return (
        df.filter(ts >= at)
        .select("*", F.struct(*keys).alias("_key"), (ts == at).alias("_tied"))
        .join(tied, ["_key", "_tied"], "left_anti")
        .select(*df.columns)
    )


def keys_at(
    df: DataFrame,
    ts: Column,
    mark: datetime | None,
    keys: Sequence[str],
    seen: DataFrame | None = None,
) -> DataFrame:
    """The keys of the mark's time, with those ``seen`` before if the mark has not moved."""
    found = df.filter(ts == F.lit(mark).cast("timestamp")).select(*keys)
    return (found if seen is None else found.unionByName(seen.select(*keys))).distinct()


def next_high_water(df: DataFrame, ts: Column, previous: datetime | None) -> DataFrame:
    """One row: ``high_water`` and the batch's ``records``.

    The mark is the batch's own maximum, so it may move back after a full load;
    a batch without any time keeps the previous mark.
    """
    return df.agg(
        F.coalesce(F.max(ts), F.lit(previous).cast("timestamp")).alias("high_water"),
        F.count("*").alias("records"),
    )
