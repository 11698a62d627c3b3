"""Timestamp parsing: one parser for the high-water mark and for Silver."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark alone would read '20:56' as today and '2026' as 1 January.
DATE_SHAPED = r"^\d{4}-\d{2}-\d{2}"


def parse_utc(text: Column) -> Column:
    """ISO text to an instant; text without an offset is UTC, anything else NULL."""
    return F.when(text.rlike(DATE_SHAPED), F.try_to_timestamp(text))


def date_parts(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}


def from_micros(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


class Mark(NamedTuple):
    high_water: datetime | None
    records: int


def read_mark(row: DataFrame) -> Mark:
    """Fetch a one-row mark. It travels as microseconds: a collected timestamp
    would come back in the driver's own zone."""
    micros, records = row.select(F.unix_micros("high_water"), "records").first()
    if micros is None:
        return Mark(None, records)
    return Mark(from_micros(micros), records)
