"""Which days or months a batch touches, and the stored rows that lie in them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Partition columns from coarse to fine; a period is named by the first one, two or all.
PARTS = ("year", "month", "day")
_PLACES = (10_000, 100, 1)


def _number(parts: Sequence[str]) -> Column:
    """A period as one number, in order of time."""
    number = F.lit(0)
    for part, place in zip(parts, _PLACES, strict=False):
        number = number + F.col(part) * place
    return number


@dataclass(frozen=True)
class Periods:
    """Periods, a row or more each, and the numbers of the first and the last.

    However many there are, they stay a table: one pair of numbers reaches the driver.
    """

    rows: DataFrame
    parts: tuple[str, ...]
    first: int
    last: int

    @property
    def none(self) -> bool:
        return self.first > self.last

    def coarser(self, parts: Sequence[str]) -> Periods:
        place = _PLACES[len(parts) - 1]
        rows = self.rows.select(*parts)
        first, last = (n // place * place for n in (self.first, self.last))
        return Periods(rows, tuple(parts), first, last)

    def select(self, stored: DataFrame) -> DataFrame:
        """The stored rows inside the periods.

        The range is a plain filter on the partition columns and always prunes. Being
        on the side of the periods too, it lets Spark prune by the periods themselves
        where it broadcasts them.
        """
        inside = _number(self.parts).between(self.first, self.last)
        return stored.filter(inside).join(self.rows.filter(inside), list(self.parts), "left_semi")


def periods(rows: DataFrame, parts: Sequence[str], path: str | None = None) -> Periods:
    """The periods that ``rows`` fall in; none for an empty table.

    With a ``path`` they are written there once each, and the span is taken on the way.
    """
    number = _number(parts)
    span = [F.min(number).alias("first"), F.max(number).alias("last")]
    found = rows.select(*parts)
    if path:
        seen = Observation()
        found.distinct().observe(seen, *span).write.parquet(path)
        found, ends = rows.sparkSession.read.schema(found.schema).parquet(path), seen.get
    else:
        ends = rows.agg(*span).first().asDict()
    first, last = (1, 0) if ends["first"] is None else (ends["first"], ends["last"])
    return Periods(found, tuple(parts), first, last)
