"""Raw records to the all-text Bronze rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.jsontext import json_members, member_texts
from strata.model import BRONZE, REQUIRED_FIELDS

MODES = ("full", "incremental")
OWN_LINEAGE = ("origen_datos", "endpoint")


@dataclass(frozen=True)
class Batch:
    """Lineage of one load, fixed once on the driver and shared by all its rows."""

    mode: str
    batch_id: str = field(default_factory=lambda: str(uuid4()))
    ingested_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise ValueError(f"unknown mode: {self.mode}")


def with_fields(
    records: DataFrame,
    raw: str = "raw",
    extra_fields: Sequence[str] = (),
    members: str | None = None,
) -> DataFrame:
    """Add the source's fields as text columns, all from one parse.

    A column ``members`` that holds the parsed record saves the parse, and goes. A record
    that did not come with a source or endpoint may name them itself. Extra fields are NULL
    where a record has none.
    """
    fields = (*REQUIRED_FIELDS, *extra_fields)
    parsed = members or "_members"
    if not members:
        records = records.withColumn(parsed, json_members(F.col(raw)))
    own = member_texts(F.col(parsed), (*fields, *OWN_LINEAGE))
    return records.withColumns(
        {
            "source": F.coalesce("source", own["origen_datos"]),
            "endpoint": F.coalesce("endpoint", own["endpoint"]),
            **{name: own[name] for name in fields},
        }
    ).drop(parsed)


def to_bronze(
    fields: DataFrame, batch: Batch, raw: str = "raw", extra_fields: Sequence[str] = ()
) -> DataFrame:
    """The Bronze contract: text fields, the raw record, and where it came from; extra
    fields, if any, follow."""
    return fields.withColumns(
        {
            "raw_json": F.col(raw),
            "fecha_ingesta": F.lit(batch.ingested_at.isoformat()),
            "origen_datos": F.col("source"),
            "modo_extraccion": F.lit(batch.mode),
            "batch_id": F.lit(batch.batch_id),
        }
    ).select(*BRONZE.names, *extra_fields)
