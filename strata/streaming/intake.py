"""Incremental intake as a stream over the landing folders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import model
from strata.operators import validate
from strata.operators.bronze import Batch
from strata.plans.medallion import (
    COMPARED,
    Lake,
    Options,
    checked_records,
    finish_interrupted,
    load_bronze,
    quarantine,
    refresh_tables,
    stage_records,
)
from strata.session import require_session, scratch_dir
from strata.sources import state, tables
from strata.sources.landing import landed_payloads
from strata.streaming.repeats import drop_repeats


def changed_records(records: DataFrame, options: Options) -> DataFrame:
    """Drop the records of a stream that repeat what it last saw of their key.

    A record's key is that of the merge, a reject's its text and the reason.
    """

    def text(*columns: str) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    keys = [name for name in model.MERGE_KEYS if name != "origen_datos"]
    reason = F.col("reject_reason")
    key = F.when(reason.isNull(), text("source", *keys)).otherwise(
        text("source", "raw", "reject_reason")
    )
    fields = [name for name in COMPARED if name in records.columns]
    value = text(*fields, "endpoint", "raw", *options.extra_fields)
    return drop_repeats(records, key, value, ["landed_at", "landed_as", "raw"])


def stream_pipeline(
    spark: SparkSession,
    landing: Mapping[str, str],
    lake_root: str,
    checkpoint: str,
    whole_payloads: bool = False,
    endpoints: Mapping[str, str] = model.ENDPOINTS,
    options: Options | None = None,
) -> dict[str, int]:
    """Merge all files landed since the last run, and refresh the months they touch.

    The checkpoint remembers the files read, in place of the high-water mark. Polls
    repeat unchanged quotes, so of each key the record landed last counts, and what agrees
    with the table changes nothing; with ``drop_repeats`` a state store keeps such records
    out of the batch. A body that
    cannot be read, or holds nothing, goes to quarantine and the stream goes on. A batch
    replayed after a crash carries the same id: its rejects are not repeated, and it is
    not applied twice.
    """
    options = options or Options(whole_payloads)
    require_session(spark)
    lake = Lake(lake_root)
    up_to_date = finish_interrupted(spark, lake)
    counts = {"extracted": 0, "bronze_written": 0}

    def load(checked: DataFrame, epoch: int) -> None:
        nonlocal up_to_date
        session = checked.sparkSession
        batch = Batch("incremental", batch_id=f"{checkpoint.rstrip('/')}#{epoch}")
        last = state.read_progress(session, lake.progress)
        applied = last and last.batch_id == batch.batch_id and last.stage != "loading"
        stage = scratch_dir(session, "stage")
        records, sources = stage_records(checked, stage, list(landing))
        quarantine(records, sources, lake, batch)
        valid = sum(seen["valid"] for seen in sources.values())
        if valid and not applied:
            fresh = validate.valid_records(records)
            loaded = load_bronze(session, fresh, lake, batch, stage, options, valid)
            if loaded.changed or not up_to_date:
                days = loaded.days if up_to_date else None
                counts.update(refresh_tables(session, lake, days, options))
                up_to_date = True
            counts["extracted"] += valid
            counts["bronze_written"] += loaded.rows
        tables.drop_path(session, stage)

    payloads = landed_payloads(spark, landing, options.whole_payloads, endpoints, stream=True)
    records = checked_records(payloads, options)
    if options.drop_repeats:
        records = changed_records(records, options)
    query = (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not up_to_date:
        counts |= refresh_tables(spark, lake, None, options)
    return counts
