"""The whole load: landed files to Bronze, Silver and the marts."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import model
from strata.functions.times import parse_utc, read_mark
from strata.operators import validate
from strata.operators.bronze import Batch, to_bronze, with_fields
from strata.operators.increment import keys_at, newer_than, newer_with_ties, next_high_water
from strata.operators.periods import Periods
from strata.plans import merging, quotes
from strata.session import require_session, scratch_dir
from strata.sources import file_marks, state, tables
from strata.sources.landing import landed_payloads, landed_responses

logger = logging.getLogger(__name__)


class Lake:
    """Where the tables of one lake are."""

    def __init__(self, root: str) -> None:
        root = root.rstrip("/")
        self.bronze = f"{root}/bronze/quotes"
        self.silver = f"{root}/silver/quotes"
        self.latest = f"{root}/gold/latest"
        self.daily = f"{root}/gold/daily_metrics"
        self.gap = f"{root}/gold/official_gap"
        self.counts = f"{root}/metadata/row_counts"
        self.quarantine = f"{root}/quarantine/quotes"
        self.state = f"{root}/metadata/extract_state"
        self.progress = f"{root}/metadata/progress"
        self.files = f"{root}/metadata/files_read"
        self.columns = f"{root}/metadata/bronze_columns"
        self.tied = f"{root}/metadata/mark_keys"


@dataclass(frozen=True)
class Options:
    """What a run may choose beside its input."""

    #: A file is one body; else a line is.
    whole_payloads: bool = False
    #: A table (value, tag) in place of the fixed market tags.
    tags: DataFrame | None = None
    #: Quotes with a NaN price are flagged as bad.
    nan_is_bad: bool = False
    #: A mark per source, so that a slow source loses no late record.
    mark_per_source: bool = False
    #: An increment also takes records of the mark's very time whose keys it has not seen.
    keep_ties: bool = False
    #: An increment reads only files landed since the last run.
    new_files_only: bool = True
    #: A merge leaves rows alone that agree with the table in all but their lineage.
    skip_unchanged: bool = True
    #: A stream drops records that repeat what it last saw of their key, by a state store.
    #: The choice is part of the stream's plan: it holds for the life of a checkpoint.
    drop_repeats: bool = False
    #: Further fields of the source, kept in Bronze as text; the table gains their columns.
    extra_fields: tuple[str, ...] = ()


def read_bronze(spark: SparkSession, lake: Lake, within: Periods | None = None) -> DataFrame:
    stored = tables.read_table(spark, lake.bronze, model.BRONZE_STORED)
    return (within.select(stored) if within else stored).select(*model.BRONZE.names)


def read_bronze_whole(spark: SparkSession, lake: Lake) -> DataFrame:
    """Bronze with the extra fields that it has gained; NULL in rows from before."""
    stored = tables.read_table(spark, lake.bronze, bronze_schema(spark, lake))
    return stored.drop(*model.BRONZE_LAYOUT)


def bronze_schema(spark: SparkSession, lake: Lake) -> T.StructType:
    """The schema of stored Bronze, as noted when a column was gained.

    Without a note the files themselves tell, which reads all their footers; the answer is
    noted.
    """
    names = state.read_columns(spark, lake.columns)
    if names is None:
        found = merging.stored_schema(spark, lake.bronze, model.BRONZE_STORED)
        names = [name for name in found.names if name not in model.BRONZE_STORED.names]
        state.save_columns(spark, lake.columns, names)
    return _with_extra(names)


def _with_extra(names: Iterable[str]) -> T.StructType:
    extra = [T.StructField(name, T.StringType()) for name in names]
    return T.StructType([*model.BRONZE_STORED, *extra])


def read_silver(spark: SparkSession, lake: Lake, within: Periods | None = None) -> DataFrame:
    stored = tables.read_table(spark, lake.silver, model.SILVER)
    return (within.select(stored) if within else stored).select(*model.SILVER.names)


def checked_records(payloads: DataFrame, options: Options = Options()) -> DataFrame:
    """Landed bodies as records, each with its fields and, if it is rejected, the reason."""
    checked = validate.check_records(validate.split_payload(payloads), members="members")
    return with_fields(checked, extra_fields=options.extra_fields, members="members")


def stage_records(
    checked: DataFrame, stage: str, known: Sequence[str]
) -> tuple[DataFrame, dict[str | None, dict[str, Any]]]:
    """Write checked records, read them back, and count them by source.

    Later steps pass over the batch several times, and a written table survives the loss
    of an executor. The counts are taken as the rows are written. All rows of a source that
    is not known, however many, are counted under None.
    """
    path, seen = f"{stage}/records", Observation()
    validate.observe_sources(checked, seen, known).write.parquet(path)
    sources = validate.observed_sources(seen.get, known)
    logger.info("records per source: %s", sources)
    return checked.sparkSession.read.schema(checked.schema).parquet(path), sources


REJECT = T.StructType(
    [
        T.StructField("digest", T.StringType()),
        *[T.StructField(n, T.StringType()) for n in ("source", "endpoint", "raw")],
        *[T.StructField(n, T.StringType()) for n in ("reject_reason", "missing")],
        T.StructField("times", T.LongType()),
        T.StructField("batch_id", T.StringType()),
    ]
)


def quarantine(
    records: DataFrame, sources: Mapping[Any, Mapping[str, Any]], lake: Lake, batch: Batch
) -> None:
    """Keep what was rejected, whole and with the reason, beside the tables.

    It is written before anything else, so a run that stops loses no reject. A reject is
    known by a digest of where it came from, its text and the reason; what is stored already
    is not stored again, neither by a replay nor by a poll that brings it anew. ``times``
    tells how often the batch that brought it first held it.
    """
    if not any(seen["discarded"] or seen["bad_payloads"] for seen in sources.values()):
        return
    spark = records.sparkSession
    what = ["source", "endpoint", "raw", "reject_reason", "missing"]
    text = F.to_json(F.struct(*what), {"ignoreNullFields": "false"})
    rejects = (
        validate.rejected_records(records)
        .groupBy(F.sha2(text, 256).alias("digest"), *what)
        .agg(F.count("*").alias("times"))
    )
    if tables.path_exists(spark, lake.quarantine):
        stored = spark.read.schema(REJECT).parquet(lake.quarantine).select("digest")
        rejects = rejects.join(stored, "digest", "left_anti")
    rejects = rejects.withColumn("batch_id", F.lit(batch.batch_id)).select(*REJECT.names)
    rejects.write.mode("append").partitionBy("batch_id").parquet(lake.quarantine)


@dataclass(frozen=True)
class Loaded:
    """What a load did to Bronze."""

    #: The days rewritten; None if the table is all new.
    days: Periods | None
    rows: int

    @property
    def changed(self) -> bool:
        return self.days is None or not self.days.none


#: What a merge compares: all of Bronze but the lineage of the load.
LINEAGE = ("fecha_ingesta", "modo_extraccion", "batch_id")
COMPARED = [name for name in model.BRONZE.names if name not in LINEAGE]


def load_bronze(
    spark: SparkSession,
    records: DataFrame,
    lake: Lake,
    batch: Batch,
    stage: str,
    options: Options = Options(),
    rows: int = 0,
) -> Loaded:
    """Write the batch, of ``rows`` rows; returns the days it touched.

    A full load replaces Bronze by all records given. Otherwise the newest record of
    each key is merged into the days it falls in, unless the table has it already. The
    merge is staged whole before it replaces those days in place: raw rows cannot be derived
    again, and the staged copy lets the next run finish an interrupted one.
    """
    extra = options.extra_fields
    if batch.mode == "full" or not tables.table_exists(spark, lake.bronze):
        if batch.mode != "full":
            records = quotes.newest_snapshot(records)
        state.save_progress(spark, lake.progress, batch.batch_id, "loading")
        incoming = quotes.with_days(to_bronze(records, batch, extra_fields=extra))
        tables.overwrite_table(incoming, lake.bronze, model.BRONZE_LAYOUT)
        state.save_columns(spark, lake.columns, extra)
        loaded = Loaded(None, rows)
    else:
        schema = bronze_schema(spark, lake)
        newest = quotes.newest_snapshot(records)
        incoming = quotes.with_days(to_bronze(newest, batch, extra_fields=extra))
        merged = merging.stage_merge(
            incoming,
            lake.bronze,
            schema,
            model.MERGE_KEYS,
            model.BRONZE_LAYOUT,
            stage,
            [*COMPARED, *extra] if options.skip_unchanged else None,
        )
        loaded = Loaded(merged.touched, merged.rows)
        if loaded.changed:
            gained = [name for name in extra if name not in schema.names]
            if gained:
                names = [*schema.names[len(model.BRONZE_STORED) :], *gained]
                state.save_columns(spark, lake.columns, names)
            state.save_progress(spark, lake.progress, batch.batch_id, "loading", merged.path)
            _replace_days(spark, lake, merged.path)
    if loaded.changed:
        state.save_progress(spark, lake.progress, batch.batch_id, "bronze")
    return loaded


def _replace_days(spark: SparkSession, lake: Lake, path: str) -> None:
    merging.replace_periods(spark, path, lake.bronze, model.BRONZE_LAYOUT)


def finish_interrupted(spark: SparkSession, lake: Lake) -> bool:
    """Finish a merge that died half way; True if Silver and marts are up to date.

    Without its staged rows such a merge cannot be told from one not begun, so
    their loss is an error; a full load starts afresh.
    """
    last = state.read_progress(spark, lake.progress)
    if last is None:
        return not tables.table_exists(spark, lake.bronze)
    if last.merging:
        _replace_days(spark, lake, last.merging)
        state.save_progress(spark, lake.progress, last.batch_id, "bronze")
    return last.stage == "marts"


def refresh_silver(
    spark: SparkSession, lake: Lake, months: Periods | None, options: Options = Options()
) -> None:
    """Rebuild Silver from Bronze, whole or for some months.

    The quote key holds the quote time, so no key spans two months. An empty
    venue would come back as NULL from its folder and is stored as the default.
    """
    venue = F.when(F.col("venue") == "", model.TEXT_DEFAULTS["venue"]).otherwise(F.col("venue"))
    bronze = read_bronze(spark, lake, months)
    silver = quotes.build_silver(bronze, options.tags, options.nan_is_bad)
    _write_months(silver.withColumn("venue", venue), lake.silver, model.SILVER_LAYOUT, months)


def _write_months(
    df: DataFrame, root: str, layout: Sequence[str], months: Periods | None
) -> None:
    """Some months in place, or the whole table anew."""
    if months and tables.table_exists(df.sparkSession, root):
        tables.overwrite_partitions(df, root, layout)
    else:
        tables.overwrite_table(df, root, layout)


def refresh_daily(spark: SparkSession, lake: Lake, months: Periods | None) -> None:
    """The daily mart of the months, and the row counts of Silver and of it.

    Replacing folders leaves a month alone that has no valid row any more; such months
    are found by their counts, and their folders go one by one.
    """
    silver = read_silver(spark, lake, months)
    daily = quotes.daily_metrics(quotes.valid_quotes(silver)).select(*model.DAILY.names)
    _write_months(daily, lake.daily, model.DAILY_LAYOUT, months)

    month = list(model.COUNTS_LAYOUT)
    rows = silver.groupBy(*month).agg(
        F.count("*").alias("silver"), F.count_if("quality_ok").alias("valid")
    )
    _write_months(rows, lake.counts, model.COUNTS_LAYOUT, months)
    if months:
        path = tables.table_path(spark, lake.daily)
        counts = tables.read_table(spark, lake.counts, model.COUNTS)
        for row in months.select(counts).filter("valid = 0").toLocalIterator():
            tables.drop_path(spark, f"{path}/year={row.year}/month={row.month}")


def refresh_marts(spark: SparkSession, lake: Lake, months: Periods | None) -> dict[str, int]:
    """Rebuild the marts from stored Silver; returns what they hold.

    Silver is counted month by month as it is rebuilt, never whole, and the small marts
    as they are written. Of the daily mart the count needs the footers of its files.
    """
    refresh_daily(spark, lake, months)
    daily = tables.read_table(spark, lake.daily, model.DAILY)
    valid = quotes.valid_quotes(read_silver(spark, lake))
    latest_rows, gap_rows = Observation(), Observation()
    counted = F.count(F.lit(1)).alias("n")
    latest = quotes.latest_from_daily(valid, daily).observe(latest_rows, counted)
    tables.overwrite_table(latest, lake.latest)

    latest = tables.read_table(spark, lake.latest, model.LATEST)
    tables.overwrite_table(quotes.official_gap(latest).observe(gap_rows, counted), lake.gap)

    counts = tables.read_table(spark, lake.counts, model.COUNTS)
    return {
        "silver": counts.agg(F.coalesce(F.sum("silver"), F.lit(0))).first()[0],
        "gold_latest": latest_rows.get["n"],
        "gold_daily_metrics": daily.count(),
        "gold_official_gap": gap_rows.get["n"],
    }


def refresh_tables(
    spark: SparkSession, lake: Lake, days: Periods | None = None, options: Options = Options()
) -> dict[str, int]:
    """Silver and marts from Bronze, then note that they are up to date."""
    months = days.coarser(model.COUNTS_LAYOUT) if days else None
    refresh_silver(spark, lake, months, options)
    counts = refresh_marts(spark, lake, months)
    last = state.read_progress(spark, lake.progress)
    state.save_progress(spark, lake.progress, last.batch_id if last else "", "marts")
    return counts


def _quoted_at() -> Column:
    return parse_utc(F.col(model.QUOTE_TIME_FIELD))


def _root(root: str, source: str | None) -> str:
    return root if source is None else f"{root}-{source}"


@dataclass(frozen=True)
class Reached:
    """Where a mark moves to: its time, the batch's records, and the keys of that time."""

    high_water: datetime | None
    records: int
    keys: DataFrame | None = None


def take_new(
    spark: SparkSession,
    records: DataFrame,
    lake: Lake,
    mode: str,
    marked: Sequence[str | None],
    keep_ties: bool = False,
) -> tuple[DataFrame, dict[str | None, Reached]]:
    """The records after their mark, and where each mark moves to.

    ``marked`` is [None] for one mark over all sources, or the sources with one each.
    """
    keyed = records.withColumn("origen_datos", F.col("source"))
    key_schema = T.StructType([model.BRONZE[name] for name in model.MERGE_KEYS])
    parts, reached = [], {}
    for source in marked:
        own = keyed if source is None else keyed.filter(F.col("source") == source)
        mark, seen = None, None
        if mode == "incremental":
            mark = state.load_high_water(spark, _root(lake.state, source))
            tied = _root(lake.tied, source)
            if keep_ties and mark is not None and tables.table_exists(spark, tied):
                seen = tables.read_table(spark, tied, key_schema)
        if seen is None:
            fresh = newer_than(own, _quoted_at(), mark)
        else:
            fresh = newer_with_ties(own, _quoted_at(), mark, model.MERGE_KEYS, seen)
        parts.append(fresh.drop("origen_datos"))
        found = read_mark(next_high_water(fresh, _quoted_at(), mark))
        keys = None
        if keep_ties and found.high_water is not None:
            still = seen if found.high_water == mark else None
            keys = keys_at(fresh, _quoted_at(), found.high_water, model.MERGE_KEYS, still)
        reached[source] = Reached(found.high_water, found.records, keys)
    return reduce(DataFrame.unionByName, parts), reached


def read_landing(
    spark: SparkSession,
    landing: Mapping[str, str] | str,
    lake: Lake,
    endpoints: Mapping[str, str] = model.ENDPOINTS,
    whole_payloads: bool = False,
    new_only: bool = True,
) -> tuple[DataFrame, set[str]]:
    """The landed bodies, and the sources of which some were read before.

    With ``new_only`` files that an earlier run has read are left out; of these Spark reads
    at most those of the very time of the mark, to tell them by name. A lake without Bronze
    has read nothing.
    """
    files = file_marks.read_files(spark, lake.files) if new_only else None
    if files is None or not tables.table_exists(spark, lake.bronze):
        files, marks = None, {}
    else:
        paths = [landing] if isinstance(landing, str) else list(landing.values())
        marks = file_marks.file_times(files, paths)
    if isinstance(landing, str):
        responses = validate.check_envelope(landed_responses(spark, landing, marks))
        payloads = responses.drop("status", "content_type", "warning")
        before = set(endpoints) if marks else set()
    else:
        payloads = landed_payloads(spark, landing, whole_payloads, endpoints, marks=marks)
        before = {source for source, path in landing.items() if path in marks}
    if marks:
        name = ["landing", "landed_as"]
        payloads = payloads.join(files.select(*name), name, "left_anti")
    return payloads, before


def run_pipeline(
    spark: SparkSession,
    mode: str,
    landing: Mapping[str, str] | str,
    lake_root: str,
    whole_payloads: bool = False,
    endpoints: Mapping[str, str] = model.ENDPOINTS,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
    options: Options | None = None,
    keep_generations: int | None = None,
) -> dict[str, int]:
    """Load the landed snapshots and return row counts.

    ``landing`` names a path of bodies per source, or one path of responses that
    carry source, status and content type. ``full`` replaces Bronze;
    ``incremental`` reads the files landed since the last run and merges the records newer
    than the stored mark, of each key the newest. What is rejected goes to quarantine first;
    input that fails the checks then stops the run before any write to the tables, and its
    files count as unread. An incremental run without new records leaves the tables alone,
    unless an earlier run stopped before the marts were done. ``keep_generations`` deletes
    older generations of the tables at the end.
    """
    given = {"batch_id": batch_id, "ingested_at": ingested_at}
    batch = Batch(mode, **{name: value for name, value in given.items() if value is not None})
    options = options or Options(whole_payloads)
    require_session(spark)
    lake = Lake(lake_root)
    stage = scratch_dir(spark, "stage")

    known = list(endpoints) if isinstance(landing, str) else list(landing)
    strict = isinstance(landing, str) or options.whole_payloads
    new_only = mode == "incremental" and options.new_files_only
    payloads, marked_sources = read_landing(
        spark, landing, lake, endpoints, options.whole_payloads, new_only
    )
    required = [source for source in known if source not in marked_sources]
    records, sources = stage_records(checked_records(payloads, options), stage, known)
    quarantine(records, sources, lake, batch)
    validate.expect_valid_per_source(sources, required, strict)

    up_to_date = finish_interrupted(spark, lake) if mode == "incremental" else True
    marked = known if options.mark_per_source else [None]
    valid = validate.valid_records(records)
    fresh, reached = take_new(spark, valid, lake, mode, marked, options.keep_ties)
    new = sum(mark.records for mark in reached.values())
    loaded = load_bronze(spark, fresh, lake, batch, stage, options, new) if new else None
    for source, mark in reached.items():
        root = _root(lake.state, source)
        state.save_state(spark, root, mark.high_water, mode, mark.records, batch.ingested_at)
        if mark.keys is not None:
            tables.overwrite_table(mark.keys, _root(lake.tied, source))
    if sources:
        file_marks.save_files(records, lake.files)
    counts = {"extracted": new, "bronze_written": loaded.rows if loaded else 0}
    if (loaded and loaded.changed) or not up_to_date:
        days = loaded.days if loaded and up_to_date else None
        counts |= refresh_tables(spark, lake, days, options)
    tables.drop_path(spark, stage)
    if keep_generations:
        for root in vars(lake).values():
            tables.drop_old_generations(spark, root, keep_generations)
    return counts
