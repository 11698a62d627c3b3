"""Registered queries: every operator at work on the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import model
from strata.functions.times import parse_utc, read_mark
from strata.operators import clean, marts, validate
from strata.operators.bronze import Batch, to_bronze, with_fields
from strata.operators.increment import keys_at, newer_than, newer_with_ties, next_high_water
from strata.operators.rank import latest_per_key
from strata.operators.periods import periods
from strata.operators.upsert import ambiguous_matches, upsert
from strata.plans import medallion, merging, quotes
from strata.session import require_session, scratch_dir
from strata.sources import bucketed, state, tables
from strata.sources.event_quotes import event_quotes, read_events
from strata.sources.landing import landed_payloads, landed_responses
from strata.streaming.intake import stream_pipeline

Query = Callable[[SparkSession, str], DataFrame]

MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)
FIRST_LOAD = Batch("full", "r0", datetime(2024, 2, 1, tzinfo=timezone.utc))
SECOND_LOAD = Batch("incremental", "r1", datetime(2024, 2, 2, tzinfo=timezone.utc))
FIRST_UNTIL, SECOND_FROM = "2024-01-21", "2024-01-11"


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_session(spark)
    return event_quotes(read_events(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    require_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock UTC, which an engine without zones can compare."""
    return df.withColumns(
        {
            field.name: F.col(field.name).cast("timestamp_ntz")
            for field in df.schema
            if field.dataType.typeName() == "timestamp"
        }
    )


# --- Bronze, Silver and the marts, step by step -------------------------------


def _record_text(*extra) -> Column:
    return F.to_json(F.struct(*model.REQUIRED_FIELDS, *extra), {"ignoreNullFields": "false"})


def bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _quotes(spark, sf_dir).select(
        _record_text().alias("raw"), F.col("origen_datos").alias("source"), "endpoint"
    )
    return to_bronze(with_fields(records), FIRST_LOAD)


def typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = clean.fill_defaults(clean.typed_quotes(_quotes(spark, sf_dir)))
    return filled.select("source", "currency", "venue", "venue_label", "raw_json")


def typed_numbers_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = clean.fill_defaults(clean.typed_quotes(_quotes(spark, sf_dir)))
    return _plain_times(filled.select("bid", "ask", "quoted_at", "ingested_at"))


def quote_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.flagged_quotes(_quotes(spark, sf_dir)).select(
        "bid", "ask", "spread", "mid", "spread_pct", "market_tags", "year", "month", "day"
    )


def quote_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.flagged_quotes(_quotes(spark, sf_dir)).select("quote_key", "raw_json")


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quotes.flagged_quotes(_quotes(spark, sf_dir))
    return flagged.groupBy("quality_ok").agg(F.count("*").alias("n"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = clean.quote_rules() | clean.nan_rules()
    flagged = clean.broken_rules(quotes.flagged_quotes(_quotes(spark, sf_dir)), rules)
    return flagged.groupBy("broken").agg(F.count("*").alias("n"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(quotes.build_silver(_quotes(spark, sf_dir)))


def tags_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market tags from a table, made of the event types; some venues have none in it."""
    kinds = _table(spark, sf_dir, "events").select("event_type").distinct()
    names = {"click": "blue", "purchase": "bolsa", "signup": "cripto"}
    value = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in names.items()])
    tags = kinds.select(value.alias("value"), F.concat(F.lit("of "), "event_type").alias("tag"))
    flagged = quotes.flagged_quotes(_quotes(spark, sf_dir), tags.filter("value IS NOT NULL"))
    return flagged.select("quote_key", "venue", "market_tags", "raw_json")


def nan_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics where quotes with a NaN price count as bad."""
    ask = F.when(F.col("compra").endswith(".5"), "NaN").otherwise(F.col("venta"))
    rows = _quotes(spark, sf_dir).withColumn("venta", ask)
    return quotes.daily_metrics(quotes.valid_quotes(quotes.build_silver(rows, nan_is_bad=True)))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.valid_quotes(quotes.build_silver(_quotes(spark, sf_dir)))


def latest_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(quotes.latest_quotes(_valid(spark, sf_dir)))


def source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    united = quotes.union_quotes(quotes.flagged_quotes(_quotes(spark, sf_dir)))
    return united.groupBy("currency", "source").agg(
        F.count("*").alias("n"), F.sum("ask").alias("sum_ask")
    )


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.daily_metrics(_valid(spark, sf_dir))


def _stored(df: DataFrame) -> DataFrame:
    """Write and read back: the gap reads its input twice, this computes it once."""
    root = scratch_dir(df.sparkSession, "stored")
    tables.overwrite_table(df, root)
    return tables.read_table(df.sparkSession, root, df.schema)


def official_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _stored(quotes.latest_quotes(_valid(spark, sf_dir)))
    return _plain_times(quotes.official_gap(latest))


def official_gap_no_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    others = _valid(spark, sf_dir).filter(F.col("venue") != model.OFFICIAL_VENUE)
    latest = _stored(quotes.latest_quotes(others))
    return quotes.official_gap(latest).agg(F.count("*").alias("n"))


# --- Increments ---------------------------------------------------------------


def _quoted_at() -> Column:
    return parse_utc(F.col(model.QUOTE_TIME_FIELD))


def newer_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newer_than(_quotes(spark, sf_dir), _quoted_at(), MARK)


def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = newer_than(_quotes(spark, sf_dir), _quoted_at(), MARK)
    return _plain_times(next_high_water(fresh, _quoted_at(), MARK))


#: Between two polls of one hour, in which many quotes share a time.
BETWEEN_POLLS = "2024-01-16T10:30"


def newer_than_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All quotes against the mark of an earlier poll, and the keys it saw at that time."""
    rows = _quotes(spark, sf_dir)
    earlier = rows.filter(F.col("fecha_ingesta") < BETWEEN_POLLS)
    mark = read_mark(next_high_water(earlier, _quoted_at(), None)).high_water
    seen = keys_at(earlier, _quoted_at(), mark, model.MERGE_KEYS)
    return newer_with_ties(rows, _quoted_at(), mark, model.MERGE_KEYS, seen)


def state_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two saves: the second batch has no readable time and keeps the mark."""
    rows = _quotes(spark, sf_dir)
    root = scratch_dir(spark, "state")
    unreadable = rows.filter(_quoted_at().isNull())
    for mode, batch in (("full", rows), ("incremental", unreadable)):
        mark = read_mark(next_high_water(batch, _quoted_at(), None))
        state.save_state(spark, root, mark.high_water, mode, mark.records, FIRST_LOAD.ingested_at)
    return tables.read_table(spark, root, model.STATE, fmt="json")


# --- Upsert and stored tables -------------------------------------------------


def _overlapping_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _quotes(spark, sf_dir)
    newest = [F.col("fecha_ingesta").desc(), F.col("raw_json").desc()]
    first = rows.filter(F.col("fecha_ingesta") < FIRST_UNTIL)
    second = rows.filter(F.col("fecha_ingesta") >= SECOND_FROM)
    return (
        latest_per_key(first, model.MERGE_KEYS, newest),
        latest_per_key(second, model.MERGE_KEYS, newest).withColumn("batch_id", F.lit("b1")),
    )


def upsert_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_overlapping_batches(spark, sf_dir), model.MERGE_KEYS)


def upsert_duplicate_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _quotes(spark, sf_dir)
    target = rows.filter(F.col("fecha_ingesta") < FIRST_UNTIL)
    source = rows.filter(F.col("fecha_ingesta") >= SECOND_FROM)
    return ambiguous_matches(target, source, model.MERGE_KEYS)


def overwrite_then_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored form: overwrite, read back, merge into the stored rows, overwrite."""
    root = scratch_dir(spark, "bronze")
    loads = zip(("full", "incremental"), _overlapping_batches(spark, sf_dir))
    for mode, batch in loads:
        if mode == "incremental" and tables.table_exists(spark, root):
            stored = tables.read_table(spark, root, model.BRONZE)
            batch = upsert(stored, batch, model.MERGE_KEYS)
        tables.overwrite_table(batch, root)
    return tables.read_table(spark, root, model.BRONZE)


def _files(spark: SparkSession, root: str) -> DataFrame:
    path = tables.table_path(spark, root)
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).distinct()


def merge_changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders come again, few with a new price: the months, and which were rewritten."""
    root, layout = scratch_dir(spark, "orders"), ["year", "month"]
    price = F.round(F.col("o_totalprice") * 100).cast("long")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        price.alias("cents"),
        F.lit("first").alias("load"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    tables.overwrite_table(orders, root, layout)
    before = _stored(_files(spark, root))
    again = F.when(F.col("o_orderkey") % 997 == 0, F.col("cents") + 1).otherwise(F.col("cents"))
    batch = orders.withColumns({"cents": again, "load": F.lit("second")})
    compare = ["o_orderstatus", "cents"]
    stage = scratch_dir(spark, "merge")
    merging.merge_into(batch, root, orders.schema, ["o_orderkey"], layout, stage, compare)
    stored = tables.read_table(spark, root, orders.schema).withColumn(
        "file", F.col("_metadata.file_path")
    )
    kept = before.withColumn("kept", F.lit(True))
    return (
        stored.join(kept, "file", "left")
        .groupBy(*layout)
        .agg(
            F.count("*").alias("orders"),
            F.sum("cents").alias("cents"),
            F.count_if(F.col("load") == "second").alias("changed"),
            F.bool_or(F.col("kept").isNull()).alias("rewritten"),
        )
    )


def evolving_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table gains a column in its second batch, which lacks one that it has."""
    root, layout = scratch_dir(spark, "evolving"), ["year", "month", "day"]
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
    )
    first = events.filter("event_id % 3 <> 0").drop("value")
    tables.overwrite_table(first, root, layout)
    second = events.filter("day >= 15 AND (event_id % 3 = 0 OR event_id % 2 = 0)")
    second = second.drop("user_id").withColumn("event_type", F.upper("event_type"))
    stage = scratch_dir(spark, "merge")
    merging.merge_into(second, root, first.schema, ["event_id"], layout, stage)
    grown = merging.stored_schema(spark, root, first.schema)
    return tables.read_table(spark, root, grown)


def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`upsert_quotes` of a table in buckets by the merge key."""
    first, second = _overlapping_batches(spark, sf_dir)
    path = scratch_dir(spark, "quotes")
    name = "quotes_" + path.rsplit("-", 1)[1]
    bucketed.create(first, name, model.MERGE_KEYS, buckets=8, path=path)
    after = f"{name}_merged"
    bucketed.merge(spark, name, second, model.MERGE_KEYS, after, f"{path}-merged")
    return bucketed.read(spark, after)


def partitioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "silver")
    built = quotes.build_silver(_quotes(spark, sf_dir))
    tables.overwrite_table(built, root, model.SILVER_LAYOUT)
    return _plain_times(tables.read_table(spark, root, model.SILVER))


def partition_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all days but recompute one from changed rows, replacing it in place."""
    root = scratch_dir(spark, "days")
    rows = _table(spark, sf_dir, "events").select(
        "event_id", "value", F.dayofmonth("ts").alias("day")
    )
    tables.overwrite_table(rows, root, ["day"])
    changed = rows.filter("day = 7").withColumn("value", F.col("value") * 2)
    tables.overwrite_partitions(changed, root, ["day"])
    return tables.read_table(spark, root, rows.schema)


def many_months_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events over 720 months; those with a purchase are recomputed and replaced in place."""
    root, layout = scratch_dir(spark, "months"), ["year", "month"]
    events = _table(spark, sf_dir, "events")
    age = F.col("event_id") % 720
    rows = events.select(
        "event_id",
        "event_type",
        "value",
        (2024 - F.floor(age / 12)).cast("int").alias("year"),
        (12 - age % 12).cast("int").alias("month"),
    )
    tables.overwrite_table(rows, root, layout)
    stored = tables.read_table(spark, root, rows.schema)
    path = scratch_dir(spark, "touched")
    touched = periods(stored.filter("event_type = 'purchase'"), layout, path)
    changed = _stored(touched.select(stored).withColumn("value", F.col("value") * 2))
    tables.overwrite_partitions(changed.select(*rows.columns), root, layout)
    return tables.read_table(spark, root, rows.schema)


def partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files each folder of a partitioned table got."""
    root = scratch_dir(spark, "files")
    built = quotes.build_silver(_quotes(spark, sf_dir))
    tables.overwrite_table(built, root, model.SILVER_LAYOUT)
    stored = spark.read.parquet(tables.table_path(spark, root))
    return stored.groupBy(*model.SILVER_LAYOUT).agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("n")
    )


# --- Landed payloads ----------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per event, of twelve shapes by turns, nine of them odd."""
    rows = _table(spark, sf_dir, "events")
    time_text = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))
    bid = F.floor("value").cast("string")

    def record(bid_text) -> Column:
        return F.concat(
            F.lit('{"moneda":"USD","casa":"'), "event_type",
            F.lit('","nombre":"n'), F.col("user_id").cast("string"),
            F.lit('","compra":'), bid_text,
            F.lit(',"venta":'), F.col("event_id").cast("string"),
            F.lit(',"fechaActualizacion":"'), time_text, F.lit('"}'),
        )

    shape = F.col("event_id") % 12
    body = (
        F.when(shape == 0, record(bid))
        .when(shape == 1, F.concat(F.lit("["), record(bid), F.lit("]")))
        .when(shape == 2, F.concat(F.lit("["), record(bid), F.lit(",1,null]")))
        .when(shape == 3, F.concat(F.lit("["), record(bid), F.lit(',{"casa":"x","moneda":"USD"}]')))
        .when(shape == 4, "[]")
        .when(shape == 5, "null")
        .when(shape == 6, "oops{")
        .when(shape == 8, F.concat(F.lit("\n["), record(bid), F.lit("\t]")))
        .when(shape == 9, "\t[] ")
        .when(shape == 10, "null\n")
        .when(shape == 11, '1,"after":2} junk')
        .otherwise(record(F.lit("null")))
    )
    return rows.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "dolares").otherwise("cotizaciones").alias("source"),
        F.lit("/v1").alias("endpoint"),
        body.alias("body"),
    )


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check_records(validate.split_payload(_payloads(spark, sf_dir)))


def split_and_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.source_counts(_checked(spark, sf_dir)).drop("problem")


def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = with_fields(validate.valid_records(_checked(spark, sf_dir)))
    return valid.select("event_id", "source", "raw", *model.REQUIRED_FIELDS)


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.rejected_records(_checked(spark, sf_dir)).select(
        "event_id", "source", "raw", "reject_reason", "missing"
    )


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made of events: some failed, some mislabelled, some cut off, some forged."""
    rows = _table(spark, sf_dir, "events")
    event = F.col("event_id")
    body = (
        F.when(event % 5 == 0, F.expr("substr(props, 2)"))
        .when(event % 13 == 0, F.concat(F.lit("\n\t"), "props"))
        .when(event % 13 == 1, '1,"after":2} junk')
        .when(event % 13 == 2, F.concat("props", F.lit("\r\n")))
        .when(event % 13 == 3, "1],[2")
        .otherwise(F.col("props"))
    )
    return rows.select(
        "event_id",
        F.when(event % 3 == 0, "dolares").otherwise("cotizaciones").alias("source"),
        F.lit("/v1").alias("endpoint"),
        F.when(event % 11 == 0, 503).otherwise(200).alias("status"),
        F.when(event % 7 == 0, "text/html")
        .when(event % 7 == 1, "")
        .otherwise("application/json; charset=utf-8")
        .alias("content_type"),
        body.alias("body"),
    )


def response_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.check_envelope(_responses(spark, sf_dir))
    return checked.select("event_id", "reject_reason", "warning")


def responses_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same responses, landed as JSON lines and read back."""
    folder = scratch_dir(spark, "responses")
    _responses(spark, sf_dir).drop("event_id").write.json(folder)
    checked = validate.check_envelope(landed_responses(spark, folder))
    return checked.select("source", "status", "content_type", "body", "reject_reason", "warning")


def landed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole bodies, a file each: arrays of some hundred quotes, with white space around."""
    folder = scratch_dir(spark, "bodies")
    rows = _table(spark, sf_dir, "events")
    record = F.struct(*model.REQUIRED_FIELDS)
    numbered = event_quotes(rows.withColumn("props", F.col("event_id").cast("string")))
    bodies = (
        numbered.withColumn("number", F.col("raw_json").cast("long"))
        .groupBy("origen_datos", F.floor(F.col("number") / 500).alias("file"))
        .agg(F.collect_list(record).alias("quotes"))
        .select(
            "origen_datos",
            "file",
            F.concat(
                F.lit("\n\t"), F.to_json("quotes", {"ignoreNullFields": "false"}), F.lit("\r\n")
            ).alias("value"),
        )
    )
    landing = {}
    for source in model.ENDPOINTS:
        landing[source] = f"{folder}/{source}"
        own = bodies.filter(F.col("origen_datos") == source)
        own.select("file", "value").write.partitionBy("file").text(landing[source])
    split = validate.split_payload(landed_payloads(spark, landing, whole_payloads=True))
    valid = with_fields(validate.valid_records(validate.check_records(split)))
    return valid.select("source", *model.REQUIRED_FIELDS)


# --- The whole load over landed files -----------------------------------------


def _land(records: DataFrame, folder: str) -> dict[str, str]:
    """Land records as a file set per source, one JSON object per line."""
    landing = {}
    for source in model.ENDPOINTS:
        landing[source] = f"{folder}/{source}"
        lines = records.filter(F.col("origen_datos") == source).select("line")
        lines.write.mode("append").text(landing[source])
    return landing


def _landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as JSON lines; ``props`` in the record tells equal quotes apart."""
    rows = _quotes(spark, sf_dir)
    line = _record_text(F.col("raw_json").alias("props"), F.col("fecha_ingesta").alias("seen"))
    return rows.select(*model.MERGE_KEYS, "fecha_ingesta", line.alias("line"))


def _run(
    spark: SparkSession,
    batch: Batch,
    landing: dict[str, str],
    lake: str,
    options: medallion.Options | None = None,
) -> dict[str, int]:
    return medallion.run_pipeline(
        spark,
        batch.mode,
        landing,
        lake,
        batch_id=batch.batch_id,
        ingested_at=batch.ingested_at,
        options=options,
    )


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, load in full, and read the stored gap mart."""
    folder = scratch_dir(spark, "full")
    _run(spark, FIRST_LOAD, _land(_landed_lines(spark, sf_dir), f"{folder}/landing"), folder)
    lake = medallion.Lake(folder)
    return _plain_times(tables.read_table(spark, lake.gap, model.GAP))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a full run reports."""
    folder = scratch_dir(spark, "counts")
    landing = _land(_landed_lines(spark, sf_dir), f"{folder}/landing")
    counts = _run(spark, FIRST_LOAD, landing, folder)
    return spark.createDataFrame(list(counts.items()), "name string, rows long")


def empty_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing twice: the second run finds nothing new and keeps the mark."""
    folder = scratch_dir(spark, "empty")
    landing = _land(_landed_lines(spark, sf_dir), f"{folder}/landing")
    _run(spark, FIRST_LOAD, landing, folder)
    _run(spark, SECOND_LOAD, landing, folder)
    return tables.read_table(spark, medallion.Lake(folder).state, model.STATE, fmt="json")


def _after_increment(spark: SparkSession, sf_dir: str) -> medallion.Lake:
    """A full load, then an overlapping increment of one line per key."""
    folder = scratch_dir(spark, "incremental")
    lines = _landed_lines(spark, sf_dir)
    first = lines.filter(F.col("fecha_ingesta") < FIRST_UNTIL)
    second = lines.filter(F.col("fecha_ingesta") >= SECOND_FROM)
    second = latest_per_key(second, model.MERGE_KEYS, [F.col("line").desc()])
    _run(spark, FIRST_LOAD, _land(first, f"{folder}/landing0"), folder)
    _run(spark, SECOND_LOAD, _land(second, f"{folder}/landing1"), folder)
    return medallion.Lake(folder)


def incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart after an increment."""
    return tables.read_table(spark, _after_increment(spark, sf_dir).daily, model.DAILY)


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(medallion.read_silver(spark, _after_increment(spark, sf_dir)))


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _after_increment(spark, sf_dir).latest
    return _plain_times(tables.read_table(spark, latest, model.LATEST))


def incremental_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an increment reads of a landing folder that has grown since a full load."""
    folder = scratch_dir(spark, "grown")
    lines = _landed_lines(spark, sf_dir)
    landing = _land(lines.filter(F.col("fecha_ingesta") < FIRST_UNTIL), f"{folder}/landing")
    _run(spark, FIRST_LOAD, landing, folder)
    _land(lines.filter(F.col("fecha_ingesta") >= FIRST_UNTIL), f"{folder}/landing")
    payloads, _ = medallion.read_landing(spark, landing, medallion.Lake(folder))
    return payloads.select("source", "endpoint", "body")


def marks_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after an increment with a mark per source; one source lags behind."""
    folder = scratch_dir(spark, "marks")
    lines = _landed_lines(spark, sf_dir)
    until = F.when(F.col("origen_datos") == "dolares", FIRST_UNTIL).otherwise(SECOND_FROM)
    first = lines.filter(F.col("fecha_ingesta") < until)
    second = latest_per_key(
        lines.filter(F.col("fecha_ingesta") >= SECOND_FROM),
        model.MERGE_KEYS,
        [F.col("line").desc()],
    )
    options = medallion.Options(mark_per_source=True)
    _run(spark, FIRST_LOAD, _land(first, f"{folder}/landing0"), folder, options)
    _run(spark, SECOND_LOAD, _land(second, f"{folder}/landing1"), folder, options)
    return _plain_times(medallion.read_silver(spark, medallion.Lake(folder)))


def incremental_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = _after_increment(spark, sf_dir).gap
    return _plain_times(tables.read_table(spark, gap, model.GAP))


def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine after a full run, a second one over the same files, and its replay."""
    folder = scratch_dir(spark, "quarantine")
    one_line = F.translate("body", "\n", " ")
    lines = _payloads(spark, sf_dir).select(
        F.col("source").alias("origen_datos"), one_line.alias("line")
    )
    landing = _land(lines, f"{folder}/landing")
    options = medallion.Options(new_files_only=False)
    for batch in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD):
        _run(spark, batch, landing, folder, options)
    stored = spark.read.schema(medallion.REJECT).parquet(medallion.Lake(folder).quarantine)
    return stored.select("source", "raw", "reject_reason", "missing", "times", "batch_id")


def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stream runs over one landing folder that grows in between."""
    folder = scratch_dir(spark, "stream")
    line = F.to_json(F.struct(*model.REQUIRED_FIELDS), {"ignoreNullFields": "false"})
    for batch in _overlapping_batches(spark, sf_dir):
        landing = _land(batch.withColumn("line", line), f"{folder}/landing")
        stream_pipeline(spark, landing, folder, f"{folder}/checkpoint")
    bronze = medallion.read_bronze(spark, medallion.Lake(folder))
    return bronze.drop("fecha_ingesta", "batch_id")


#: Three polls whose quotes overlap: ingested from, and before.
POLLS = (("2024-01-01", "2024-01-15"), ("2024-01-08", "2024-01-22"), ("2024-01-16", "2025"))


def stream_repeated_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run after the first poll, and one after two more and an empty body."""
    folder = scratch_dir(spark, "polls")
    rows = _quotes(spark, sf_dir)
    newest = [F.col("fecha_ingesta").desc(), F.col("raw_json").desc()]
    line = F.to_json(F.struct(*model.REQUIRED_FIELDS), {"ignoreNullFields": "false"})
    for number, (start, end) in enumerate(POLLS):
        seen = rows.filter((F.col("fecha_ingesta") >= start) & (F.col("fecha_ingesta") < end))
        snapshot = latest_per_key(seen, model.MERGE_KEYS, newest).withColumn("line", line)
        landing = _land(snapshot, f"{folder}/landing")
        if number == 1:
            empty = spark.range(1).select(F.lit("[]").alias("line"))
            empty.write.mode("append").text(landing["dolares"])
        else:
            stream_pipeline(spark, landing, folder, f"{folder}/checkpoint")
    bronze = medallion.read_bronze(spark, medallion.Lake(folder))
    return bronze.drop("fecha_ingesta", "batch_id")


def _poll(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    """The newest line per key of what was ingested in a span."""
    newest = [F.col("fecha_ingesta").desc(), F.col("raw_json").desc()]
    line = F.to_json(F.struct(*model.REQUIRED_FIELDS), {"ignoreNullFields": "false"})
    seen = F.col("fecha_ingesta").between(start, end)
    rows = _quotes(spark, sf_dir).filter(seen)
    return latest_per_key(rows, model.MERGE_KEYS, newest).withColumn("line", line)


def stream_unchanged_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three runs take and write: a poll, one that overlaps it, and the same again."""
    folder = scratch_dir(spark, "unchanged")
    options = medallion.Options(drop_repeats=True)
    told = []
    for number, (start, end) in enumerate((POLLS[0], POLLS[1], POLLS[1])):
        landing = _land(_poll(spark, sf_dir, start, end), f"{folder}/landing")
        counts = stream_pipeline(
            spark, landing, folder, f"{folder}/checkpoint", options=options
        )
        told.append((number, counts["extracted"], counts["bronze_written"]))
    return spark.createDataFrame(told, "poll int, extracted long, bronze_written long")


# --- The same operators on other tables ---------------------------------------


def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest_per_key(_table(spark, sf_dir, "orders"), ["o_custkey"], newest).select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )


def order_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source brings a column the target lacks, and lacks one the target has."""
    orders = _table(spark, sf_dir, "orders")
    target = orders.filter("o_orderkey % 3 <> 0").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    source = orders.filter("o_orderkey % 3 = 0 OR o_orderkey % 2 = 0").select(
        "o_orderkey",
        "o_custkey",
        F.lower("o_orderstatus").alias("o_orderstatus"),
        "o_orderpriority",
    )
    return upsert(target, source, ["o_orderkey"])


def merge_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target with many rows per key; a source with one for each, and unmatched repeats."""
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    newest = latest_per_key(events, ["user_id", "event_type"], [F.col("event_id").desc()])
    late = events.withColumn("event_type", F.concat("event_type", F.lit(" late")))
    source = newest.withColumn("value", F.col("value") + 1000).unionByName(late)
    return upsert(events, source, ["user_id", "event_type"])


def monthly_lineitem_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    rows = _table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        "l_returnflag",
        "l_quantity",
        cents.alias("cents"),
    )
    return marts.period_metrics(
        rows,
        ["year", "month", "l_returnflag"],
        {
            "n": F.count("*"),
            "avg_quantity": F.avg("l_quantity"),
            "total_cents": F.sum("cents"),
            "min_cents": F.min("cents"),
            "max_cents": F.max("cents"),
        },
        {"range_cents": ("max_cents", "min_cents")},
    )


def supplier_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance of each supplier against supplier 1, for those of its region."""
    suppliers = _table(spark, sf_dir, "supplier")
    nations = _table(spark, sf_dir, "nation")
    placed = suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
    gap = marts.gap_to_reference(
        placed,
        reference=F.col("s_suppkey") == 1,
        measure="s_acctbal",
        applies=F.col("n_regionkey") == 1,
        reference_name="reference_balance",
    )
    return gap.select("s_suppkey", "n_name", "s_acctbal", "reference_balance", "gap_pct")


QUERIES: dict[str, Query] = {
    "bronze_projection": bronze_projection,
    "typed_text": typed_text,
    "typed_numbers_times": typed_numbers_times,
    "quote_measures": quote_measures,
    "quote_key": quote_key,
    "quality_summary": quality_summary,
    "quality_rules": quality_rules,
    "tags_from_table": tags_from_table,
    "silver": silver,
    "latest_quotes": latest_quotes,
    "source_union": source_union,
    "daily_metrics": daily_metrics,
    "nan_prices": nan_prices,
    "official_gap": official_gap,
    "official_gap_no_reference": official_gap_no_reference,
    "newer_than": newer_quotes,
    "high_water": high_water,
    "newer_than_with_ties": newer_than_with_ties,
    "state_round_trip": state_round_trip,
    "upsert_quotes": upsert_quotes,
    "upsert_duplicate_matches": upsert_duplicate_matches,
    "overwrite_then_merge": overwrite_then_merge,
    "bucketed_merge": bucketed_merge,
    "evolving_merge": evolving_merge,
    "merge_changed_only": merge_changed_only,
    "partitioned_round_trip": partitioned_round_trip,
    "partition_rebuild": partition_rebuild,
    "many_months_rebuild": many_months_rebuild,
    "partition_files": partition_files,
    "split_and_validate": split_and_validate,
    "valid_records": valid_records,
    "rejected_records": rejected_records,
    "response_envelopes": response_envelopes,
    "responses_from_files": responses_from_files,
    "landed_bodies": landed_bodies,
    "full_refresh": full_refresh,
    "run_counts": run_counts,
    "empty_increment": empty_increment,
    "quarantined_records": quarantined_records,
    "incremental_refresh": incremental_refresh,
    "incremental_silver": incremental_silver,
    "incremental_latest": incremental_latest,
    "incremental_gap": incremental_gap,
    "marks_per_source": marks_per_source,
    "incremental_new_files": incremental_new_files,
    "stream_available_now": stream_available_now,
    "stream_repeated_snapshots": stream_repeated_snapshots,
    "stream_unchanged_poll": stream_unchanged_poll,
    "latest_order_per_customer": latest_order_per_customer,
    "order_upsert": order_upsert,
    "merge_duplicate_keys": merge_duplicate_keys,
    "monthly_lineitem_metrics": monthly_lineitem_metrics,
    "supplier_gap": supplier_gap,
}
