from __future__ import annotations

from pyspark.sql import functions as F

from strata import model
from strata.operators import marts
from strata.plans import quotes
from strata.sources.event_quotes import event_quotes, read_events

from tests.helpers import SF, bronze, plan_of, rows_of


def valid(spark, *rows):
    return quotes.valid_quotes(quotes.build_silver(bronze(spark, *rows)))


def gap(spark, *rows):
    return {
        (row.venue, row.currency): (row.official_ask, row.official_gap_pct)
        for row in quotes.official_gap(quotes.latest_quotes(valid(spark, *rows))).collect()
    }


def test_usd_only_from_its_own_source(spark):
    rows = valid(
        spark,
        {"origen_datos": "cotizaciones"},
        {"moneda": "eur", "origen_datos": "cotizaciones"},
        {"moneda": "brl"},
        {"moneda": None, "casa": "blue"},
    )
    latest = quotes.latest_quotes(rows).collect()
    assert sorted(row.currency for row in latest) == ["BRL", "EUR", "N/A"]


def test_one_filter_equals_the_union_of_the_arms(spark):
    flagged = quotes.flagged_quotes(event_quotes(read_events(spark, SF)))
    one, two = quotes.prefer_quotes(flagged), quotes.union_quotes(flagged)
    assert rows_of(one) == rows_of(two)
    physical = one._jdf.queryExecution().executedPlan().toString()
    assert physical.count("FileScan") == 1


def test_null_discriminator_drops_out_of_both_forms(spark):
    rows = spark.createDataFrame([(None, "a"), ("x", "a"), ("y", "b")], "c string, s string")
    applies, preferred = F.col("c") == "x", F.col("s") == "a"
    kept = [("x", "a"), ("y", "b")]
    assert rows_of(marts.prefer_source(rows, applies, preferred)) == kept
    assert rows_of(marts.union_preferred(rows, applies, preferred)) == kept


def test_latest_takes_quote_time_then_ingest_time(spark):
    latest = quotes.latest_quotes(
        valid(
            spark,
            {"fechaActualizacion": "2028-09-05T10:00:00Z", "venta": "20"},
            {"fechaActualizacion": "2028-09-06T10:00:00Z", "venta": "30", "moneda": "eur"},
            {
                "fechaActualizacion": "2028-09-06T10:00:00Z",
                "venta": "40",
                "moneda": "eur",
                "origen_datos": "cotizaciones",
                "fecha_ingesta": "2028-09-07T00:00:00Z",
            },
        )
    )
    assert sorted((row.currency, row.ask) for row in latest.collect()) == [("EUR", 40.0), ("USD", 20.0)]
    assert latest.columns == model.SILVER.names


def test_gap(spark):
    found = gap(
        spark,
        {"venta": "100", "compra": "90"},
        {"casa": "blue", "venta": "150", "compra": "140"},
        {"casa": "blue", "moneda": "eur", "venta": "170", "compra": "140"},
    )
    assert found == {
        ("oficial", "USD"): (100.0, 0.0),
        ("blue", "USD"): (100.0, 50.0),
        ("blue", "EUR"): (100.0, None),
    }


def test_gap_without_an_official_row_is_empty(spark):
    assert gap(spark, {"casa": "blue"}) == {}
    assert gap(spark, {"casa": "oficial", "moneda": "eur"}) == {}


def test_gap_to_an_official_ask_of_zero_is_null(spark):
    found = gap(spark, {"venta": "0", "compra": "0"}, {"casa": "blue", "venta": "5", "compra": "4"})
    assert found == {("oficial", "USD"): (0.0, None), ("blue", "USD"): (0.0, None)}


def test_gap_needs_no_join(spark):
    rows = spark.range(10).select("id", F.col("id").cast("double").alias("m"))
    out = marts.gap_to_reference(rows, F.col("id") == 4, "m", F.lit(True))
    plan = plan_of(out)
    assert "Join" not in plan and "Cartesian" not in plan
    assert {row.id: row.gap_pct for row in out.collect()}[8] == 100.0


def test_daily_metrics(spark):
    daily = quotes.daily_metrics(
        valid(
            spark,
            {"fechaActualizacion": "2028-09-05T10:00:00Z", "compra": "10", "venta": "12"},
            {"fechaActualizacion": "2028-09-05T11:00:00Z", "compra": "20", "venta": "26"},
            {"fechaActualizacion": "2028-09-05T12:00:00Z", "compra": "n/d", "venta": "99"},
            {"fechaActualizacion": "2028-09-06T12:00:00Z", "compra": "1", "venta": "1"},
        )
    )
    assert daily.columns == model.DAILY.names
    assert rows_of(daily) == [
        (2028, 9, 5, "oficial", "USD", "dolares", 2, 15.0, 12.0, 26.0, 19.0, 4.0, 14.0),
        (2028, 9, 6, "oficial", "USD", "dolares", 1, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0),
    ]


def test_daily_metrics_aggregate_before_the_shuffle(spark):
    silver = spark.createDataFrame([], model.SILVER)
    plan = quotes.daily_metrics(silver)._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in plan and "SortAggregate" not in plan


def test_latest_from_daily_equals_latest(spark):
    rows = quotes.valid_quotes(quotes.build_silver(event_quotes(read_events(spark, SF))))
    daily = quotes.daily_metrics(rows)
    assert rows_of(quotes.latest_from_daily(rows, daily)) == rows_of(quotes.latest_quotes(rows))
