from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from strata import model
from strata.functions.lookup import tag_lookup
from strata.operators import clean
from strata.operators.rank import latest_per_key
from strata.plans import quotes

from tests.helpers import bronze, plan_of


def silver_row(spark, **fields):
    return quotes.build_silver(bronze(spark, fields)).first()


def test_text_is_trimmed_of_spaces_and_cased(spark):
    row = silver_row(spark, moneda=" usd ", casa=" BLUE", nombre="dólar bolsa-mep  ")
    assert (row.currency, row.venue, row.venue_label) == ("USD", "blue", "Dólar Bolsa-mep")
    assert silver_row(spark, casa="blue\t").venue == "blue\t"


def test_null_text_gets_defaults_and_empty_text_stays(spark):
    row = silver_row(spark, moneda=None, casa=None, nombre=None)
    assert (row.currency, row.venue, row.venue_label) == ("N/A", "desconocida", "N/A")
    row = silver_row(spark, moneda="", casa="", nombre="")
    assert (row.currency, row.venue, row.venue_label) == ("", "", "")


@pytest.mark.parametrize("text", ["n/d", "", "1,450", None])
def test_unreadable_price_is_null_and_flagged(spark, text):
    row = silver_row(spark, compra=text)
    assert row.bid is None
    assert row.quality_ok is False
    assert row.spread is None


@pytest.mark.parametrize("text", ["garbage", None, "07:15", "2031"])
def test_unreadable_time_is_the_sentinel_and_flagged(spark, text):
    row = silver_row(spark, fechaActualizacion=text)
    assert (row.year, row.month, row.day) == (1900, 1, 1)
    assert row.quality_ok is False
    assert row.quote_key == "dolares|oficial|USD|1900-01-01 00:00:00"


def test_measures(spark):
    row = silver_row(spark, compra="10", venta="12")
    assert (row.spread, row.mid, row.spread_pct) == (2.0, 11.0, 20.0)
    assert (row.year, row.month, row.day) == (2028, 9, 5)
    assert row.market_tags == "regulado,banco,bcra"
    assert row.quality_ok is True


def test_zero_bid_is_valid_without_a_percentage(spark):
    row = silver_row(spark, compra="0", venta="1")
    assert row.quality_ok is True
    assert row.spread_pct is None


@pytest.mark.parametrize(("bid", "ask"), [("-1", "1"), ("-3", "-2"), ("10", "9")])
def test_bad_prices_are_flagged_not_removed(spark, bid, ask):
    assert silver_row(spark, compra=bid, venta=ask).quality_ok is False


def test_nan_ask_passes_and_nan_bid_fails_unless_the_nan_rules_are_added(spark):
    assert silver_row(spark, venta="NaN").quality_ok is True
    assert silver_row(spark, compra="NaN").quality_ok is False
    assert math.isnan(silver_row(spark, venta="NaN").spread)
    flagged = quotes.flagged_quotes(bronze(spark, {"venta": "NaN"}))
    strict = clean.quality_flag(flagged, clean.quote_rules() | clean.nan_rules())
    assert strict.first().quality_ok is False


def test_broken_rules_are_named(spark):
    flagged = quotes.flagged_quotes(bronze(spark, {"compra": "5", "venta": "-2"}))
    named = clean.broken_rules(flagged, clean.quote_rules()).first()
    assert named.broken == "negative_ask,ask_below_bid"


def test_flag_is_never_null(spark):
    rows = spark.createDataFrame([(None,), (1,)], "n int")
    flags = clean.quality_flag(rows, {"big": F.col("n") > 5}, "fine").collect()
    assert [row.fine for row in flags] == [True, True]


def test_null_key_parts_are_skipped(spark):
    assert silver_row(spark, origen_datos=None).quote_key == "oficial|USD|2028-09-05 07:15:00"


def test_tag_lookup(spark):
    rows = spark.createDataFrame([("cripto",), ("other",), (None,)], "v string")
    tags = rows.select(tag_lookup(F.col("v"), model.MARKET_TAGS, model.OTHER_TAG)).collect()
    assert [row[0] for row in tags] == ["digital,crypto", "otro", "otro"]


def test_newest_ingest_wins_even_if_invalid(spark):
    rows = bronze(
        spark,
        {"fecha_ingesta": "2028-09-06T00:00:00+00:00"},
        {"fecha_ingesta": "2028-09-07T00:00:00+00:00", "compra": "n/d", "casa": " Oficial"},
        {"fecha_ingesta": None},
    )
    silver = quotes.build_silver(rows)
    assert silver.count() == 1
    assert silver.first().bid is None
    assert quotes.valid_quotes(silver).count() == 0


def test_ties_have_one_winner_whatever_the_partitioning(spark):
    rows = [{"raw_json": f"r{n:02}", "compra": str(n % 12)} for n in range(40)]
    winners = {
        quotes.build_silver(bronze(spark, *order).repartition(parts)).first().raw_json
        for order in (rows, rows[::-1])
        for parts in (1, 3, 8)
    }
    assert winners == {"r39"}


def test_silver_contract(spark):
    silver = quotes.build_silver(bronze(spark, {}))
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in model.SILVER
    ]


def test_latest_per_key_limits_before_the_shuffle(spark):
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    newest = latest_per_key(rows, ["k"], [F.col("id").desc()])
    plan = plan_of(newest)
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning") < partial
    assert sorted(row.id for row in newest.collect()) == list(range(93, 100))


def test_silver_is_one_shuffle_without_python(spark):
    plan = quotes.build_silver(bronze(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "BatchEval" not in plan
