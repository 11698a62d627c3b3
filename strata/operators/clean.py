"""Bronze text to typed, keyed and flagged rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.lookup import tag_lookup
from strata.functions.times import date_parts, parse_utc
from strata.model import MARKET_TAGS, NO_QUOTE_TIME, OTHER_TAG, QUOTE_TIME_FIELD, TEXT_DEFAULTS


def typed_quotes(bronze: DataFrame) -> DataFrame:
    """Rename, normalise text, and type. Unreadable numbers and times become NULL."""
    return bronze.select(
        F.col("origen_datos").alias("source"),
        "endpoint",
        F.col("modo_extraccion").alias("ingest_mode"),
        "batch_id",
        F.upper(F.trim("moneda")).alias("currency"),
        F.lower(F.trim("casa")).alias("venue"),
        F.initcap(F.trim("nombre")).alias("venue_label"),
        F.col("compra").try_cast("double").alias("bid"),
        F.col("venta").try_cast("double").alias("ask"),
        parse_utc(F.col(QUOTE_TIME_FIELD)).alias("quoted_at"),
        parse_utc(F.col("fecha_ingesta")).alias("ingested_at"),
        "raw_json",
    )


def fill_defaults(
    quotes: DataFrame, texts: Mapping[str, str] = TEXT_DEFAULTS, ts: str = "quoted_at"
) -> DataFrame:
    """Defaults for NULL text, and the sentinel for a NULL time; '' stays."""
    return quotes.fillna(dict(texts)).withColumn(ts, F.coalesce(ts, F.lit(NO_QUOTE_TIME)))


def with_measures(quotes: DataFrame) -> DataFrame:
    """Spread, mid price, spread in percent of the bid, market tags, date parts."""
    bid, ask = F.col("bid"), F.col("ask")
    spread = ask - bid
    return quotes.withColumns(
        {
            "spread": spread,
            "mid": (ask + bid) / F.lit(2.0),
            "spread_pct": F.when(bid > 0, spread / bid * F.lit(100.0)),
            "market_tags": tag_lookup(F.col("venue"), MARKET_TAGS, OTHER_TAG),
            **date_parts(F.col("quoted_at")),
        }
    )


def with_natural_key(df: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    """The parts as text joined by a bar; NULL parts are skipped."""
    return df.withColumn(name, F.concat_ws("|", *[F.col(part).cast("string") for part in parts]))


def quote_rules() -> dict[str, Column]:
    """What makes a quote bad."""
    bid, ask = F.col("bid"), F.col("ask")
    return {
        "no_bid": bid.isNull(),
        "no_ask": ask.isNull(),
        "negative_bid": bid < 0,
        "negative_ask": ask < 0,
        "ask_below_bid": ask < bid,
        "no_quote_time": F.col("quoted_at") == F.lit(NO_QUOTE_TIME),
    }


def nan_rules() -> dict[str, Column]:
    """Opt-in: a NaN ask passes the standard rules, as NaN sorts above all numbers."""
    return {"nan_bid": F.isnan("bid"), "nan_ask": F.isnan("ask")}


def quality_flag(df: DataFrame, rules: Mapping[str, Column], name: str = "quality_ok") -> DataFrame:
    """True where no rule holds. Never NULL, and no row is dropped."""
    broken = reduce(lambda left, right: left | right, rules.values())
    return df.withColumn(name, ~F.coalesce(broken, F.lit(False)))


def broken_rules(df: DataFrame, rules: Mapping[str, Column], name: str = "broken") -> DataFrame:
    """The names of the rules that hold, comma-separated, '' if none does."""
    return df.withColumn(
        name, F.concat_ws(",", *[F.when(rule, F.lit(label)) for label, rule in rules.items()])
    )
