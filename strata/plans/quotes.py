"""The quotes model as one configuration of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import model
from strata.functions.lookup import tags_joined
from strata.functions.times import parse_utc
from strata.operators import clean, marts
from strata.operators.rank import latest_per_key

#: Where records without a readable time are stored: under the sentinel month, dealt
#: over its days by their merge key, so that a batch rewrites a share of them.
TIMELESS_DAYS = 28


def with_days(bronze: DataFrame) -> DataFrame:
    """Add the stored layout of Bronze: year, month and day of the quote time."""
    quoted_at = parse_utc(F.col(model.QUOTE_TIME_FIELD))
    filled = F.coalesce(quoted_at, F.lit(model.NO_QUOTE_TIME))
    share = F.pmod(F.xxhash64(*model.MERGE_KEYS), F.lit(TIMELESS_DAYS)).cast("int") + 1
    return bronze.withColumns(
        {
            "year": F.year(filled),
            "month": F.month(filled),
            "day": F.when(quoted_at.isNull(), share).otherwise(F.dayofmonth(filled)),
        }
    )


def newest_snapshot(records: DataFrame) -> DataFrame:
    """One record per merge key: of the file landed last, then by path and raw text.

    A landing folder holds many snapshots, and each repeats quotes that did not change.
    """
    newest = [F.col(name).desc_nulls_last() for name in ("landed_at", "landed_as", "raw")]
    keyed = records.withColumn("origen_datos", F.col("source"))
    return latest_per_key(keyed, model.MERGE_KEYS, newest).drop("origen_datos")


def flagged_quotes(
    bronze: DataFrame, tags: DataFrame | None = None, nan_is_bad: bool = False
) -> DataFrame:
    """Typed, filled, measured, keyed and flagged; not yet deduplicated.

    ``tags`` is a table (value, tag) to take the place of the fixed market tags.
    ``nan_is_bad`` adds the rules on NaN prices, which otherwise spoil averages.
    """
    rules = clean.quote_rules() | (clean.nan_rules() if nan_is_bad else {})
    measured = clean.typed_quotes(bronze).transform(clean.fill_defaults).transform(clean.with_measures)
    if tags is not None:
        measured = tags_joined(measured, "venue", tags, model.OTHER_TAG, "market_tags")
    return measured.transform(
        clean.with_natural_key, "quote_key", ["source", "venue", "currency", "quoted_at"]
    ).transform(clean.quality_flag, rules)


def build_silver(
    bronze: DataFrame, tags: DataFrame | None = None, nan_is_bad: bool = False
) -> DataFrame:
    """One row per quote key, the newest ingested, valid or not.

    The key ends in the quote time, so ranking within both is the same; it lets
    the sort compare a number before it compares texts with a common start.
    """
    newest = [
        F.col("ingested_at").desc_nulls_last(),
        F.col("batch_id").desc_nulls_last(),
        F.col("raw_json").desc_nulls_last(),
    ]
    silver = latest_per_key(
        flagged_quotes(bronze, tags, nan_is_bad), ["quoted_at", "quote_key"], newest
    )
    return silver.select(*model.SILVER.names)


def valid_quotes(silver: DataFrame) -> DataFrame:
    return silver.filter("quality_ok")


def _preferred() -> tuple[Column, Column]:
    return (
        F.col("currency") == model.PREFERRED_CURRENCY,
        F.col("source") == model.PREFERRED_SOURCE,
    )


def prefer_quotes(quotes: DataFrame) -> DataFrame:
    """USD from its own source only, other currencies from any."""
    return marts.prefer_source(quotes, *_preferred())


def union_quotes(quotes: DataFrame) -> DataFrame:
    return marts.union_preferred(quotes, *_preferred())


def latest_quotes(valid: DataFrame) -> DataFrame:
    """The newest preferred quote per venue and currency."""
    newest = [
        F.col("quoted_at").desc(),
        F.col("ingested_at").desc_nulls_last(),
        F.col("quote_key").desc(),
    ]
    return latest_per_key(prefer_quotes(valid), ["venue", "currency"], newest)


def latest_from_daily(valid: DataFrame, daily: DataFrame) -> DataFrame:
    """:func:`latest_quotes`, reading only the months that can hold a winner.

    The daily mart knows the last day of each market, so the stored quotes are
    pruned to those months and days before whole rows are read and ranked.
    """
    last_day = latest_per_key(
        prefer_quotes(daily),
        ["venue", "currency"],
        [F.col(part).desc() for part in ("year", "month", "day")],
    ).select("year", "month", "day", "venue", "currency")
    # The filter on the small side lets Spark prune the scan by what it broadcasts.
    candidates = valid.join(last_day.filter("year > 0"), last_day.columns, "left_semi")
    return latest_quotes(candidates.select(*valid.columns))


def daily_metrics(valid: DataFrame) -> DataFrame:
    return marts.period_metrics(
        valid,
        model.DAILY_KEYS,
        {
            "quotes": F.count("*"),
            "avg_bid": F.avg("bid"),
            "min_ask": F.min("ask"),
            "max_ask": F.max("ask"),
            "avg_ask": F.avg("ask"),
            "avg_spread": F.avg("spread"),
        },
        {"ask_range": ("max_ask", "min_ask")},
    )


def official_gap(latest: DataFrame) -> DataFrame:
    """Each market's ask against the official USD ask."""
    usd = F.col("currency") == model.PREFERRED_CURRENCY
    return marts.gap_to_reference(
        latest,
        reference=(F.col("venue") == model.OFFICIAL_VENUE) & usd,
        measure="ask",
        applies=usd,
        reference_name="official_ask",
        gap_name="official_gap_pct",
    ).select(*model.GAP.names)
