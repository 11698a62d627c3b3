"""Bronze-shaped quotes derived from the given ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.model import BRONZE


def _every(divisor: int) -> Column:
    return F.col("event_id") % divisor == 0


def _iso(ts: Column, tail: str) -> Column:
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit(tail))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_quotes(events: DataFrame) -> DataFrame:
    """Prices are multiples of 0.25, so sums of them are exact in any order."""
    from_dolares = _every(3)
    currency = (
        F.when(_every(101), F.lit(None))
        .when(F.col("user_id") % 4 == 0, " eur ")
        .when(F.col("user_id") % 4 == 1, "Brl")
        .otherwise("usd")
    )
    kind = F.col("event_type")
    venue = (
        F.when(_every(97), F.lit(None))
        .when(kind == "view", " Oficial")
        .when(kind == "click", "BLUE")
        .when(kind == "purchase", "bolsa")
        .when(kind == "signup", "Cripto")
        .otherwise("tarjeta ")
    )
    bid = F.floor(F.col("value") * 4) / 4
    ask = F.floor(F.col("value") * 5) / 4 - F.col("event_id") % 7
    quoted = (
        F.when(_every(83), "garbage")
        .when(_every(73), F.lit(None))
        .otherwise(_iso(F.date_trunc("hour", "ts").cast("timestamp_ntz"), ".000Z"))
    )
    return events.select(
        currency.alias("moneda"),
        venue.alias("casa"),
        F.when(~_every(103), F.concat(F.lit("casa "), kind)).alias("nombre"),
        F.when(_every(89), "n/d").when(~_every(79), bid.cast("string")).alias("compra"),
        ask.cast("string").alias("venta"),
        quoted.alias("fechaActualizacion"),
        F.col("props").alias("raw_json"),
        _iso(F.col("ts"), "+00:00").alias("fecha_ingesta"),
        F.when(from_dolares, "dolares").otherwise("cotizaciones").alias("origen_datos"),
        F.when(from_dolares, "/v1/dolares").otherwise("/v1/cotizaciones").alias("endpoint"),
        F.lit("full").alias("modo_extraccion"),
        F.lit("b0").alias("batch_id"),
    ).select(*BRONZE.names)
