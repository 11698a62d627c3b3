"""Schemas, column names and the fixed values of the quotes model."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

# The contract of the quote source and of the cleaned tables.
REQUIRED_FIELDS = ("moneda", "casa", "nombre", "compra", "venta", "fechaActualizacion")
QUOTE_TIME_FIELD = "fechaActualizacion"
ENDPOINTS = {
    "dolares": "/v1/dolares",
    "cotizaciones": "/v1/cotizaciones",
}
MERGE_KEYS = ("origen_datos", "casa", "moneda", "fechaActualizacion")
TEXT_DEFAULTS = {"venue": "desconocida", "venue_label": "N/A", "currency": "N/A"}
NO_QUOTE_TIME = datetime(1900, 1, 1, tzinfo=timezone.utc)
MARKET_TAGS = {
    "oficial": "regulado,banco,bcra",
    "blue": "paralelo,informal",
    "bolsa": "financiero,merval,mep",
    "contadoconliqui": "financiero,ccl,bursatil",
    "mayorista": "regulado,interbancario",
    "cripto": "digital,crypto",
    "tarjeta": "regulado,impuesto,turismo",
}
OTHER_TAG = "otro"
PREFERRED_CURRENCY = "USD"
PREFERRED_SOURCE = "dolares"
OFFICIAL_VENUE = "oficial"

# Bronze keeps the source's own field names, all text.
BRONZE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            *REQUIRED_FIELDS,
            "raw_json",
            "fecha_ingesta",
            "origen_datos",
            "endpoint",
            "modo_extraccion",
            "batch_id",
        )
    ]
)

_DATE_PARTS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
]

# Bronze as stored: also the day of the quote time, which the merge key fixes, so that
# a merge touches only the days of the batch, and the rebuild after it their months.
BRONZE_LAYOUT = ("year", "month", "day")
BRONZE_STORED = T.StructType(BRONZE.fields + _DATE_PARTS)

SILVER_LAYOUT = ("year", "month", "venue")
SILVER = T.StructType(
    [
        T.StructField("quote_key", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("ingest_mode", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("venue", T.StringType()),
        T.StructField("venue_label", T.StringType()),
        T.StructField("bid", T.DoubleType()),
        T.StructField("ask", T.DoubleType()),
        T.StructField("spread", T.DoubleType()),
        T.StructField("mid", T.DoubleType()),
        T.StructField("spread_pct", T.DoubleType()),
        T.StructField("market_tags", T.StringType()),
        T.StructField("quoted_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("quality_ok", T.BooleanType()),
        *_DATE_PARTS,
        T.StructField("raw_json", T.StringType()),
    ]
)

LATEST = SILVER

DAILY_LAYOUT = ("year", "month")
DAILY_KEYS = ("year", "month", "day", "venue", "currency", "source")
DAILY = T.StructType(
    [
        *_DATE_PARTS,
        T.StructField("venue", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("quotes", T.LongType()),
        T.StructField("avg_bid", T.DoubleType()),
        T.StructField("min_ask", T.DoubleType()),
        T.StructField("max_ask", T.DoubleType()),
        T.StructField("avg_ask", T.DoubleType()),
        T.StructField("avg_spread", T.DoubleType()),
        T.StructField("ask_range", T.DoubleType()),
    ]
)

GAP = T.StructType(
    [
        T.StructField("venue", T.StringType()),
        T.StructField("venue_label", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("ask", T.DoubleType()),
        T.StructField("official_ask", T.DoubleType()),
        T.StructField("official_gap_pct", T.DoubleType()),
        T.StructField("spread", T.DoubleType()),
        T.StructField("spread_pct", T.DoubleType()),
        T.StructField("quoted_at", T.TimestampType()),
    ]
)

# Rows of Silver per month, all and valid ones, so that no run counts them all.
COUNTS_LAYOUT = ("year", "month")
COUNTS = T.StructType(
    [
        *_DATE_PARTS[:2],
        T.StructField("silver", T.LongType()),
        T.StructField("valid", T.LongType()),
    ]
)

# Run state: field names are a fixed format, shared with readers of the state file.
STATE = T.StructType(
    [
        T.StructField(name, T.LongType() if name == "last_records" else T.StringType())
        for name in ("watermark", "watermark_field", "last_run_at", "last_mode", "last_records")
    ]
)
