"""Small builders and checks shared by the tests."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from strata import model

SF = "/root/testdata/sf0.001"


def quote(**fields) -> dict:
    record = {
        "moneda": "USD",
        "casa": "oficial",
        "nombre": "Casa central",
        "compra": 910,
        "venta": 935,
        "fechaActualizacion": "2025-03-14T09:30:00.000Z",
    }
    return record | fields


def bronze(spark: SparkSession, *rows: dict) -> DataFrame:
    """Bronze rows: a complete quote with the given columns replaced."""
    base = {
        "moneda": "USD",
        "casa": "oficial",
        "nombre": "oficial",
        "compra": "10",
        "venta": "12",
        "fechaActualizacion": "2028-09-05T07:15:00.000Z",
        "raw_json": "{}",
        "fecha_ingesta": "2028-09-06T00:00:00+00:00",
        "origen_datos": "dolares",
        "endpoint": "/v1/dolares",
        "modo_extraccion": "full",
        "batch_id": "b0",
    }
    values = [tuple((base | row)[name] for name in model.BRONZE.names) for row in rows]
    return spark.createDataFrame(values, model.BRONZE)


def payloads(spark: SparkSession, *rows: tuple[str, str | None]) -> DataFrame:
    """(source, body) rows with their endpoint."""
    full = [(source, model.ENDPOINTS.get(source), body) for source, body in rows]
    return spark.createDataFrame(full, "source string, endpoint string, body string")


def land(folder: Path, name: str = "0", **sources) -> dict[str, str]:
    """Write one body per source; returns the landing paths."""
    landing = {}
    for source, body in sources.items():
        path = folder / source
        path.mkdir(parents=True, exist_ok=True)
        text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False)
        (path / f"{name}.json").write_text(text, encoding="utf-8")
        landing[source] = str(path)
    return landing


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
