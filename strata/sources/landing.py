"""Landed files as payload rows, in bulk or as a stream."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.jsontext import stripped
from strata.model import ENDPOINTS
from strata.sources.file_marks import unread

RESPONSE_SCHEMA = "source string, endpoint string, status int, content_type string, body string"


def landed_payloads(
    spark: SparkSession,
    landing: Mapping[str, str],
    whole_payloads: bool = False,
    endpoints: Mapping[str, str] = ENDPOINTS,
    stream: bool = False,
    marks: Mapping[str, datetime] | None = None,
) -> DataFrame:
    """(source, endpoint, body) from one path per source, and where it came from.

    A line is a body, so Spark splits large files. ``whole_payloads`` reads each file
    as one response body instead: one row, bound by what a task holds. ``landing`` is the
    path, ``landed_at`` and ``landed_as`` are the file's time and name. Files older than
    the mark of their path are not read.
    """
    reader = spark.readStream if stream else spark.read
    parts = []
    for source, path in landing.items():
        files = reader.format("text").option("wholetext", whole_payloads).load(path)
        parts.append(
            unread(files, path, marks or {}).select(
                F.lit(source).alias("source"),
                F.lit(endpoints.get(source)).alias("endpoint"),
                F.col("value").alias("body"),
                *_whence(path),
            )
        )
    payloads = reduce(DataFrame.unionByName, parts)
    return payloads if whole_payloads else payloads.filter(stripped(F.col("body")) != "")


def landed_responses(
    spark: SparkSession, path: str, marks: Mapping[str, datetime] | None = None
) -> DataFrame:
    """Responses landed with their envelope, one JSON object per line."""
    rows = spark.read.schema(RESPONSE_SCHEMA).json(path)
    return unread(rows, path, marks or {}).select(*rows.columns, *_whence(path))


def _whence(path: str) -> list[Column]:
    return [
        F.lit(path).alias("landing"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_as"),
    ]
