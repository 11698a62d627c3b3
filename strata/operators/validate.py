"""Checks on landed responses, payloads and records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.jsontext import (
    absent_keys,
    is_json,
    json_elements,
    json_members,
    stripped,
)
from strata.model import REQUIRED_FIELDS


VERDICT = ("reject_reason", "missing", "bad_payload")


class RejectedInput(RuntimeError):
    """The input as a whole may not be loaded."""


def check_envelope(responses: DataFrame) -> DataFrame:
    """Add ``reject_reason`` and ``warning`` to (status, content_type, body) rows.

    A status other than 200 or a body that is not JSON rejects; an unexpected
    content type only warns.
    """
    status, kind, body = F.col("status"), F.col("content_type"), F.col("body")
    reason = F.when(
        ~status.eqNullSafe(F.lit(200)),
        F.concat_ws("", F.lit("HTTP "), status.cast("string"), F.lit(": "), F.left(body, F.lit(200))),
    ).when(~is_json(body), F.lit("not_json"))
    odd_kind = (kind != "") & ~F.lower(kind).contains("json")
    return responses.withColumns(
        {
            "reject_reason": reason,
            "warning": F.when(reason.isNull() & odd_kind, F.concat(F.lit("content type "), kind)),
        }
    )


def split_payload(payloads: DataFrame, body: str = "body") -> DataFrame:
    """One row per record: ``raw`` replaces the body, ``payload_reason`` is added.

    An array gives its elements, anything else is a list of one. A payload that
    holds no records keeps one row, so its source is not lost from the counts. A
    ``reject_reason`` from :func:`check_envelope` is carried on.
    """
    text, elements = F.col(body), F.col("_elements")
    reason = (
        F.when(text.isNull() | (stripped(text) == "null"), F.lit("null_payload"))
        .when(F.size(elements) == 0, F.lit("empty_payload"))
        .when(~is_json(text), F.lit("not_json"))
    )
    if "reject_reason" in payloads.columns:
        reason = F.coalesce("reject_reason", reason)
    return (
        payloads.withColumn("_elements", json_elements(text))
        .withColumns({"payload_reason": reason, "_items": F.coalesce(elements, F.array(text))})
        .drop(body, "reject_reason", "_elements")
        .withColumn("raw", F.explode_outer("_items"))
        .drop("_items")
    )


def check_records(
    records: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, members: str | None = None
) -> DataFrame:
    """Judge split payloads: ``reject_reason`` (NULL if valid), ``missing``, the
    absent keys, and ``bad_payload``, which is not a record but a whole payload.

    A column named ``members`` keeps the parsed record for later steps.
    """
    absent, parsed = F.col("_absent"), members or "_members"
    checked = (
        records.withColumn(parsed, json_members(F.col("raw")))
        .withColumn("_absent", absent_keys(F.col(parsed), required))
        .withColumn(
            "reject_reason",
            F.coalesce(
                "payload_reason",
                F.when(absent.isNull(), F.lit("not_object")).when(
                    F.size(absent) > 0, F.lit("missing_fields")
                ),
            ),
        )
        .withColumns(
            {
                "missing": F.when(
                    F.col("reject_reason") == "missing_fields", F.array_join(absent, ",")
                ),
                "bad_payload": F.col("payload_reason").isNotNull(),
            }
        )
        .drop("payload_reason", "_absent")
    )
    return checked if members else checked.drop(parsed)


def valid_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull()).drop(*VERDICT)


def rejected_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull())


COUNTS = ("received", "valid", "discarded", "bad_payloads", "problem")


def _counts(of: Column) -> list[Column]:
    """Aggregates over the rows that ``of`` holds for, in the order of COUNTS."""
    bad, reason = of & F.col("bad_payload"), F.col("reject_reason")
    record = of & ~F.col("bad_payload")
    return [
        F.count_if(record),
        F.count_if(of & reason.isNull()),
        F.count_if(record & reason.isNotNull()),
        F.count_if(bad),
        F.min(F.when(bad, reason)),
    ]


def source_counts(checked: DataFrame, by: str | Column = "source") -> DataFrame:
    """Per source: records received, valid and discarded, and bad payloads."""
    counts = zip(_counts(F.lit(True)), COUNTS, strict=True)
    return checked.groupBy(by).agg(*[count.alias(name) for count, name in counts])


def observe_sources(
    checked: DataFrame, seen: Observation, known: Sequence[str], *others: Column
) -> DataFrame:
    """Count per known source while the rows pass; :func:`observed_sources` has the result.

    What came under no known source is counted too, in one. ``others`` are further
    aggregates, observed under their own names.
    """
    own = [F.coalesce(F.col("source") == name, F.lit(False)) for name in known]
    none = ~F.coalesce(F.col("source").isin(*known), F.lit(False))
    metrics = [
        count.alias(f"{name}_{n}")
        for n, of in enumerate([*own, none])
        for count, name in zip(_counts(of), COUNTS, strict=True)
    ]
    return checked.observe(seen, *metrics, *others)


def observed_sources(
    seen: Mapping[str, Any], known: Sequence[str]
) -> dict[str | None, dict[str, Any]]:
    """Counts by source; a source without any row is left out, an unknown one is None."""
    counts = {
        source: {name: seen[f"{name}_{n}"] for name in COUNTS}
        for n, source in enumerate([*known, None])
    }
    return {s: own for s, own in counts.items() if own["received"] or own["bad_payloads"]}


def expect_valid_per_source(
    counts: Mapping[str, Mapping[str, Any]],
    required: Iterable[str] = (),
    whole_payloads: bool = True,
) -> None:
    """Raise unless every source brought a valid record.

    Where a body is one whole response, one bad response spoils the source; where
    each line is a record of its own, a bad line is only discarded. A count of bad
    payloads comes with a ``problem``, the reason of one of them. What came under no
    known source is counted under None.
    """
    if None in counts:
        raise RejectedInput("records of a source that is not configured")
    for source in sorted({*required, *counts}):
        seen = counts.get(source, {})
        if whole_payloads and seen.get("bad_payloads", 0):
            raise RejectedInput(
                f"{source}: {seen['bad_payloads']} bad payloads, one is: {seen['problem']}"
            )
        if not seen.get("valid", 0):
            raise RejectedInput(f"{source}: none of {seen.get('received', 0)} records is valid")
