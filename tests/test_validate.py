from __future__ import annotations

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from strata.functions.jsontext import is_json
from strata.operators import validate
from strata.operators.bronze import Batch, to_bronze, with_fields

from tests.helpers import payloads, quote


SOURCES = ["dolares", "cotizaciones"]


def checked(spark, *rows):
    return validate.check_records(validate.split_payload(payloads(spark, *rows)))


def count_sources(checked, known):
    """The counts that are observed as the records are written."""
    seen = Observation()
    counted = validate.observe_sources(checked, seen, known)
    counted.write.format("noop").mode("overwrite").save()
    return validate.observed_sources(seen.get, known)


def verdicts(df):
    return sorted((row.raw or "", row.reject_reason or "", row.missing or "") for row in df.collect())


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ('{"a": 1}', True),
        ('{"a": 1, "a": 2}', True),
        ("[1, null]", True),
        ("[]", True),
        ("null", True),
        ('"text"', True),
        ("-1.5e3", True),
        ("  {} \n", True),
        ("{} junk", False),
        ("1, 2", False),
        ("1],[2", False),
        ('1, "x": 2', False),
        ("[1", False),
        ("", False),
        ("bad", False),
        (None, False),
        ("\n\t [1]\r\n", True),
        ('1,"after":2} junk', False),
        ('1,"after":0}', False),
        ("1]", False),
        ("1}", False),
        ('{"a":1}],[{"b":2}', False),
    ],
)
def test_is_json(spark, text, valid):
    rows = spark.createDataFrame([(text,)], "body string")
    assert rows.select(is_json(F.col("body"))).first()[0] is valid


def test_complete_records_are_kept(spark):
    body = json.dumps([quote(), quote(casa="blue")])
    assert validate.valid_records(checked(spark, ("dolares", body))).count() == 2


def test_incomplete_records_are_set_aside_with_the_absent_fields(spark):
    partial = {name: 1 for name in ("nombre", "compra", "fechaActualizacion")}
    rows = checked(spark, ("dolares", json.dumps([partial, quote(), {}])))
    assert validate.valid_records(rows).count() == 1
    rejected = validate.rejected_records(rows).collect()
    assert {row.reject_reason for row in rejected} == {"missing_fields"}
    assert {row.missing for row in rejected} == {
        "moneda,casa,venta",
        "moneda,casa,nombre,compra,venta,fechaActualizacion",
    }


def test_explicit_null_counts_as_present(spark):
    rows = checked(spark, ("dolares", json.dumps(quote(compra=None))))
    assert validate.valid_records(rows).count() == 1


def test_lone_object_is_a_list_of_one(spark):
    assert validate.valid_records(checked(spark, ("dolares", json.dumps(quote())))).count() == 1


def test_elements_that_are_no_objects(spark):
    body = json.dumps([1, quote(), None, [quote()]])
    rows = checked(spark, ("dolares", body))
    assert validate.valid_records(rows).count() == 1
    reasons = [row.reject_reason for row in validate.rejected_records(rows).collect()]
    assert reasons == ["not_object"] * 3


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        ("[]", "empty_payload"),
        ("\t[\n]\r\n", "empty_payload"),
        ("null", "null_payload"),
        ("\nnull\n", "null_payload"),
        (None, "null_payload"),
        ("bad", "not_json"),
    ],
)
def test_payloads_without_records_keep_their_source(spark, body, reason):
    counts = count_sources(
        checked(spark, ("dolares", json.dumps([quote()])), ("cotizaciones", body)), SOURCES
    )
    assert counts["cotizaciones"]["bad_payloads"] == 1
    assert counts["cotizaciones"]["problem"] == reason
    assert counts["cotizaciones"]["received"] == 0
    with pytest.raises(validate.RejectedInput, match=reason):
        validate.expect_valid_per_source(counts)


def test_valid_and_discarded_add_up_to_received(spark):
    body = json.dumps([quote(), 1, None, {"casa": "blue"}, quote(casa="blue")])
    counts = count_sources(checked(spark, ("dolares", body)), SOURCES)["dolares"]
    assert (counts["received"], counts["valid"], counts["discarded"]) == (5, 2, 3)


def test_source_without_a_valid_record_stops_the_run(spark):
    counts = count_sources(
        checked(spark, ("dolares", json.dumps([quote()])), ("cotizaciones", '[{"casa": "blue"}]')),
        SOURCES,
    )
    with pytest.raises(validate.RejectedInput, match="cotizaciones: none of 1"):
        validate.expect_valid_per_source(counts)


def test_source_that_brought_nothing_stops_the_run(spark):
    counts = count_sources(checked(spark, ("dolares", json.dumps([quote()]))), SOURCES)
    with pytest.raises(validate.RejectedInput, match="cotizaciones"):
        validate.expect_valid_per_source(counts, ["dolares", "cotizaciones"])


def test_a_bad_line_spoils_only_itself(spark):
    counts = count_sources(
        checked(spark, ("dolares", json.dumps(quote())), ("dolares", "bad")), SOURCES
    )
    validate.expect_valid_per_source(counts, whole_payloads=False)
    with pytest.raises(validate.RejectedInput):
        validate.expect_valid_per_source(counts)


def envelope(spark, *rows):
    frame = spark.createDataFrame(rows, "status int, content_type string, body string")
    return [(row.reject_reason, row.warning) for row in validate.check_envelope(frame).collect()]


def test_envelope(spark):
    long_body = "x" * 500
    assert envelope(
        spark,
        (200, "application/json", "[]"),
        (200, "Application/JSON; charset=utf-8", "{}"),
        (200, "", "{}"),
        (200, None, "{}"),
        (200, "text/html", "{}"),
        (200, "application/json", "<html>"),
        (200, "application/json", None),
        (429, "text/plain", "slow down"),
        (404, "application/json", long_body),
        (None, "application/json", "[]"),
    ) == [
        (None, None),
        (None, None),
        (None, None),
        (None, None),
        (None, "content type text/html"),
        ("not_json", None),
        ("not_json", None),
        ("HTTP 429: slow down", None),
        ("HTTP 404: " + "x" * 200, None),
        ("HTTP : []", None),
    ]


def test_bronze_projection(spark):
    body = (
        '{"moneda":"USD","casa":"bolsa","nombre":"Añejo","compra":77.25,"venta":null,'
        '"fechaActualizacion":"2025-11-02T04:05:06.000Z","more":[{"b":null}]}'
    )
    batch = Batch("full", "b9")
    valid = validate.valid_records(checked(spark, ("dolares", f"[{body}]")))
    row = to_bronze(with_fields(valid), batch).first()
    assert float(row.compra) == 77.25
    assert row.venta is None
    assert json.loads(row.raw_json) == json.loads(body)
    assert "Añejo" in row.raw_json
    assert (row.origen_datos, row.endpoint) == ("dolares", "/v1/dolares")
    assert (row.modo_extraccion, row.batch_id) == ("full", "b9")
    assert row.fecha_ingesta == batch.ingested_at.isoformat()


def test_record_names_its_own_lineage_where_the_landing_did_not(spark):
    body = json.dumps(quote(endpoint="/v2/x", origen_datos="own"))
    split = validate.split_payload(payloads(spark, ("unlisted", body), (None, body)))
    valid = validate.valid_records(validate.check_records(split))
    rows = to_bronze(with_fields(valid), Batch("full")).orderBy("origen_datos").collect()
    assert [(row.origen_datos, row.endpoint) for row in rows] == [
        ("own", "/v2/x"),
        ("unlisted", "/v2/x"),
    ]
