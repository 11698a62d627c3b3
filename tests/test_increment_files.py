"""Increments that read only new files, and marks that keep their ties."""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone
from functools import partial

import pytest
from pyspark.sql import functions as F

from strata.functions.times import parse_utc
from strata.operators.increment import keys_at, newer_with_ties
from strata.operators.validate import RejectedInput
from strata.plans import medallion
from strata.plans.medallion import Lake, Options, read_bronze, read_silver
from strata.sources import file_marks, state

from tests.helpers import land, quote

run_pipeline = partial(medallion.run_pipeline, whole_payloads=True)


def day(n, **fields):
    return quote(fechaActualizacion=f"2028-09-{n:02}T10:00:00.000Z", **fields)


def aged(folder, name, seconds):
    """Set the time of a landed file."""
    for source in ("dolares", "cotizaciones"):
        path = folder / source / f"{name}.json"
        if path.exists():
            os.utime(path, (seconds, seconds))


def test_an_increment_does_not_touch_old_files(spark, tmp_path):
    """The old files turn to junk that would stop a run which read them."""
    root, folder = str(tmp_path / "lake"), tmp_path / "l"
    landing = land(folder, "0", dolares=[day(4)], cotizaciones=[day(4, moneda="EUR")])
    aged(folder, "0", 1_000_000)
    run_pipeline(spark, "full", landing, root)
    land(folder, "0", dolares="junk", cotizaciones="junk")
    aged(folder, "0", 1_000_000 - 1)
    land(folder, "1", dolares=[day(6)], cotizaciones=[day(5, moneda="EUR")])
    aged(folder, "1", 1_000_100)
    assert run_pipeline(spark, "incremental", landing, root)["extracted"] == 2
    assert read_silver(spark, Lake(root)).count() == 4
    options = Options(whole_payloads=True, new_files_only=False)
    with pytest.raises(RejectedInput, match="not_json"):
        run_pipeline(spark, "incremental", landing, root, options=options)


def test_the_scan_prunes_old_files(spark, tmp_path):
    root, folder = str(tmp_path / "lake"), tmp_path / "l"
    for n in range(5):
        landing = land(folder, str(n), dolares=[day(n + 1)], cotizaciones=[day(n + 1)])
        aged(folder, str(n), 1_000_000 + n)
    run_pipeline(spark, "full", landing, root)
    land(folder, "new", dolares=[day(9)], cotizaciones=[day(9)])
    aged(folder, "new", 1_000_050)
    payloads, before = medallion.read_landing(spark, landing, Lake(root), whole_payloads=True)
    assert before == set(landing)
    rows = payloads.collect()
    assert {row.landed_as.rsplit("/", 1)[1] for row in rows} == {"new.json"} and len(rows) == 2
    marks = file_marks.file_times(file_marks.read_files(spark, Lake(root).files), [*landing.values()])
    assert set(marks.values()) == {datetime.fromtimestamp(1_000_004, timezone.utc)}
    scanned = file_marks.unread(
        spark.read.text(landing["dolares"]), landing["dolares"], marks
    ).select("_metadata.file_path")
    scanned.collect()
    read = scanned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert read.metrics().apply("numFiles").value() == 2  # the new one, and the one at the mark


def test_files_of_the_very_time_of_the_mark_are_told_by_name(spark, tmp_path):
    root, folder = str(tmp_path / "lake"), tmp_path / "l"
    landing = land(folder, "0", dolares=[day(4)], cotizaciones=[day(4)])
    aged(folder, "0", 1_000_000)
    run_pipeline(spark, "full", landing, root)
    land(folder, "1", dolares=[day(5)], cotizaciones=[day(6)])
    aged(folder, "1", 1_000_000)
    assert run_pipeline(spark, "incremental", landing, root)["extracted"] == 2
    assert run_pipeline(spark, "incremental", landing, root)["extracted"] == 0
    files = file_marks.read_files(spark, Lake(root).files)
    assert files.count() == 4


def test_a_source_may_bring_no_new_file(spark, tmp_path):
    root, folder = str(tmp_path / "lake"), tmp_path / "l"
    landing = land(folder, "0", dolares=[day(4)], cotizaciones=[day(4)])
    run_pipeline(spark, "full", landing, root)
    land(folder, "1", dolares=[day(5)])
    aged(folder, "1", 4_000_000_000)
    assert run_pipeline(spark, "incremental", landing, root)["extracted"] == 1
    land(folder, "2", dolares=[], cotizaciones=[day(7)])
    aged(folder, "2", 4_000_000_100)
    with pytest.raises(RejectedInput, match="empty_payload"):
        run_pipeline(spark, "incremental", landing, root)
    land(folder, "2", dolares=[day(6)], cotizaciones=[day(7)])  # mended, so still unread
    aged(folder, "2", 4_000_000_100)
    assert run_pipeline(spark, "incremental", landing, root)["extracted"] == 2


def test_a_lake_without_bronze_has_read_nothing(spark, tmp_path):
    root, folder = tmp_path / "lake", tmp_path / "l"
    landing = land(folder, "0", dolares=[day(4)], cotizaciones=[day(4)])
    run_pipeline(spark, "full", landing, str(root))
    os.rename(root / "bronze", root / "away")
    state.save_state(spark, Lake(str(root)).state, datetime(2000, 1, 1, tzinfo=timezone.utc), "full", 0)
    state.save_progress(spark, Lake(str(root)).progress, "b", "marts")
    assert run_pipeline(spark, "incremental", landing, str(root))["extracted"] == 2


def test_landed_responses_are_read_once_too(spark, tmp_path):
    root, folder = str(tmp_path / "lake"), tmp_path / "r"
    folder.mkdir()

    def response(name, n, at):
        lines = [
            {"source": s, "endpoint": "/v1", "status": 200, "body": json.dumps([day(n)])}
            for s in ("dolares", "cotizaciones")
        ]
        (folder / name).write_text("\n".join(map(json.dumps, lines)))
        os.utime(folder / name, (at, at))

    response("0.json", 4, 1_000_000)
    run_pipeline(spark, "full", str(folder), root)
    response("1.json", 5, 1_000_100)
    (folder / "0.json").write_text("{}")
    os.utime(folder / "0.json", (999_999, 999_999))
    assert run_pipeline(spark, "incremental", str(folder), root)["extracted"] == 2


MARK = datetime(2028, 9, 5, 10, tzinfo=timezone.utc)


def test_ties_of_the_mark(spark):
    rows = spark.createDataFrame(
        [
            ("a", None, "2028-09-05T10:00:00Z"),
            ("b", "x", "2028-09-05T10:00:00Z"),
            ("b", None, "2028-09-05T07:00:00-03:00"),
            ("a", None, "2028-09-05T10:00:01Z"),
            ("c", "x", "2028-09-05T09:59:59Z"),
            ("d", "x", "garbage"),
            ("d", "x", None),
        ],
        "k string, l string, t string",
    )
    ts, keys = parse_utc(F.col("t")), ["k", "l"]
    seen = spark.createDataFrame([("a", None), ("a", None), ("q", "x")], "k string, l string")
    found = newer_with_ties(rows, ts, MARK, keys, seen)
    assert found.columns == rows.columns
    # A key seen at the mark's time is new again at a later time.
    assert sorted((r.k, r.l or "", r.t) for r in found.collect()) == [
        ("a", "", "2028-09-05T10:00:01Z"),
        ("b", "", "2028-09-05T07:00:00-03:00"),
        ("b", "x", "2028-09-05T10:00:00Z"),
    ]
    assert newer_with_ties(rows, ts, None, keys, seen).count() == 7
    at = keys_at(rows, ts, MARK, keys, seen)
    assert sorted((r.k, r.l or "") for r in at.collect()) == [
        ("a", ""), ("b", ""), ("b", "x"), ("q", "x"),
    ]
    assert keys_at(rows, ts, None, keys).count() == 0


def test_a_run_that_keeps_ties(spark, tmp_path):
    root, options = str(tmp_path / "lake"), Options(whole_payloads=True, keep_ties=True)

    def run(name, *dolares):
        landing = land(tmp_path / name, dolares=[*dolares], cotizaciones=[day(1)])
        return run_pipeline(spark, "incremental", landing, root, options=options)["extracted"]

    assert run("l0", day(5), day(4)) == 3
    assert run("l1", day(5), day(5, casa="blue")) == 1
    assert run("l2", day(5), day(5, casa="blue"), day(5, casa="tarjeta")) == 1
    assert run("l3", day(5, casa="tarjeta"), day(6), day(5)) == 1
    assert run("l4", day(6), day(5, casa="cripto"), day(6, casa="blue")) == 1
    assert read_bronze(spark, Lake(root)).count() == 7
    strict = run_pipeline(
        spark,
        "incremental",
        land(tmp_path / "l5", dolares=[day(6, casa="bolsa")], cotizaciones=[day(1)]),
        root,
    )
    assert strict["extracted"] == 0
