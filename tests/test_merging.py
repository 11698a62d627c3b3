"""Merges of stored tables: only what changed, columns gained, buckets left in place."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import model
from strata.operators.upsert import changed_rows, upsert
from strata.plans import medallion, merging
from strata.plans.medallion import Lake, Options, read_bronze_whole, read_silver
from strata.sources import bucketed, state, tables
from strata.streaming import intake

from tests.helpers import land, quote, rows_of

run_pipeline = partial(medallion.run_pipeline, whole_payloads=True)

SCHEMA = "k string, v int, w string"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def day(n, **fields):
    return quote(fechaActualizacion=f"2028-09-{n:02}T10:00:00.000Z", **fields)


def test_changed_rows(spark):
    target = frame(
        spark,
        ("same", 1, None),
        ("moved", None, "x"),
        (None, 1, "null key"),
        ("twice", 1, "a"),
        ("twice", 2, "a"),
        ("both", 1, "a"),
        ("both", 1, "a"),
    )
    source = frame(
        spark,
        ("same", 1, None),
        ("moved", 1, None),
        (None, 1, "null key"),
        ("twice", 1, "a"),  # a merge would change the other row of this key
        ("both", 1, "a"),
        ("new", None, None),
    )
    found = changed_rows(target, source, ["k"], ["v", "w"])
    assert found.columns == source.columns
    assert sorted(row.k for row in found.collect()) == ["moved", "new", "twice"]
    assert rows_of(upsert(target, found, ["k"])) == rows_of(upsert(target, source, ["k"]))


def test_a_column_that_the_target_lacks_is_a_change_unless_null(spark):
    target = frame(spark, ("a", 1, "x"), ("b", 1, "x"))
    source = frame(spark, ("a", 1, "x", None), ("b", 1, "x", "new"), schema=SCHEMA + ", n string")
    assert [r.k for r in changed_rows(target, source, ["k"], ["v", "w", "n"]).collect()] == ["b"]


PARTS = "year int, month int"


def stored(spark, root, *rows):
    df = frame(spark, *rows, schema=f"{SCHEMA}, {PARTS}")
    tables.overwrite_table(df, root, ["year", "month"])
    return df.schema


def files(tmp_path):
    return {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}


def test_only_periods_with_a_change_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = stored(spark, root, ("a", 1, "x", 2025, 1), ("b", 1, "x", 2025, 2), ("c", 1, "x", 2025, 3))
    before = files(tmp_path)
    batch = frame(
        spark, ("a", 1, "x", 2025, 1), ("b", 2, "x", 2025, 2), ("d", 1, "x", 2025, 4), schema=schema
    )
    merge = partial(merging.merge_into, compare=["v", "w"])
    merged = merge(batch, root, schema, ["k"], ["year", "month"], str(tmp_path / "s0"))
    assert merged.rows == 2 and (merged.touched.first, merged.touched.last) == (20250200, 20250400)
    after = files(tmp_path)
    changed = {str(f).split("month=")[1][0] for f in after if before.get(f) != after[f]}
    assert changed == {"2", "4"}
    kept = tables.read_table(spark, root, schema)
    assert rows_of(kept.select("k", "v")) == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]
    again = merge(batch, root, schema, ["k"], ["year", "month"], str(tmp_path / "s1"))
    assert again.rows == 0 and again.touched.none
    assert files(tmp_path) == after


def test_a_table_gains_columns_over_several_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = stored(spark, root, ("a", 1, "x", 2025, 1), ("b", 1, "x", 2025, 2))
    second = frame(spark, ("b", 2, "new", 2025, 2), schema=f"k string, v int, n string, {PARTS}")
    merging.merge_into(second, root, schema, ["k"], ["year", "month"], str(tmp_path / "s0"))
    grown = merging.stored_schema(spark, root, schema)
    assert grown.names == ["k", "v", "w", "year", "month", "n"]
    third = frame(spark, ("a", 3, 2025, 1), ("c", 3, 2025, 1), schema=f"k string, v int, {PARTS}")
    merging.merge_into(third, root, grown, ["k"], ["year", "month"], str(tmp_path / "s1"))
    kept = tables.read_table(spark, root, grown).select("k", "v", "w", "n")
    assert rows_of(kept) == [("a", 3, "x", None), ("b", 2, "x", "new"), ("c", 3, None, None)]
    assert isinstance(grown["year"].dataType, T.IntegerType)


def test_bronze_gains_extra_fields_of_the_source(spark, tmp_path):
    root, lake = str(tmp_path / "lake"), Lake(str(tmp_path / "lake"))
    first = land(tmp_path / "l1", dolares=[day(4), day(5)], cotizaciones=[day(4)])
    run_pipeline(spark, "full", first, root)
    assert state.read_columns(spark, lake.columns) == []
    second = land(
        tmp_path / "l2",
        dolares=[day(6, variacion=1.5), day(7)],
        cotizaciones=[day(6, variacion="n/d")],
    )
    options = Options(whole_payloads=True, extra_fields=("variacion",))
    run_pipeline(spark, "incremental", second, root, options=options)
    whole = read_bronze_whole(spark, lake)
    assert whole.columns == [*model.BRONZE.names, "variacion"]
    found = {(r.origen_datos, r.fechaActualizacion[8:10]): r.variacion for r in whole.collect()}
    assert found == {
        ("dolares", "04"): None,
        ("dolares", "05"): None,
        ("cotizaciones", "04"): None,
        ("dolares", "06"): "1.5",
        ("dolares", "07"): None,
        ("cotizaciones", "06"): "n/d",
    }
    third = land(tmp_path / "l3", dolares=[day(6, casa="blue"), day(8)], cotizaciones=[day(8)])
    run_pipeline(spark, "incremental", third, root)  # the column stays, though not asked for
    whole = read_bronze_whole(spark, lake)
    assert whole.filter("variacion IS NOT NULL").count() == 2 and whole.count() == 8
    assert read_silver(spark, lake).count() == 8


def test_columns_of_a_lake_without_a_note_are_found_in_its_files(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = land(tmp_path / "l", dolares=[day(4, x="1")], cotizaciones=[day(4)])
    options = Options(whole_payloads=True, extra_fields=("x",))
    run_pipeline(spark, "full", rows, str(tmp_path / "lake"), options=options)
    tables.drop_path(spark, lake.columns)
    assert read_bronze_whole(spark, lake).columns[-1] == "x"
    assert state.read_columns(spark, lake.columns) == ["x"]


def test_rejects_are_stored_once_however_often_they_come(spark, tmp_path):
    root, lake = str(tmp_path / "lake"), Lake(str(tmp_path / "lake"))
    bad = [{"casa": "x"}, 7, 7, None]
    landing = land(tmp_path / "l", dolares=[day(4), *bad], cotizaciones=[day(4), 7])
    options = Options(whole_payloads=True, new_files_only=False)
    for n in range(3):
        run_pipeline(
            spark, "incremental", landing, root, batch_id=f"b{n}", options=options
        )
    rejects = spark.read.schema(medallion.REJECT).parquet(lake.quarantine).collect()
    assert sorted((r.source, r.raw or "", r.times, r.batch_id) for r in rejects) == [
        ("cotizaciones", "7", 1, "b0"),
        ("dolares", "", 1, "b0"),
        ("dolares", "7", 2, "b0"),
        ("dolares", '{"casa":"x"}', 1, "b0"),
    ]


def stream(spark, landing, tmp_path, **options):
    return intake.stream_pipeline(
        spark,
        landing,
        str(tmp_path / "lake"),
        str(tmp_path / "cp"),
        options=Options(whole_payloads=True, **options),
    )


def lake_files(tmp_path):
    return {f: f.stat().st_mtime_ns for f in (tmp_path / "lake").rglob("*.parquet")}


@pytest.mark.parametrize("drop_repeats", [False, True])
def test_an_equal_poll_writes_nothing(spark, tmp_path, drop_repeats):
    rows = [day(4), day(5, casa="blue"), day(5, moneda="EUR")]
    polls = [rows, [day(4), day(5, casa="blue", venta=990), day(6)]]
    told = []
    for n, poll in enumerate([*polls, polls[1]]):
        landing = land(tmp_path / "l", str(n), dolares=poll)
        before = lake_files(tmp_path)
        counts = stream(spark, landing, tmp_path, drop_repeats=drop_repeats)
        told.append((counts["extracted"], counts["bronze_written"]))
    assert told == ([(3, 3), (2, 2), (0, 0)] if drop_repeats else [(3, 3), (3, 2), (3, 0)])
    assert lake_files(tmp_path) == before
    silver = read_silver(spark, Lake(str(tmp_path / "lake")))
    asks = {(r.venue, r.currency, r.day): r.ask for r in silver.collect()}
    assert asks[("blue", "USD", 5)] == 990.0 and len(asks) == 4


def test_a_value_that_changes_back_is_no_repeat(spark, tmp_path):
    told = []
    for n, ask in enumerate((950, 960, 950, 950)):
        landing = land(tmp_path / "l", str(n), dolares=[day(4, venta=ask), 5])
        told.append(stream(spark, landing, tmp_path, drop_repeats=True)["extracted"])
    assert told == [1, 1, 1, 0]
    lake = Lake(str(tmp_path / "lake"))
    assert [row.ask for row in read_silver(spark, lake).collect()] == [950.0]
    assert spark.read.parquet(lake.quarantine).count() == 1


def keyless(plan: str) -> list[str]:
    """The exchanges of a plan, each with the scans below it."""
    lines, found = plan.splitlines(), []
    for n, line in enumerate(lines):
        if "Exchange" in line:
            depth = line.index("Exchange")
            below = []
            for other in lines[n + 1 :]:
                if len(other) - len(other.lstrip(" :+-")) <= depth:
                    break
                below.append(other)
            found.append("\n".join(below))
    return found


def test_a_bucketed_table_is_merged_without_moving_it(spark, tmp_path):
    keys = ["k", "w"]
    target = frame(spark, ("a", 1, "x"), ("b", 1, None), (None, 1, None), ("c", 1, "x"), ("c", 2, "x"))
    batch = frame(spark, ("b", 5, None), (None, 6, None), ("n", 7, "x"), ("c", 8, "x"))
    bucketed.create(target, "quotes_a", keys, 4, str(tmp_path / "a"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        after = bucketed.merged(spark, "quotes_a", batch, keys)
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and keyless(plan)
        assert not any("quotes_a" in below for below in keyless(plan))
        bucketed.merge(spark, "quotes_a", batch, keys, "quotes_b", str(tmp_path / "b"))
    finally:
        spark.conf.set(limit, before)
    wanted = rows_of(upsert(target, batch, keys))
    assert rows_of(bucketed.read(spark, "quotes_b")) == wanted
    again = bucketed.merged(spark, "quotes_b", frame(spark, ("z", 0, None)), keys)
    assert again.count() == len(wanted) + 1
    with pytest.raises(Exception, match="several source rows"):
        twice = frame(spark, ("a", 1, "x"), ("a", 2, "x"))
        bucketed.merged(spark, "quotes_a", twice, keys).collect()


def test_more_than_one_key_needs_null_safe_comparison(spark):
    with pytest.raises(ValueError):
        upsert(frame(spark), frame(spark), ["k", "v"], null_safe=False)


def test_folded_keys_are_exact(spark):
    rows = frame(spark, (None, 1, "null"), ("null", 1, None), ("a\",\"w\":\"b", 1, None))
    keys = rows.select(bucketed.merge_key(["k", "w"]).alias("m")).distinct()
    assert keys.count() == 3 and keys.filter(F.col("m").isNull()).count() == 0
