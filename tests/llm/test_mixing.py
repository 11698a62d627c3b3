from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing

from tests.llm.helpers import SCHEMA, documents, frame, odd_rows, words


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    mix, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        level = mix / sum(weight[s] for s in open_)
        over = {s for s in open_ if most * sizes[s] <= weight[s] * level}
        if not over:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: float(most * sizes[s]) for s in over}
        mix -= sum(target[s] for s in over)
        open_ -= over
    return target


def plain_names(rows):
    """By what each (id, text) is drawn: the id, or that, the text and a number."""
    ids, equal, names = Counter(id_ for id_, _ in rows), Counter(), []
    for id_, text in rows:
        name = "null" if id_ is None else str(id_)
        if ids[id_] > 1:
            sha = hashlib.sha256((text or "").encode()).hexdigest()
            name = f"{name}:{sha}:{equal[id_, sha]}"
            equal[id_, sha] += 1
        names.append(name)
    return names


def plain_copies(name, rate, seed=17):
    drawn = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) / 16**13
    return math.floor(rate) + (drawn < rate - math.floor(rate))


@pytest.mark.parametrize("table", ["odd", "given"])
def test_report(spark, table):
    docs = frame(spark, odd_rows()) if table == "odd" else documents(spark)
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for row in rows:
        sizes[row.source] += len(words(row.text))
    target = plain_targets(sizes)
    found = mixing.report(docs).collect()
    for row in found:
        assert row.taken == row.copies * row.size <= 2 * row.size
    wanted = Counter()
    names = plain_names([(row.doc_id, row.text) for row in rows])
    for row, name in zip(rows, names, strict=True):
        size, own = len(words(row.text)), sizes[row.source]
        rate = target[row.source] / own if own else 0.0
        copies = plain_copies(name, rate)
        wanted[row.doc_id, size, own, round(target[row.source], 6), copies * size] += 1
    got = Counter(
        (r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found
    )
    assert got == wanted


def test_taken_words_come_near_their_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
    )
    joined = mixing.report(docs).join(docs, "doc_id")
    sums = joined.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("t"))
    for row in sums.collect():
        assert abs(row.taken - row.t) < 0.05 * row.t


def test_mixed_rows(spark):
    docs = frame(spark, odd_rows())
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = Counter()
    for row in mixing.report(docs).collect():
        copies[row.doc_id] += row.copies
    found = Counter(row.doc_id for row in out.collect())
    assert found == +copies


@pytest.mark.parametrize("shared", ["NULL", "id % 5"])
@pytest.mark.parametrize("text", ["concat('w ', id)", "'one text'", "concat('w ', id % 7)"])
def test_rows_of_one_id_are_drawn_apart(spark, shared, text):
    docs = spark.range(0, 6000, 1, 5).selectExpr(
        f"{shared} AS doc_id", "concat('s', id % 3) AS source", f"{text} AS text"
    )
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    target = plain_targets({f"s{n}": 4000 for n in range(3)})
    assert any(target[s] % 4000 for s in target)
    for row in mixing.mixed(docs).groupBy("source").agg(F.count("*").alias("n")).collect():
        assert abs(2 * row.n - target[row.source]) < 0.05 * target[row.source]
    report = mixing.report(docs.repartition(3))
    sizes = report.groupBy("target").agg(F.sum("taken").alias("taken")).collect()
    wanted = Counter()
    for value in target.values():
        wanted[value] += value
    assert all(abs(row.taken - wanted[row.target]) < 0.05 * wanted[row.target] for row in sizes)


def test_columns_of_any_name_come_back(spark):
    docs = frame(spark, odd_rows())
    for name in ("_mix", "_t", "_copy", "copy", "row", "name", "of_source", "part", "place"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    copies = sum(row.copies for row in mixing.report(docs).collect())
    assert out.count() == copies
    assert {tuple(row)[-9:] for row in out.collect()} == {("x",) * 9}


def test_many_sources_are_ranked_apart(spark):
    sizes = spark.range(300).selectExpr("lpad(id, 4, '0') AS source", "id + 1 AS source_size")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        ranked = mixing.ranked_sources(sizes.repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sorted((r.source, r["rank"]) for r in ranked) == [
        (f"{n:04d}", n) for n in range(300)
    ]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.report(docs).count() == 0
    assert mixing.mixed(docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, "a", 0)], SCHEMA)
    assert {r.taken for r in mixing.report(blank).collect()} == {0}
