"""The pipeline, stage by stage, against plain versions of its decisions."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from strata.llm.common import staged

from tests.llm.helpers import SCHEMA, SF, documents, prose, words
from tests.llm.test_mixing import plain_copies, plain_targets
from tests.llm.test_simhash import expected as simhash_components


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing", "packing"]
    docs = documents(spark)
    rows = {row.doc_id: row for row in docs.collect()}

    clean = staged(stages["toxicity"](spark, docs, SF), "test")
    assert clean.columns == docs.columns
    kept = {row.doc_id: row for row in clean.collect()}
    assert all(rows[i] == row for i, row in kept.items()) and len(kept) > 0.7 * len(rows)

    once = staged(stages["exact dedup"](spark, clean, SF), "test")
    last = {}
    for i in sorted(kept):
        last[kept[i].text or ""] = i
    assert sorted(row.doc_id for row in once.collect()) == sorted(last.values())
    assert all(row == rows[row.doc_id] for row in once.collect())

    apart = staged(stages["SimHash near-dedup"](spark, once, SF), "test")
    groups = simhash_components([(i, rows[i].text) for i in last.values()])
    assert sorted(r.doc_id for r in apart.collect()) == sorted({g[2] for g in groups})

    mixed = staged(stages["mixing"](spark, apart, SF), "test")
    given = apart.collect()
    sizes = Counter()
    for row in given:
        sizes[row.source] += len(words(row.text))
    target = plain_targets(sizes)
    wanted = Counter()
    for row in given:
        wanted[row] += plain_copies(row.doc_id, target[row.source] / sizes[row.source])
    assert mixed.columns == docs.columns
    assert Counter(mixed.collect()) == +wanted

    packed = stages["packing"](spark, mixed, SF).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in packed) == Counter(
        (r.doc_id, len(words(r.text))) for r in mixed.collect()
    )


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0
    assert set(found.columns) >= {"doc_id", "n_tokens", "bucket_length", "batch", "slot"}


def odd_documents(spark):
    """A third of the rows without an id, shared ids, and names that stages might use."""
    rng = random.Random(3)
    rows = []
    for n in range(90):
        id_ = None if n % 3 == 0 else n % 20 if n % 3 == 1 else 1000 + n
        rows.append((id_, prose(rng, 8 + n), "en", ["a", "b", None][n % 3], n))
    rows += [rows[0], rows[0], rows[1], (7, None, None, "a", None), (None, "", None, "b", None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("_sha", "_row", "_kept_id", "_mix", "_copy", "copies", "score", "a.b"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def test_odd_rows_and_names_pass_all_stages(spark):
    docs = odd_documents(spark)
    distinct = {row.text or "" for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[1:4]:
        found = staged(stage(spark, docs, SF), "odd")
        assert found.columns == docs.columns
        texts = [row.text or "" for row in found.collect()]
        if name != "mixing":
            assert set(texts) == distinct and len(texts) == len(distinct)
        assert {row._sha for row in found.collect()} == {"x"}
        docs = found
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert packed.count() == docs.count()


def test_empty_stages(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
