"""From raw documents to batches: a corpus pipeline of five text operators.

Each stage takes all rows that the one before kept, as a written table, and its
decision takes effect: toxic documents go, one of each group of equal texts stays, one
of each group of near-duplicates stays, sources are repeated to their target weights,
and what is left is packed into batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import exact_dedup, length_packing, mixing, simhash, toxicity
from strata.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labels that the given documents have; drop what scores as toxic."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return length_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: SQL cannot express the network of the first stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
