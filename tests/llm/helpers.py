"""Fixtures and plain reference versions for the tests of the text operators."""

from __future__ import annotations

import random
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


def odd_rows(seed: int = 5) -> list[tuple]:
    """Documents with nulls, empty and long texts, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (300, 120, 80, 60, 60, 55, 30, 7, 4, 3)]
    shared = prose(rng, 70)
    texts = [
        *base,
        base[0],
        base[0],
        base[0].replace(" ", "\n", 1),
        base[0] + " one more",
        base[1].upper(),
        prose(rng, 20) + " " + shared + " " + prose(rng, 15),
        shared + "\t" + prose(rng, 40),
        prose(rng, 6000),
        "",
        "",
        None,
        " \n\t ",
        "Ünï     çödé 🦆 " * 40,
        "same " * 200,
        "same " * 260,
    ]
    sources = ["a", "b", "c", None, "d", "é"]
    rows = [
        (n, text, rng.choice(["en", "de", None]), sources[n % len(sources)], n if n % 7 else None)
        for n, text in enumerate(texts)
    ]
    return [*rows, rows[3], rows[3], (None, base[2], None, None, None)]


def frame(spark: SparkSession, rows: list[tuple], extra: bool = True) -> DataFrame:
    """As a table; ``extra`` columns have names that the operators might use inside."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("id", "key", "sha", "size", "rate", "bucket", "score", "n", "a.b", "hash"):
            docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def union_find(pairs, nodes) -> dict:
    """The least node that each reaches."""
    parent = {node: node for node in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(str(Path(SF) / "documents.parquet"))
