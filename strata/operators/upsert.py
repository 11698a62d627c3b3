"""Merge of a batch into a table, as a plan any file format can run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Update target rows whose key the source has, insert the source's other rows.

    Keys compare null-safe, as structs; a single key that is never NULL may do without, and
    keeps the partitioning that a bucketed table has by it. All target rows of a matched key are
    updated, all unmatched source rows inserted, and the plan fails when several
    source rows match one target row. Columns of only one side are kept, NULL
    where the other side has none.

    A batch small enough to be broadcast moves no target row. Otherwise the target is
    joined to the batch itself, and adaptive execution splits a hot key of either side.
    The guard is a branch of its own over keys alone, which gives no rows or fails;
    grouping by columns keeps its aggregates hash aggregates.
    """
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    if not null_safe and len(keys) > 1:
        raise ValueError("only a single key can do without null-safe comparison")
    key = (F.struct(*keys) if null_safe else F.col(keys[0])).alias("_key")
    old, new = target.select("*", key), source.select("*", key)

    several = source.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(key, "_n")
    ambiguous = F.raise_error(
        F.concat(
            F.lit("several source rows match the key "),
            F.to_json("_key") if null_safe else F.col("_key").cast("string"),
        )
    )
    # Keys alone meet here, not beside their columns, and only those that both sides have are
    # checked: a task sorts what adaptive execution joins by its compressed size.
    plain = [F.col("_key")[k] if null_safe else F.col("_key") for k in keys]
    plain = [value.alias(k) for value, k in zip(plain, keys, strict=True)]
    wanted = source.select(*keys).distinct().select(key)
    met = old.select("_key").join(wanted, "_key", "left_semi")
    known = met.select(*plain).distinct().select(key)
    # An outer join, as the optimizer would move the check before any other.
    clashes = known.join(several, "_key", "left").filter(
        F.when(F.col("_n") > 1, ambiguous.cast("boolean")).otherwise(F.lit(False))
    )

    rows = source.select(key, F.struct(*source.columns).alias("_row"))
    hit = F.col("_row").isNotNull()
    values = []
    for name in columns:
        if name not in source.columns:
            values.append(F.col(name))
        else:
            kept = F.col(name) if name in target.columns else F.lit(None)
            values.append(F.when(hit, F.col("_row")[name]).otherwise(kept).alias(name))
    updated = old.join(rows, "_key", "left").select(*values)
    inserted = new.join(known, "_key", "left_anti").drop("_key")
    merged = updated.unionByName(inserted, allowMissingColumns=True)
    none = [F.lit(None).cast(field.dataType).alias(field.name) for field in merged.schema]
    return merged.unionByName(clashes.select(*none))


def changed_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The source rows that :func:`upsert` would change the target by.

    A row stays out if the target has its key and all its rows of that key agree with it in
    ``values``, null-safe, by a digest of 128 bits. A column the target lacks is NULL there.
    """
    mine, theirs = F.col("_one"), F.col("_two")

    def digested(df: DataFrame) -> DataFrame:
        held = [F.col(v) if v in df.columns else F.lit(None).cast("string") for v in values]
        named = [value.alias(name) for name, value in zip(values, held, strict=True)]
        text = F.to_json(F.struct(*named), {"ignoreNullFields": "false"})
        return df.withColumns({"_one": F.xxhash64(text), "_two": F.xxhash64(F.lit("2"), text)})

    same = [F.min(c) == F.max(c) for c in (mine, theirs)]
    known = (
        digested(target)
        .groupBy(*keys)
        .agg(F.min(mine).alias("_one"), F.min(theirs).alias("_two"), (same[0] & same[1]).alias("_same"))
        .filter("_same")
        .select(F.struct(*keys).alias("_key"), "_one", "_two")
    )
    return (
        digested(source)
        .withColumn("_key", F.struct(*keys))
        .join(known, ["_key", "_one", "_two"], "left_anti")
        .select(*source.columns)
    )


def ambiguous_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report of the keys that make :func:`upsert` fail, with their source row counts."""
    several = (
        source.groupBy(F.struct(*keys).alias("_key"))
        .agg(F.count("*").alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )
    known = target.select(F.struct(*keys).alias("_key")).distinct()
    return several.join(known, "_key", "left_semi").select("_key.*", "source_rows")
