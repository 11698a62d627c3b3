"""Records that repeat what a stream has last seen of their key, dropped by a state store.

A poll repeats most quotes unchanged. What a key held last is kept as a digest across
batches; a record passes only if its key is new or held something else, so a value that
changes and changes back passes both times, which dropping duplicates of whole records
would not let it. Of several records of a key in one batch the newest counts.

Keys are dealt to buckets by hash, and the state of a bucket is one row, so a batch costs a
call per bucket and not per key. Keys that were not seen for ``keep`` leave the state; if
they come again they pass, and the merge finds that nothing has changed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
KEEP = timedelta(days=7)

#: Of each key seen: two longs that name it, two that tell what it held, and when.
_ENTRY = np.dtype([(name, "<i8") for name in ("key", "key2", "held", "held2", "at")])
_STATE = T.StructType([T.StructField("entries", T.BinaryType())])
_DIGESTS = ("_key", "_key2", "_held", "_held2")


def _digest(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit("2"), text)]


def drop_repeats(
    records: DataFrame,
    key: Column,
    value: Column,
    order: Sequence[str],
    buckets: int = BUCKETS,
    keep: timedelta = KEEP,
) -> DataFrame:
    """The records of a stream whose key is new, or held another value before.

    ``key`` and ``value`` are texts. ``order`` names columns, the first of them a time: of
    equal keys in a batch the record that comes last in that order counts.
    """
    at, kept, names = order[0], int(keep.total_seconds() * 1_000_000), records.columns
    columns = dict(zip(_DIGESTS, [*_digest(key), *_digest(value)], strict=True))
    columns["_at"] = F.unix_micros(at)
    dealt = records.withColumns(columns)
    dealt = dealt.withColumn("_bucket", F.pmod(F.col("_key"), F.lit(buckets)))

    def newest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_at", *order[1:]], kind="stable", na_position="first")
        return rows.drop_duplicates(["_key", "_key2"], keep="last")

    def compute(_, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        batch = None
        for part in parts:
            batch = newest(part if batch is None else pd.concat([batch, part]))
        if batch is None or batch.empty:
            return
        before = np.frombuffer(state.get[0] if state.exists else b"", _ENTRY)
        held = {(e["key"], e["key2"]): n for n, e in enumerate(before)}
        found = [held.get(key, -1) for key in zip(batch["_key"], batch["_key2"], strict=True)]
        found = np.array(found, np.int64)
        told = batch[["_held", "_held2"]].to_numpy()
        passes = found < 0
        old = before[found[~passes]]
        passes[~passes] = (told[~passes, 0] != old["held"]) | (told[~passes, 1] != old["held2"])

        entries = np.empty(len(batch), _ENTRY)
        for name, column in zip(_ENTRY.names, (*_DIGESTS, "_at"), strict=True):
            entries[name] = batch[column].to_numpy()
        rest = np.delete(before, found[found >= 0])
        entries = np.concatenate([rest, entries])
        entries = entries[entries["at"] >= entries["at"].max() - kept]
        state.update((entries.tobytes(),))
        yield batch.loc[passes, names]

    return dealt.groupBy("_bucket").applyInPandasWithState(
        compute, records.schema, _STATE, "append", "NoTimeout"
    )
