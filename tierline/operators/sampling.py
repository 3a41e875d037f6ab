"""Whole-group sampling: pick group ids, then keep *every* row of each
chosen group in *every* table, so a sample never splits a group.

The chosen key set is bounded by ``n`` (a top-N report), which is the only
reason it may be broadcast; the big tables are only semi-joined against it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _raise_if(keys: DataFrame, key: str, condition: Column, message: str) -> DataFrame:
    """``keys`` plus a guard row that raises (lazily, when the result is
    computed) if ``condition`` holds on the key count."""
    guard = keys.agg(F.count(F.lit(1)).alias("__n")).where(condition).select(
        F.raise_error(F.concat(F.lit(message), F.col("__n").cast("string")))
        .cast(keys.schema[key].dataType).alias(key))
    return keys.unionByName(guard)


def first_groups(df: DataFrame, key: str, order: Sequence[str], n: int, require: bool = True) -> DataFrame:
    """First ``n`` distinct ``key`` values in first-seen order (the minimum
    of ``order`` per key, ties by key).  Map-side partial aggregation, then
    a bounded top-N (``TakeOrderedAndProject``).  With ``require`` fewer
    than ``n`` groups raise instead of returning a short sample."""
    first = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))  # fixed-width → hash aggregate
    firsts = df.groupBy(key).agg(first.alias("__first"))
    chosen = firsts.orderBy("__first", key).limit(n).select(key)
    if require:
        chosen = _raise_if(chosen, key, F.col("__n") < n, f"fewer than {n} groups: ")
    return chosen


def groups_where(df: DataFrame, key: str, predicate: Column, require: bool = False) -> DataFrame:
    """Distinct keys of groups with at least one row matching ``predicate``;
    with ``require`` an empty result raises (one extra count over the keys)."""
    keys = df.where(predicate).select(key).distinct()
    if require:
        keys = _raise_if(keys, key, F.col("__n") == 0, "no group matches the predicate: ")
    return keys


def keep_groups(tables: Mapping[str, tuple[DataFrame, str]], chosen: DataFrame, key: str,
                require_all: bool = True, broadcast_chosen: bool = True) -> dict[str, DataFrame]:
    """Semi-join every table against ``chosen`` keys.  With ``require_all`` a
    chosen key absent from any table raises (lazily, when the result runs)
    instead of yielding an inconsistent sample."""
    keys = F.broadcast(chosen) if broadcast_chosen else chosen
    out = {}
    for name, (df, col) in tables.items():
        kept = df.join(keys.withColumnRenamed(key, "__k"), F.col(col) == F.col("__k"), "left_semi")
        if require_all:
            # Presence is read off the (small) kept rows, never off the big table.
            present = kept.select(F.col(col).alias("__k")).distinct()
            missing = keys.withColumnRenamed(key, "__k").join(present, "__k", "left_anti")
            first, *rest = df.schema.fields
            guard = missing.select(
                F.raise_error(F.concat(F.lit(f"chosen group absent from {name}: "),
                                       F.col("__k").cast("string"))).cast(first.dataType).alias(first.name),
                *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])
            # Empty on success; raises while the result is computed if a key is missing.
            kept = kept.unionByName(guard)
        out[name] = kept
    return out
