"""Row-version operators: guarded cell override, capture diff, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import distinct_from
from tierline.operators.latest import latest_per_key, oldest_and_newest


def apply_cell_edit(df: DataFrame, match: Column, column: str, value, reason: str = "") -> tuple[DataFrame, DataFrame]:
    """Change ``column`` to ``value`` on exactly one row matched by
    ``match``.  Returns (edited table, change log).  Zero or several matches
    raise before anything is returned (one scalar count action)."""
    n = df.where(match).count()
    if n != 1:
        raise ValueError(f"cell edit must match exactly one row, matched {n}")
    field = df.schema[column]
    new = F.lit(value).cast(field.dataType)
    edited = df.withColumn(column, F.when(match, new).otherwise(F.col(column)))
    log = df.where(match).select(
        F.lit(column).alias("column_name"),
        F.col(column).cast("string").alias("value_before"),
        new.cast("string").alias("value_after"),
        F.lit(reason).alias("reason"),
        F.to_json(F.struct(*df.columns)).alias("row_before"),
    )
    return edited, log


def capture_diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(key…, column_name, value_before, value_after) for every column whose
    value differs between the oldest and the newest version of a key.  One
    aggregation with min/max structs; keys with one version emit nothing."""
    on = oldest_and_newest(df, keys, order, columns).where("n_versions > 1")
    pairs = [F.struct(F.lit(c).alias("column_name"),
                      F.col(f"oldest.{c}").cast("string").alias("value_before"),
                      F.col(f"newest.{c}").cast("string").alias("value_after")) for c in columns]
    long = on.select(*keys, F.inline(F.array(*pairs)))
    return long.where(distinct_from("value_before", "value_after"))


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """MERGE-on-key without a table format: union base and updates, keep the
    latest version per key.  Rows absent from ``updates`` survive (upsert,
    never delete)."""
    both = base.unionByName(updates)
    return latest_per_key(both, keys, list(version))
