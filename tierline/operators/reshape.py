"""Unpivot and long-form comparison helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import distinct_from


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "column_name",
            value: str = "value", keep_nulls: bool = True, as_type: str | None = None) -> DataFrame:
    """Wide → long.  ``keep_nulls=True`` keeps (id, column, NULL) rows so a
    measure that is NULL on both sides of a comparison stays visible; SQL
    ``UNPIVOT`` drops them, ``keep_nulls=False`` matches that."""
    pairs = [F.struct(F.lit(c).alias(name), (F.col(c).cast(as_type) if as_type else F.col(c)).alias(value))
             for c in columns]
    out = df.select(*ids, F.inline(F.array(*pairs)))
    return out if keep_nulls else out.where(F.col(value).isNotNull())


def compare_wide(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str],
                 left_name: str = "left_value", right_name: str = "right_value",
                 how: str = "full_outer", value_type: str | None = None) -> DataFrame:
    """Join two same-grain tables once on ``keys`` and emit one long row per
    (key, measure) with both values and a null-safe ``violates`` flag.  A
    key present on one side only keeps NULL on the other side."""
    lt = left.select(*keys, *[F.col(m).alias(f"__l_{m}") for m in measures]).alias("l")
    rt = right.select(*keys, *[F.col(m).alias(f"__r_{m}") for m in measures]).alias("r")
    j = lt.join(rt, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys], how)
    key_cols = [F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys]

    def cast(c: Column) -> Column:
        return c.cast(value_type) if value_type else c

    pairs = [F.struct(F.lit(m).alias("measure"), cast(F.col(f"l.__l_{m}")).alias(left_name),
                      cast(F.col(f"r.__r_{m}")).alias(right_name)) for m in measures]
    long = j.select(*key_cols, F.inline(F.array(*pairs)))
    return long.withColumn("violates", distinct_from(left_name, right_name))
