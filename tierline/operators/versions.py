"""Comparison of two versions of a table through digests.

Rows fall into buckets by their key; a bucket's digest is its number of rows
and sums of row hashes, combined before the shuffle.  Only buckets whose
digests differ are read again, and of their rows only those whose own digests
differ are taken apart into cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import distinct_from


def row_digest(columns: Sequence[str], seed: int = 0) -> Column:
    """Hash of the cells and of which of them are null."""
    return F.xxhash64(F.lit(seed), *columns, *[F.col(c).isNull() for c in columns])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    # never null, and Spark is to know: a test for null would go below an exchange that the two passes over a side share
    return F.coalesce(F.pmod(row_digest(keys), F.lit(buckets)), F.lit(0))


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    cells = [*keys, *columns]
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(row_digest(cells, s).cast("decimal(38,0)")).alias(f"s{s}") for s in (1, 2)])


def changed_buckets(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 4096) -> DataFrame:
    """``bucket`` of those whose rows differ; ``buckets`` rows at most."""
    b = bucket_digests(before, keys, columns, buckets).select(F.col("bucket").alias("b"), F.col("n").alias("bn"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    a = bucket_digests(after, keys, columns, buckets)
    j = a.join(b, F.col("bucket") == F.col("b"), "full_outer")
    return j.where(distinct_from("n", "bn") | distinct_from("s1", "b1") | distinct_from("s2", "b2")).select(F.coalesce("bucket", "b").alias("bucket"))


def version_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 4096) -> DataFrame:
    """(key…, column_name, value_before, value_after) for every cell that
    differs, with null keys equal to each other; a row in one version only
    shows with all its non-null cells.  Keys are unique in both versions.
    Each side is read for the digests and for the rows of the buckets that
    differ, and its rows with a null key once more.  The rows meet by plain
    equality of the keys, so sides already laid out by them, as those of
    ``latest_per_key``, are not dealt again."""
    changed = F.broadcast(changed_buckets(before, after, keys, columns, buckets))  # at most ``buckets`` rows

    def side(df: DataFrame, name: str) -> DataFrame:
        kept = df.withColumn("bucket", _bucket(keys, buckets)).join(changed, "bucket", "left_semi")
        return kept.select(*[F.col(k).alias(f"__{name}_{k}") for k in keys], F.struct(*columns).alias(f"__{name}"),
                           row_digest([*keys, *columns], 1).alias(f"__{name}d"))

    cell = lambda side, c: F.col(f"__{side}.{c}").cast("string")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), cell("b", c).alias("value_before"), cell("a", c).alias("value_after")) for c in columns])

    def met(b: DataFrame, a: DataFrame, same: Callable[[Column, Column], Column]) -> DataFrame:
        both = side(b, "b").join(side(a, "a"), [same(F.col(f"__b_{k}"), F.col(f"__a_{k}")) for k in keys], "full_outer").where(distinct_from("__bd", "__ad"))
        return both.select(*[F.coalesce(f"__b_{k}", f"__a_{k}").alias(k) for k in keys], cells.alias("__cells"))

    open_key = reduce(or_, [F.col(k).isNull() for k in keys])
    out = met(before, after, lambda x, y: x == y).where(~open_key)
    out = out.unionByName(met(before.where(open_key), after.where(open_key), lambda x, y: x.eqNullSafe(y)))
    return out.select(*keys, F.inline("__cells")).where(distinct_from("value_before", "value_after"))
