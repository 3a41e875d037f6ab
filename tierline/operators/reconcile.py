"""Cross-grain reconciliation: the sum of the child rows equals the parent
row, measure by measure, with zero tolerance (a tolerance band hides
fan-out).  Children are summed with partial aggregation, joined to the
parent once on the parent key, and unpivoted to long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.reshape import compare_wide


def child_sums(child: DataFrame, keys: Sequence[str], measures: Mapping[str, str] | Sequence[str],
               as_type: str | None = None) -> DataFrame:
    """``measures``: names, or {output name: child column}."""
    mapping = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    aggs = []
    for out, src in mapping.items():
        col = F.col(src).cast(as_type) if as_type else F.col(src)
        s = F.sum(col)
        aggs.append((s.cast(as_type) if as_type else s).alias(out))
    return child.groupBy(*keys).agg(*aggs)


def reconcile(parent: DataFrame, child: DataFrame, keys: Sequence[str],
              measures: Mapping[str, str] | Sequence[str], as_type: str | None = None,
              parent_name: str = "parent_value", child_name: str = "child_value") -> DataFrame:
    """Long comparison (keys…, measure, parent_value, child_value, violates),
    full outer so a parent without children (or the reverse) is visible."""
    mapping = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    sums = child_sums(child, keys, mapping, as_type)
    par = parent.select(*keys, *[(F.col(m).cast(as_type) if as_type else F.col(m)).alias(m) for m in mapping])
    return compare_wide(par, sums, keys, list(mapping), parent_name, child_name, "full_outer")
