"""Spacing between consecutive rows of a group (run metrics), and observed
spans of entities.

``consecutive_gaps`` never sorts a whole group in one task: the group is
split into time buckets, gaps inside a bucket come from a window over that
bucket only, and the gap across each bucket boundary comes from a second
window over the per-bucket (min, max) summaries, which hold one row per
bucket.  The maximum over both is exactly the maximum consecutive gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _gap_us(earlier, later):
    """Microseconds between two timestamps; zone-free for TIMESTAMP_NTZ (no
    cast through the session time zone, so DST never shifts a gap)."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def consecutive_gaps(df: DataFrame, group: Sequence[str], ts: str, split: str = "minute",
                     partitions: int | None = None) -> DataFrame:
    """Per group: n_rows, first_ts, last_ts, max_gap_us (NULL for a single
    row).

    ``split`` is a ``date_trunc`` unit (``minute``, ``hour``, …): buckets are
    calendar slices, one shuffle.  ``split="range"`` is the skew-proof form:
    rows are range-partitioned by (group, ts) — the sampled bounds cut even a
    group holding a third of all rows into equal time slices — and the
    partition id becomes the bucket (within a group, partition order is time
    order, so the edge stitching stays exact); it costs a second shuffle."""
    group = list(group)
    data = df.select(*group, F.col(ts).alias("__ts"))
    if split == "range":
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        data = data.repartitionByRange(n, *group, "__ts").withColumn("__b", F.spark_partition_id())
    else:
        data = data.withColumn("__b", F.date_trunc(split, "__ts"))
    w_in = Window.partitionBy(*group, "__b").orderBy("__ts")
    inner = data.withColumn("__gap", _gap_us(F.lag("__ts").over(w_in), F.col("__ts")))
    buckets = inner.groupBy(*group, "__b").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__ts").alias("__lo"), F.max("__ts").alias("__hi"),
        F.max("__gap").alias("__inner_max"))
    w_b = Window.partitionBy(*group).orderBy("__b")
    stitched = buckets.withColumn("__edge", _gap_us(F.lag("__hi").over(w_b), F.col("__lo")))
    return stitched.groupBy(*group).agg(
        F.sum("__n").alias("n_rows"),
        F.min("__lo").alias("first_ts"),
        F.max("__hi").alias("last_ts"),
        F.greatest(F.max("__inner_max"), F.max("__edge")).alias("max_gap_us"),
    )


def observed_span(entities: DataFrame, observations: DataFrame, key: str, obs_key: str, at: str,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Entities left-joined to their first/last observation dates and count.
    Observations are aggregated per key (partial aggregation) before the
    join, so a hot entity never moves more than one row per map task.  An
    entity never observed keeps NULL dates (a deliberate red for not-null)."""
    span = observations.groupBy(F.col(obs_key).alias("__k")).agg(
        F.min(F.col(at).cast("date")).alias("first_observed"),
        F.max(F.col(at).cast("date")).alias("last_observed"),
        F.count(F.lit(1)).alias("__n"))
    j = entities.select(key, *carry).join(span, F.col(key) == F.col("__k"), "left")
    return j.select(key, *carry, "first_observed", "last_observed",
                    F.coalesce(F.col("__n"), F.lit(0)).alias("n_observations"))
