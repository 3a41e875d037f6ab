"""Season-bounded SCD2 intervals from bare observations (gaps and islands).

Input: one row per (entity, date) observation with the observed value
(team, type, …) and the period (season) it belongs to.  Rules:

* partitioned by (entity, period), never grouped by value: A→B→A is three
  intervals;
* a new interval starts wherever the value differs null-safely from the
  previous observation;
* ``valid_to`` is the day before the next interval starts, so a date in a
  gap resolves to the *old* value; only a period's last interval closes at
  its own last observation; ``valid_to`` is never NULL;
* ``is_current`` marks the interval holding the entity's globally latest
  observation.

Physical plan: the observations are hash-partitioned by the entity once;
every window and the island group-by then reuse that partitioning (one
exchange).  Per entity the work is bounded by its number of observed dates.

``segmented_stints`` gives the same intervals where one entity may hold a
large share of all observations: it never sorts an entity in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions.columns import distinct_from


def stints(obs: DataFrame, entity: str, value: str, period: str, at: str,
           tiebreak: Sequence[str] = (), value_name: str | None = None,
           prepartition: bool = True) -> DataFrame:
    value_name = value_name or value
    data = obs.select(entity, value, period, at, *tiebreak)
    if prepartition:
        data = data.repartition(entity)
    w = Window.partitionBy(entity, period).orderBy(F.col(at), *[F.col(t) for t in tiebreak])
    flagged = (
        data.withColumn("__prior", F.lag(value).over(w))
        .withColumn("__start", F.when(distinct_from(value, "__prior"), 1).otherwise(0))
        .withColumn("__island", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    runs = flagged.groupBy(entity, period, "__island").agg(
        F.min(value).alias(value_name),
        F.min(at).alias("valid_from"),
        F.max(at).alias("last_seen"),
    )
    wp = Window.partitionBy(entity, period).orderBy("valid_from")
    we = Window.partitionBy(entity).orderBy(F.col("valid_from").desc())
    return (
        runs.withColumn("next_start", F.lead("valid_from").over(wp))
        .withColumn("valid_to", F.coalesce(F.date_sub("next_start", 1), F.col("last_seen")))
        .withColumn("is_current", F.row_number().over(we) == 1)
        .select(entity, value_name, period, "valid_from", "valid_to", "is_current", "last_seen", "next_start")
    )


def segmented_stints(obs: DataFrame, entity: str, value: str, period: str, at: str,
                     tiebreak: Sequence[str] = (), value_name: str | None = None, bucket: str = "month") -> DataFrame:
    """The intervals of ``stints`` from segments of time.

    The observations of an (entity, period) are cut by calendar bucket.  A
    window over one bucket's rows finds its islands; a segment is summed up as
    its first value, last value and number of islands, which is associative: a
    bucket's first island continues the last one before it where their values
    agree.  A scan over these summaries, one row per bucket, numbers all
    islands; their parts are then grouped, and an island's successor is that
    with the next number.  The observations of one bucket meet in a task, the
    summaries of one entity and period in another."""
    value_name = value_name or value
    data = obs.select(entity, value, period, at, *tiebreak).withColumn("__bucket", F.trunc(F.col(at).cast("date"), bucket))
    keys = [entity, period, "__bucket"]
    w = Window.partitionBy(*keys).orderBy(F.col(at), *[F.col(t) for t in tiebreak])
    flagged = (data.withColumn("__nth", F.row_number().over(w)).withColumn("__prior", F.lag(value).over(w))
               .withColumn("__start", F.when((F.col("__nth") == 1) | distinct_from(value, "__prior"), 1).otherwise(0))
               .withColumn("__local", F.sum("__start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1))
    parts = flagged.groupBy(*keys, "__local").agg(F.min(value).alias("__value"), F.min(at).alias("__from"), F.max(at).alias("__seen"))
    ends = F.struct(F.col("__local"), F.col("__value"))
    segments = parts.groupBy(*keys).agg(F.min(ends).alias("__a"), F.max(ends).alias("__z"))
    ws = Window.partitionBy(entity, period).orderBy("__bucket")
    joined = F.lag("__z").over(ws)
    segments = segments.withColumn("__joins", joined.isNotNull() & ~distinct_from(joined["__value"], F.col("__a.__value")))
    own = F.col("__z.__local") + 1 - F.col("__joins").cast("long")
    before = F.coalesce(F.sum(own).over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = segments.select(*[F.col(k).alias(f"{k}__s") for k in keys], (before - F.col("__joins").cast("long")).alias("__base"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}__s")) for k in keys]
    runs = parts.join(numbered, same).groupBy(entity, period, (F.col("__base") + F.col("__local")).alias("__island")).agg(
        F.min("__value").alias(value_name), F.min("__from").alias("valid_from"), F.max("__seen").alias("last_seen"))
    nxt = runs.select(F.col(entity).alias("__e"), F.col(period).alias("__p"), (F.col("__island") - 1).alias("__i"), F.col("valid_from").alias("next_start"))
    runs = runs.join(nxt, F.col(entity).eqNullSafe(F.col("__e")) & F.col(period).eqNullSafe(F.col("__p")) & (F.col("__island") == F.col("__i")), "left")
    last = runs.groupBy(F.col(entity).alias("__le")).agg(F.max(F.struct("valid_from", period, "__island")).alias("__last"))
    last = last.select("__le", F.col("__last.valid_from").alias("__lf"), F.col(f"__last.{period}").alias("__lp"), F.col("__last.__island").alias("__li"))
    here = (F.col(entity).eqNullSafe(F.col("__le")) & F.col("valid_from").eqNullSafe(F.col("__lf"))
            & F.col(period).eqNullSafe(F.col("__lp")) & (F.col("__island") == F.col("__li")))
    return runs.join(last, here, "left").select(
        entity, value_name, period, "valid_from", F.coalesce(F.date_sub("next_start", 1), F.col("last_seen")).alias("valid_to"),
        F.col("__li").isNotNull().alias("is_current"), "last_seen", "next_start")
