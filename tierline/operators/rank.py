"""Rank, percentile and distance from the average without a window over a
whole group.

Rows are range-partitioned by (group, measure), so equal values share a
partition and no group has to fit in one.  A row's rank is its rank inside its
partition plus the group's rows in the partitions before, which are prefix
sums over one row per (partition, group); averages and deviations are plain
aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import ensure_checkpoint_dir


def distributed_rank(df: DataFrame, group: str, measure: str) -> DataFrame:
    """``df`` with ``<measure>_rank`` (1 the greatest, ties share a rank, null
    last), ``<measure>_pct_rank``, ``group_avg`` and ``z_score`` (null where
    all values are equal) within ``group``.  Null groups are one group.  The ranged rows are checkpointed:
    ranks and offsets must be taken from the same partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    order = F.col(measure).desc()
    ranged = df.repartitionByRange(F.col(group), order).withColumn("__part", F.spark_partition_id()).checkpoint()
    x = F.col(measure).cast("double")
    per = ranged.groupBy("__part", group).agg(F.count(F.lit(1)).alias("__n"))
    # a group has at most one row per partition here
    whole = Window.partitionBy(group)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("__part").alias("__p"), F.col(group).alias("__g"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                     F.sum("__n").over(whole).alias("__rows"))
    stats = ranged.groupBy(F.col(group).alias("__sg")).agg(F.avg(x).alias("group_avg"), F.stddev_pop(x).alias("__dev"))
    per = per.join(stats, F.col("__g").eqNullSafe(F.col("__sg"))).drop("__sg")
    inside = F.rank().over(Window.partitionBy("__part", group).orderBy(order))
    ranked = ranged.withColumn("__inside", inside).join(per, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g")))
    rank = F.col("__before") + F.col("__inside")
    return ranked.select(
        *df.columns, rank.cast("bigint").alias(f"{measure}_rank"),
        F.when(F.col("__rows") > 1, (rank - 1) / (F.col("__rows") - 1)).otherwise(F.lit(0.0)).alias(f"{measure}_pct_rank"),
        "group_avg", F.try_divide(x - F.col("group_avg"), F.col("__dev")).alias("z_score"))
