"""Gold marts (declared in the reference, not built there): season context
per player — totals, per-100-possession rates, rank, percentile, league
average and within-season z-score.

Totals are pre-aggregated per (season, player) with partial aggregation;
the season windows then run over one row per player-season, a population
bounded by league size rather than by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The published box-score possessions estimate FGA + 0.44·FTA − OREB + TOV.
FTA_WEIGHT = 0.44


def possessions(fga="fga", fta="fta", oreb="oreb", tov="tov"):
    return F.col(fga) + F.lit(FTA_WEIGHT) * F.col(fta) - F.col(oreb) + F.col(tov)


def season_rankings(per: DataFrame, season: str, measure: str, avg_digits: int | None = None,
                    z_digits: int | None = None) -> DataFrame:
    """Rank (descending), percent rank, league average and within-season
    z-score of ``measure``.  ``per`` must already hold one row per entity
    and season (pre-aggregated), so each season window spans a population
    bounded by the number of entities, not by the data volume."""
    w = Window.partitionBy(season).orderBy(F.col(measure).desc())
    ws = Window.partitionBy(season)
    x = F.col(measure).cast("double")
    avg = F.avg(x).over(ws)
    z = F.try_divide(x - avg, F.stddev_pop(x).over(ws))  # null where a season's values are all equal
    return per.select(
        "*",
        F.rank().over(w).cast("bigint").alias(f"{measure}_rank"),
        F.percent_rank().over(w).alias(f"{measure}_pct_rank"),
        (F.round(avg, avg_digits) if avg_digits is not None else avg).alias("league_avg"),
        (F.round(z, z_digits) if z_digits is not None else z).alias("z_score"),
    )


def player_season_context(fact: DataFrame, games: DataFrame, measure: str = "pts") -> DataFrame:
    per = fact.join(games.select("game_id", "season_id"), "game_id").groupBy("season_id", "player_id").agg(
        F.count(F.lit(1)).alias("games"),
        F.sum(measure).alias(measure),
        F.sum("fga").alias("fga"), F.sum("fta").alias("fta"), F.sum("oreb").alias("oreb"), F.sum("tov").alias("tov"))
    poss = possessions()
    rates = per.select("season_id", "player_id", "games", measure, poss.alias("possessions"),
                       F.when(poss > 0, F.col(measure) * 100 / poss).alias(f"{measure}_per_100"))
    return season_rankings(rates, "season_id", measure)


def era_bounded(df: DataFrame, season: str, column: str, first_season: str) -> DataFrame:
    """Structurally absent ≠ missing: ``column`` is kept only for seasons from
    ``first_season`` on (the era it exists in); earlier seasons get NULL
    instead of a zero that would be averaged in."""
    return df.withColumn(column, F.when(F.col(season) >= F.lit(first_season), F.col(column)))


def publish_compact(df: DataFrame, path: str, sort_by: list[str], rows_per_file: int = 1_000_000) -> int:
    """Publish a mart as few, sorted Parquet files (readers prune row groups
    by the sort columns).  The file count follows the row count — one
    scalar ``count`` — instead of forcing everything through one task."""
    import math

    n = df.count()
    files = max(1, math.ceil(n / rows_per_file))
    df.repartitionByRange(files, *sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(path)
    return files
