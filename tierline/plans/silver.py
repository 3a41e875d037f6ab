"""Silver: dimensional core over bronze.

Dependency order: bronze ×2 → facts, dim_game, dim_team → dim_player,
dim_player_team_stint.  The facts never join back to the stint table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.contracts import SEASON_TYPE_LABELS
from tierline.functions.columns import code_label
from tierline.operators.gaps import observed_span
from tierline.operators.latest import latest_per_key
from tierline.operators.pairs import collapse_pair
from tierline.operators.stints import stints

MEASURES = ["fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct", "oreb", "dreb", "reb",
            "ast", "stl", "blk", "tov", "pf", "pts", "plus_minus"]


def home_row():
    """``matchup`` is the only home/away signal: ``AAA vs. BBB`` is the home side."""
    return F.col("matchup").like("% vs. %")


def away_row():
    return F.col("matchup").like("% @ %")


def fact_player_game(bronze_player: DataFrame) -> DataFrame:
    return bronze_player.select("game_id", "player_id", "team_id", F.col("min").alias("minutes_played"), *MEASURES)


def fact_team_game(bronze_team: DataFrame) -> DataFrame:
    return bronze_team.select("game_id", "team_id", F.col("min").alias("minutes_played"), *MEASURES)


def dim_game(bronze_team: DataFrame) -> DataFrame:
    """One row per game.  Grouped by (game_id, game_date, season_id) so two
    disagreeing rows surface as a duplicate game_id; home/away assigned only
    for the one-and-one shape; neutral = zero home rows and two away rows."""
    pair = collapse_pair(bronze_team, ["game_id", "game_date", "season_id"], home_row(), away_row(), "team_id",
                         a="home", b="away")
    return pair.select(
        "game_id", "game_date", "season_id",
        code_label(F.substring("season_id", 1, 1), SEASON_TYPE_LABELS).alias("season_type"),
        F.col("is_neutral").alias("is_neutral_site"),
        F.col("home_id").alias("home_team_id"), F.col("away_id").alias("away_team_id"))


def dim_team(bronze_team: DataFrame) -> DataFrame:
    """Latest observed name and abbreviation, both from the same row."""
    rows = bronze_team.select("team_id", "team_name", "team_abbreviation", "game_date", "game_id")
    return latest_per_key(rows, ["team_id"], ["game_date", "game_id"]).select(
        "team_id", "team_name", "team_abbreviation")


def dim_player(bronze_player: DataFrame, fact: DataFrame, games: DataFrame) -> DataFrame:
    """Latest observed name; observed span from fact ⋈ dim_game, left
    joined so a player without span keeps NULL dates (a not-null test fires)."""
    rows = bronze_player.select("player_id", "player_name", "game_date", "game_id")
    names = latest_per_key(rows, ["player_id"], ["game_date", "game_id"]).select("player_id", "player_name")
    obs = fact.select("player_id", "game_id").join(games.select("game_id", "game_date"), "game_id")
    span = observed_span(names, obs, key="player_id", obs_key="player_id", at="game_date", carry=["player_name"])
    return span.select("player_id", "player_name",
                       F.col("first_observed").alias("first_observed_game_date"),
                       F.col("last_observed").alias("last_observed_game_date"))


def player_observations(fact: DataFrame, games: DataFrame) -> DataFrame:
    return fact.select("player_id", "team_id", "game_id").join(
        games.select("game_id", "season_id", "game_date"), "game_id")


def dim_player_team_stint(fact: DataFrame, games: DataFrame) -> DataFrame:
    obs = player_observations(fact, games)
    st = stints(obs, entity="player_id", value="team_id", period="season_id", at="game_date", tiebreak=["game_id"])
    return st.select("player_id", "team_id", "season_id", "valid_from", "valid_to", "is_current",
                     F.col("last_seen").alias("last_game_prior_team"),
                     F.col("next_start").alias("first_game_new_team"))


def player_history(bronze_player: DataFrame, games: DataFrame) -> DataFrame:
    """What the player dimension and the stints are made of, a row per game
    row of the player and row of the game: found by player, so that a refresh
    reads the changed players' histories only.  ``found`` is null where the
    game has no row."""
    g = games.select("game_id", F.col("season_id").alias("game_season"), F.col("game_date").alias("played"), F.lit(True).alias("found"))
    return bronze_player.select("player_id", "player_name", "team_id", "game_id", "game_date").join(g, "game_id", "left").select(
        "player_id", "player_name", "team_id", "game_id", "game_date", "game_season", "played", "found")


def from_history(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``dim_player`` and ``dim_player_team_stint`` of the players in it."""
    fact = history.select("player_id", "team_id", "game_id").distinct()
    games = history.where("found").select("game_id", F.col("game_season").alias("season_id"), F.col("played").alias("game_date")).distinct()
    return dim_player(history, fact, games), dim_player_team_stint(fact, games)


def team_history(bronze_team: DataFrame) -> DataFrame:
    return bronze_team.select("team_id", "team_name", "team_abbreviation", "game_date", "game_id")


def build_silver(bronze_player: DataFrame, bronze_team: DataFrame) -> dict[str, DataFrame]:
    fpg = fact_player_game(bronze_player)
    ftg = fact_team_game(bronze_team)
    games = dim_game(bronze_team)
    return {
        "fact_player_game": fpg,
        "fact_team_game": ftg,
        "dim_game": games,
        "dim_team": dim_team(bronze_team),
        "dim_player": dim_player(bronze_player, fpg, games),
        "dim_player_team_stint": dim_player_team_stint(fpg, games),
    }
