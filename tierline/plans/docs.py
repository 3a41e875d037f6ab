"""Persisted documentation: table and column descriptions travel with the
data as Spark column metadata (stored in the Parquet footer's Spark schema),
so a reader of the published files sees them without a catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_COUNTS = {
    "fgm": "field goals made", "fga": "field goals attempted", "fg_pct": "field goals made per attempt, null without attempts",
    "fg3m": "three-point goals made", "fg3a": "three-point goals attempted", "fg3_pct": "three-point goals made per attempt, null without attempts",
    "ftm": "free throws made", "fta": "free throws attempted", "ft_pct": "free throws made per attempt, null without attempts",
    "oreb": "offensive rebounds", "dreb": "defensive rebounds", "reb": "rebounds", "ast": "assists", "stl": "steals", "blk": "blocks",
    "tov": "turnovers", "pf": "personal fouls", "pts": "points", "plus_minus": "score margin while on the floor",
}
_GAME = {"game_id": "10-digit zero-padded game id (string)"}
_CAPTURE = {
    "captured_at": "time of the capture the row won by", "capture": "stamp of that capture", "season": "season folder of that capture",
    "season_type": "season type folder of that capture", "source_file": "file the row was read from",
}
_LINE = _GAME | _COUNTS | _CAPTURE | {
    "season_id": "season id, its first digit telling the season type", "team_id": "team", "team_abbreviation": "team's short name at that game",
    "team_name": "team's name at that game", "game_date": "day of the game", "matchup": "both teams; vs. on the home side, @ on the other",
    "wl": "won or lost", "min": "minutes", "video_available": "flag of the source",
}

#: Descriptions of all published models and their columns; the empty name is the table.
MODEL_DOCS: dict[str, dict[str, str]] = {
    "bronze_player": {"": "one row per game and player, from the latest capture that holds it"} | _LINE | {
        "player_id": "player", "player_name": "player's name at that game", "fantasy_pts": "fantasy points of the source"},
    "bronze_team": {"": "one row per game and team, from the latest capture that holds it"} | _LINE,
    "fact_player_game": {"": "box score line of a player in a game"} | _GAME | _COUNTS | {
        "player_id": "player", "team_id": "team played for", "minutes_played": "whole minutes; 0 for a dressed-but-unused player"},
    "fact_team_game": {"": "box score line of a team in a game"} | _GAME | _COUNTS | {
        "team_id": "team", "minutes_played": "player minutes of the team, 240 and 25 per overtime"},
    "dim_game": {"": "one row per game"} | _GAME | {
        "game_date": "day of the game", "season_id": "season id",
        "season_type": "label from the leading digit of season_id; unknown digits stay NULL",
        "is_neutral_site": "true when both team rows read '@'; home/away ids are then NULL",
        "home_team_id": "team of the home row, where there is one row of each kind", "away_team_id": "team of the away row, likewise"},
    "dim_team": {"": "one row per team", "team_id": "team", "team_name": "name in its latest game", "team_abbreviation": "short name in its latest game"},
    "dim_player": {"": "one row per player", "player_id": "player", "player_name": "name in the latest game",
                   "first_observed_game_date": "first game", "last_observed_game_date": "last game"},
    "dim_player_team_stint": {
        "": "spells of a player with a team inside a season", "player_id": "player", "team_id": "team", "season_id": "season",
        "valid_from": "first observed game of the stint",
        "valid_to": "day before the next stint starts; a season's last stint closes at its last game",
        "is_current": "stint holding the player's globally latest observation",
        "last_game_prior_team": "last observed game of the stint", "first_game_new_team": "first game of the season's next stint, NULL for the last"},
    "player_history": {"": "rows of players with their games, found by player; what refreshes recompute dimensions from"} | _GAME | {
        "player_id": "player", "player_name": "name at that game", "team_id": "team at that game", "game_date": "day on the player's row",
        "game_season": "season of the game", "played": "day of the game", "found": "true where the game has a row"},
    "team_history": {"": "names of teams by game, found by team"} | _GAME | {
        "team_id": "team", "team_name": "name at that game", "team_abbreviation": "short name at that game", "game_date": "day on the team's row"},
    "player_season_context": {
        "": "a player's season beside the league's", "season_id": "season id", "player_id": "player", "games": "games played", "pts": "points",
        "possessions": "estimated possessions", "pts_per_100": "points per 100 possessions, NULL without possessions",
        "pts_rank": "rank by points, 1 the most", "pts_pct_rank": "share of the league ranked above", "league_avg": "average points of the season's players",
        "z_score": "points less the average, in standard deviations"},
}


def document(df: DataFrame, columns: Mapping[str, str], table: str | None = None) -> DataFrame:
    """Attach ``comment`` metadata to the named columns (and the table
    description to every column as ``table_comment``)."""
    out = []
    for f in df.schema.fields:
        meta = dict(f.metadata)
        if f.name in columns:
            meta["comment"] = columns[f.name]
        if table:
            meta["table_comment"] = table
        out.append(F.col(f.name).alias(f.name, metadata=meta))
    return df.select(*out)
