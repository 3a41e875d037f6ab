"""Schemas and column contracts of the box-score landing.

Nothing here is inferred at read time: the envelope, the manifests and the
seed are read with these explicit schemas, and each grain's header list is
an ordered contract that decode and the drift check both use.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Path segments that become partition columns, in path order.
PARTITIONS = ["season", "grain", "season_type", "capture"]
# Partition columns of the published bronze tables, for the build and the stream alike.
BRONZE_PARTITIONS = ["season_id"]
# Default source / endpoint directories of the landing root (both are arguments everywhere).
DEFAULT_SOURCE, DEFAULT_ENDPOINT = "stats_api", "game_log"

# Header lists as published by the endpoint, in order.
TEAM_COLUMNS = (
    "SEASON_ID", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID", "GAME_DATE",
    "MATCHUP", "WL", "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
    "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS",
    "VIDEO_AVAILABLE",
)
PLAYER_COLUMNS = (
    "SEASON_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME",
    "GAME_ID", "GAME_DATE", "MATCHUP", "WL", "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A",
    "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV",
    "PF", "PTS", "PLUS_MINUS", "FANTASY_PTS", "VIDEO_AVAILABLE",
)

_STRING = {"SEASON_ID", "PLAYER_NAME", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID", "MATCHUP", "WL"}
_DOUBLE = {"FG_PCT", "FG3_PCT", "FT_PCT", "FANTASY_PTS"}
_DATE = {"GAME_DATE"}


def _type(name: str) -> str:
    if name in _STRING:
        return "string"
    if name in _DOUBLE:
        return "double"
    if name in _DATE:
        return "date"
    return "bigint"


CONTRACTS: dict[str, list[tuple[str, str]]] = {
    "player": [(c, _type(c)) for c in PLAYER_COLUMNS],
    "team": [(c, _type(c)) for c in TEAM_COLUMNS],
}
NATURAL_KEYS = {"player": ["game_id", "player_id"], "team": ["game_id", "team_id"]}
ENTITY = {"player": "player_id", "team": "team_id"}

RESULT_SET = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StringType())),
    T.StructField("rowSet", T.ArrayType(T.ArrayType(T.StringType()))),
])

ENVELOPE = T.StructType([
    T.StructField("resource", T.StringType()),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("resultSets", T.ArrayType(RESULT_SET)),
    *[T.StructField(p, T.StringType()) for p in PARTITIONS],
])

PROVENANCE_EDIT = T.StructType([
    T.StructField("match", T.MapType(T.StringType(), T.StringType())),
    T.StructField("row_position", T.LongType()),
    T.StructField("column", T.StringType()),
    T.StructField("value_before", T.StringType()),
    T.StructField("value_after", T.StringType()),
    T.StructField("reason", T.StringType()),
])

PROVENANCE = T.StructType([
    T.StructField("provenance_version", T.LongType()),
    T.StructField("case", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("trim_rule", T.StringType()),
    T.StructField("original_row_count", T.LongType()),
    T.StructField("retained_row_count", T.LongType()),
    T.StructField("game_ids", T.ArrayType(T.StringType())),
    T.StructField("game_count", T.LongType()),
    T.StructField("recapture", T.BooleanType()),
    T.StructField("edits", T.ArrayType(PROVENANCE_EDIT)),
])

MANIFEST = T.StructType([
    T.StructField("manifest_version", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("landing_key", T.StringType()),
    T.StructField("captured_at", T.StringType()),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("request_url", T.StringType()),
    T.StructField("http_status", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("payload_filename", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_sha256", T.StringType()),
    T.StructField("client", T.StringType()),
    T.StructField("client_version", T.StringType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("provenance", PROVENANCE),
    *[T.StructField(p, T.StringType()) for p in PARTITIONS],
])

RUN_CALL = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("grain", T.StringType()),
    T.StructField("season_type", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("http_status", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("capture", T.StringType()),
    T.StructField("written", T.BooleanType()),
    T.StructField("issued_at", T.StringType()),
])

RUN_MANIFEST = T.StructType([
    T.StructField("manifest_version", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("finished_at", T.StringType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("planned_calls", T.LongType()),
    T.StructField("calls_made", T.LongType()),
    T.StructField("captures_written", T.LongType()),
    T.StructField("captures_skipped", T.LongType()),
    T.StructField("recapture", T.BooleanType()),
    T.StructField("request_delay_seconds", T.DoubleType()),
    T.StructField("max_retries", T.LongType()),
    T.StructField("error", T.StringType()),
    T.StructField("calls", T.ArrayType(RUN_CALL)),
])

SEED = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("player_name", T.StringType()),
    T.StructField("as_of_date", T.DateType()),
    T.StructField("expected_team_id", T.LongType()),
    T.StructField("expected_team_name", T.StringType()),
    T.StructField("expectation_kind", T.StringType()),
    T.StructField("note", T.StringType()),
])

# Leading digit of SEASON_ID → season type label (other digits → NULL).
SEASON_TYPE_LABELS = {"2": "Regular Season", "4": "Playoffs"}
# Valid partition components.
GRAINS = ("player", "team")
SEASON_TYPES = ("regular", "playoffs")
SEASON_PATTERN = r"^\d{4}-\d{2}$"
GAME_ID_PATTERN = r"^\d{10}$"
# Months of the regular window (October through April).
WINDOW_MONTHS = (10, 11, 12, 1, 2, 3, 4)
# The 14 measures that must reconcile player → team with zero tolerance.
RECONCILED_MEASURES = ("pts", "fgm", "fga", "ftm", "fta", "fg3m", "fg3a", "oreb", "dreb", "reb", "ast", "stl",
                       "blk", "pf")
