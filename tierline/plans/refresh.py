"""Delta-driven refresh: changes of bronze followed into silver and gold.

The silver version notes the bronze version it was made from.  Rows that
differ between that version and the newest are found in the files that are in
one of the two only.  From the changed rows follow the games (of the changed
rows), the players and teams (of the changed rows and of all rows of those
games, as a game's date and season come from its team rows) and the seasons
(of the games before and after).  Facts and games are replaced by game;
players' and teams' histories lose and gain the rows of those games, and the
dimensions and stints of those players and teams are made anew from them.
Every step reads and writes the files that may hold an affected key, never a
whole table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import CONTRACTS
from tierline.plans import silver as S
from tierline.plans.build import SPECS, BuildResult, _publish, documented, publish_gold, silver_tables
from tierline.quality.core import run_checks
from tierline.quality.suite import silver_checks
from tierline.sinks.layers import Change, Layer, MergeReport


@dataclass
class RefreshReport:
    result: BuildResult = field(default_factory=BuildResult)
    #: rows that differ, by bronze table
    changed: dict[str, int] = field(default_factory=dict)
    #: files read and kept, by table
    files: dict[str, MergeReport] = field(default_factory=dict)
    full: bool = False


def changed_rows(layer: Layer, table: str, before: int, after: int, columns: list[str]) -> DataFrame:
    """Rows, as of both versions, that only one of the versions has; files
    that both versions hold are not read."""
    a, b = (layer.pointer(v)["tables"][table] for v in (before, after))
    fa, fb = layer._files(a), layer._files(b)
    gone = layer._read(table, a, fa.join(fb.select("path"), "path", "left_anti")).select(*columns)
    come = layer._read(table, b, fb.join(fa.select("path"), "path", "left_anti")).select(*columns)
    both = gone.withColumn("__n", F.lit(-1)).unionByName(come.withColumn("__n", F.lit(1)))
    return both.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0").drop("__n")


def refresh(spark: SparkSession, warehouse: str, seed: DataFrame | None = None) -> RefreshReport:
    """Bring silver and gold to the newest bronze version.  Gives what a build
    of all bronze rows gives; where the bronze version silver was made from is
    gone, silver and gold are built anew.  The silver checks gate the affected
    rows, as the others are those of the published version."""
    report = RefreshReport()
    bronze, silver = Layer(spark, f"{warehouse}/bronze"), Layer(spark, f"{warehouse}/silver")
    after, before = bronze.version(), silver.note("bronze")
    if before == after:
        return report
    change = silver.begin()
    back = {g: bronze.read(f"bronze_{g}", after) for g in ("player", "team")}
    if before not in bronze.versions():
        report.full = True
        for name, df in silver_tables(back["player"], back["team"]).items():
            change.put(name, documented(name, df), SPECS[name])
        frames = {t: change.frame(t) for t in change.entries}
        _publish(report.result, silver, change, run_checks(silver_checks(back, frames, seed)), bronze=after)
        publish_gold(spark, warehouse, report.result)
        return report
    columns = {g: [c.lower() for c, _ in CONTRACTS[g]] for g in back}
    diff = {g: changed_rows(bronze, f"bronze_{g}", before, after, columns[g]).checkpoint() for g in back}
    report.changed = {f"bronze_{g}": d.count() for g, d in diff.items()}
    if not any(report.changed.values()):
        report.result.versions["silver"] = change.commit(bronze=after)
        return report
    games = diff["player"].select("game_id").unionByName(diff["team"].select("game_id")).distinct().checkpoint()
    current = bronze.begin()
    rows = {g: current.rows_of(f"bronze_{g}", games).select(*columns[g]).checkpoint() for g in back}
    old_games = change.rows_of("dim_game", games).checkpoint()
    old_fact = change.rows_of("fact_player_game", games)

    new_games = S.dim_game(rows["team"]).checkpoint()
    facts = {"fact_player_game": S.fact_player_game(rows["player"]), "fact_team_game": S.fact_team_game(rows["team"]), "dim_game": new_games}
    for table, df in facts.items():
        report.files[table] = change.replace(table, games, documented(table, df))

    players = (rows["player"].select("player_id").unionByName(diff["player"].select("player_id"))
               .unionByName(old_fact.select("player_id")).distinct().checkpoint())
    teams = rows["team"].select("team_id").unionByName(diff["team"].select("team_id")).unionByName(rows["player"].select("team_id")).distinct().checkpoint()
    history = _history(change, report, "player_history", players, games, S.player_history(rows["player"], new_games))
    dim, stint = S.from_history(history)
    report.files["dim_player"] = change.replace("dim_player", players, documented("dim_player", dim))
    report.files["dim_player_team_stint"] = change.replace("dim_player_team_stint", players, documented("dim_player_team_stint", stint))
    names = _history(change, report, "team_history", teams, games, S.team_history(rows["team"]))
    report.files["dim_team"] = change.replace("dim_team", teams, documented("dim_team", S.dim_team(names)))

    of = {t: change.rows_of(t, k) for t, k in {"fact_player_game": games, "fact_team_game": games, "dim_game": games, "dim_player": players,
                                               "dim_player_team_stint": players, "dim_team": teams}.items()}
    _publish(report.result, silver, change, run_checks(silver_checks(rows, of, seed)), bronze=after)
    seasons = old_games.select("season_id").unionByName(new_games.select("season_id")).distinct()
    publish_gold(spark, warehouse, report.result, seasons)
    return report


def _history(change: Change, report: RefreshReport, table: str, keys: DataFrame, games: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the affected games' rows in the histories of ``keys``; the
    histories as they are then."""
    touched = change.touched(table, keys).checkpoint()
    stay = change.rows_of(table, keys, touched).join(games, "game_id", "left_anti")
    whole = stay.unionByName(new.select(*stay.columns)).checkpoint()
    report.files[table] = change.replace(table, keys, whole, touched)
    return whole
