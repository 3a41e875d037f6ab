"""Layer runner with a promotion gate.

bronze → checks → publish → silver (read back from the published bronze)
→ checks → publish → gold (season context mart) → checks → publish.
Each layer is staged as a new version (``sinks.layers``): its files are
written once, the checks run over the staged files, and the version is
committed only when every error-severity check is empty.  A failing layer
raises ``PromotionError``, its staged files go, and readers keep the version
they had.  A build that dies anywhere leaves every layer at a whole version.

``refresh`` follows the changes of bronze into silver and gold instead of
building them anew (``plans.refresh``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tierline.contracts import BRONZE_PARTITIONS, DEFAULT_ENDPOINT, DEFAULT_SOURCE, PARTITIONS
from tierline.plans.bronze import bronze, landed_envelopes
from tierline.plans.docs import MODEL_DOCS, document
from tierline.plans.gold import player_season_context
from tierline.plans.landing import landing_audits
from tierline.plans.silver import build_silver, player_history, team_history
from tierline.quality.core import Check, CheckResult, run_checks
from tierline.quality.suite import bronze_checks, gold_checks, manifest_matches_payload, silver_checks
from tierline.session import ensure_checkpoint_dir
from tierline.sinks.layers import Change, Layer, TableSpec
from tierline.sources.landing import endpoint_root, path_exists, payload_digests, read_manifests, read_seed


class PromotionError(RuntimeError):
    def __init__(self, layer: str, failed: list[CheckResult]):
        super().__init__(f"{layer} not published; failing checks: "
                         + ", ".join(f"{r.name}={r.violations}" for r in failed))
        self.layer = layer
        self.failed = failed


#: Season and season type of a game id, the cell of all tables found by game.
GAME_CELL = "substring(game_id, 1, 5)"
#: The tables of a warehouse and how changes find their rows.
BY_GAME = TableSpec(["game_id"], cell=GAME_CELL)
SPECS: dict[str, TableSpec] = {
    "bronze_player": TableSpec(["game_id"], BRONZE_PARTITIONS, GAME_CELL),
    "bronze_team": TableSpec(["game_id"], BRONZE_PARTITIONS, GAME_CELL),
    "fact_player_game": BY_GAME,
    "fact_team_game": BY_GAME,
    "dim_game": BY_GAME,
    "dim_team": TableSpec(["team_id"]),
    "dim_player": TableSpec(["player_id"], cell="player_id div 100000"),
    "dim_player_team_stint": TableSpec(["player_id"], cell="player_id div 100000"),
    "player_history": TableSpec(["player_id"], cell="player_id div 100000"),
    "team_history": TableSpec(["team_id"]),
    "player_season_context": TableSpec(["season_id"], cell="season_id"),
}


@dataclass
class BuildResult:
    tables: dict[str, str] = field(default_factory=dict)
    checks: dict[str, list[CheckResult]] = field(default_factory=dict)
    versions: dict[str, int] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table in the newest version of its layer."""
        return Layer(spark, self.tables[table]).read(table)


def gate(layer: str, change: Change, results: list[CheckResult]) -> None:
    """Raise, and drop what was staged, unless all error checks are empty."""
    failed = [r for r in results if r.severity == "error" and not r.passed]
    if failed:
        change.abort()
        raise PromotionError(layer, failed)


def documented(table: str, df: DataFrame) -> DataFrame:
    docs = MODEL_DOCS.get(table, {})
    return document(df, {c: d for c, d in docs.items() if c in df.columns}, docs.get(""))


def silver_tables(bronze_player: DataFrame, bronze_team: DataFrame) -> dict[str, DataFrame]:
    """The published silver models and the histories refreshes read."""
    models = build_silver(bronze_player, bronze_team)
    return models | {"player_history": player_history(bronze_player, models["dim_game"]), "team_history": team_history(bronze_team)}


def _publish(res: BuildResult, layer: Layer, change: Change, results: list[CheckResult], **notes) -> None:
    name = layer.path.rsplit("/", 1)[-1]
    res.checks[name] = results
    gate(name, change, results)
    res.versions[name] = change.commit(**notes)
    res.tables |= {t: layer.path for t in change.entries}
    layer.retire()


def build(spark: SparkSession, root: str, warehouse: str, seed_path: str | None = None,
          corpus_season: str | None = None, source: str = DEFAULT_SOURCE,
          endpoint: str = DEFAULT_ENDPOINT) -> BuildResult:
    ensure_checkpoint_dir(spark)
    base = endpoint_root(root, source, endpoint)
    if not path_exists(spark, base):
        raise FileNotFoundError(f"no landing at {base}")
    res = BuildResult()
    env = landed_envelopes(spark, root, source, endpoint).checkpoint()
    layer = Layer(spark, f"{warehouse}/bronze")
    change = layer.begin()
    for g in ("player", "team"):
        change.put(f"bronze_{g}", documented(f"bronze_{g}", bronze(env, g, provenance=True)), SPECS[f"bronze_{g}"])
    staged = {g: change.frame(f"bronze_{g}") for g in ("player", "team")}
    provenance = manifest_matches_payload(
        read_manifests(spark, root, source, endpoint),
        payload_digests(spark, root, source, endpoint).join(env.select(*PARTITIONS).distinct(), PARTITIONS, "left_semi"),
        env, landing_audits(spark, root, source, endpoint))
    _publish(res, layer, change, run_checks([*bronze_checks(env, staged), Check("manifest_matches_payload", provenance)]))
    at = res.versions["bronze"]
    back = {g: layer.read(f"bronze_{g}", at) for g in ("player", "team")}
    silver = Layer(spark, f"{warehouse}/silver")
    change = silver.begin()
    for name, df in silver_tables(back["player"], back["team"]).items():
        change.put(name, documented(name, df), SPECS[name])
    frames = {t: change.frame(t) for t in change.entries}
    seed = read_seed(spark, seed_path) if seed_path else None
    _publish(res, silver, change, run_checks(silver_checks(back, frames, seed, corpus_season)), bronze=at)
    publish_gold(spark, warehouse, res)
    return res


def publish_gold(spark: SparkSession, warehouse: str, res: BuildResult, seasons: DataFrame | None = None) -> None:
    """The season mart of the newest silver version; of ``seasons`` alone
    where they are given and gold was published before."""
    silver, gold = Layer(spark, f"{warehouse}/silver"), Layer(spark, f"{warehouse}/gold")
    at = silver.version()
    fact, games = silver.read("fact_player_game", at), silver.read("dim_game", at)
    change = gold.begin()
    table = "player_season_context"
    if seasons is not None and table in change.entries:
        old = change.entries[table]
        games = games.join(seasons, "season_id", "left_semi")
        change.replace(table, seasons, documented(table, player_season_context(fact, games)))
        assert change.entries[table] is not old
    else:
        change.put(table, documented(table, player_season_context(fact, games)), SPECS[table])
        seasons = None
    mart = change.frame(table)
    mart = mart.join(seasons, "season_id", "left_semi") if seasons is not None else mart
    _publish(res, gold, change, run_checks(gold_checks(mart, fact, games)), silver=at)


def layers(warehouse: str) -> Mapping[str, str]:
    return {n: f"{warehouse}/{n}" for n in ("bronze", "silver", "gold")}
