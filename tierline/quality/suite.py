"""The box-score quality suite: every check is a violations DataFrame
(empty = pass) and every check that could pass vacuously has a floor.

``bronze_checks`` gate bronze; ``silver_checks`` gate silver.  The build
runner (``plans.build``) publishes a layer only when all its checks are
empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import (
    CONTRACTS,
    GAME_ID_PATTERN,
    GRAINS,
    NATURAL_KEYS,
    PARTITIONS,
    RECONCILED_MEASURES,
    SEASON_PATTERN,
    SEASON_TYPES,
    WINDOW_MONTHS,
)
from tierline.functions.columns import distinct_from, numeric_text
from tierline.operators.decode import envelope_parts, header_drift
from tierline.operators.pairs import pair_violations
from tierline.operators.reconcile import child_sums, reconcile
from tierline.operators.reshape import compare_wide
from tierline.plans.bronze import decoded
from tierline.plans.silver import away_row, home_row, player_observations
from tierline.quality import checks as qc
from tierline.quality.core import Check, floor_rows, not_null, relationships, unique, with_floor

_ORDER = ["captured_at", "capture", "season", "season_type", "source_file"]


# ---------------------------------------------------------------- bronze
def row_count_matches_landed(envelopes: DataFrame, built: DataFrame, grain: str) -> DataFrame:
    """Q-01: winners re-derived from the landing per season_id vs built."""
    raw = decoded(envelopes, grain, strict=False)
    cmp = qc.landed_vs_built(raw, built, NATURAL_KEYS[grain], _ORDER, ["season_id"])
    return cmp.where("violates").withColumn("grain", F.lit(grain))


def latest_capture_wins(envelopes: DataFrame, built: DataFrame, grain: str) -> DataFrame:
    """Q-02: (a) no duplicate key survives, (b) the surviving row carries the
    key's latest capture, (c) every surviving value equals the winning
    capture's cell (numeric-normalised text), (d) floor on an empty model.
    The column-by-column comparison runs only on keys with >1 capture."""
    keys = NATURAL_KEYS[grain]
    raw = decoded(envelopes, grain, strict=False)
    dup = unique(built, keys).select(F.lit("duplicate_key").alias("violation"), *keys,
                                     F.lit(None).cast("string").alias("column_name"))
    rk = qc.recaptured_keys(raw, keys, "captured_at")
    b = built.join(rk.select(*keys, "latest_capture"), keys)
    stale = b.where(distinct_from("captured_at", "latest_capture")).select(
        F.lit("not_latest_capture").alias("violation"), *keys, F.lit(None).cast("string").alias("column_name"))
    cols = [n.lower() for n, _ in CONTRACTS[grain] if n.lower() not in keys]
    win_raw = raw.join(rk.select(*keys, F.col("latest_capture").alias("captured_at")), [*keys, "captured_at"],
                       "left_semi")
    gated = built.join(rk.select(*keys), keys, "left_semi")
    # one join on the key, then unpivot the pairs (never a join on the column name)
    cmp = compare_wide(win_raw, gated, keys, cols, "raw_value", "built_value", "full_outer", value_type="string")
    diff = cmp.where(distinct_from(numeric_text("raw_value"), numeric_text("built_value"))).select(
        F.lit("value_differs_from_winning_capture").alias("violation"), *keys, F.col("measure").alias("column_name"))
    out = dup.unionByName(stale).unionByName(diff)
    return with_floor(out, built, "floor_empty_model")


def game_id_fixed_width(models: Mapping[str, DataFrame], expected: list[str]) -> DataFrame:
    """Q-03: game_id is a string (plan-time), never NULL, exactly 10 digits,
    across every expected model; a model missing from ``models`` or empty
    is itself a violation."""
    parts = []
    for name in expected:
        df = models.get(name)
        if df is None:
            continue
        if df.schema["game_id"].dataType.typeName() != "string":
            raise TypeError(f"{name}.game_id is {df.schema['game_id'].dataType.simpleString()}, not string")
        bad = df.where(F.col("game_id").isNull() | ~F.col("game_id").rlike(GAME_ID_PATTERN)).select(
            F.lit(name).alias("model_name"), F.col("game_id"), F.lit("bad_game_id").alias("violation"))
        parts.append(bad.unionByName(floor_rows(df, "floor_empty_model").select(
            F.lit(name).alias("model_name"), F.lit(None).cast("string").alias("game_id"), "violation")))
    for name in expected:
        if name not in models:
            sp = SparkSession.getActiveSession()
            parts.append(sp.range(1).select(F.lit(name).alias("model_name"),
                                            F.lit(None).cast("string").alias("game_id"),
                                            F.lit("model_missing").alias("violation")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def header_contract_drift(envelopes: DataFrame, grain: str) -> DataFrame:
    """Q-19 / D-09: landed files whose headers drift from the contract."""
    parts = envelope_parts(envelopes.where(F.col("grain") == grain))
    return header_drift(parts, [n for n, _ in CONTRACTS[grain]], carry=[*PARTITIONS, "source_file"])


def duplicate_key_in_capture(envelopes: DataFrame, grain: str) -> DataFrame:
    """D-08: the same natural key twice inside one capture (dedup would hide it)."""
    raw = decoded(envelopes, grain, strict=False)
    return unique(raw, [*PARTITIONS, *NATURAL_KEYS[grain]])


def partition_keys_valid(envelopes: DataFrame) -> DataFrame:
    """Q-24: season ``YYYY-YY``, known grain and season type, capture stamp
    shape; floor on zero partitions."""
    p = envelopes.select(*PARTITIONS).distinct()
    bad = p.where(~F.col("season").rlike(SEASON_PATTERN) | ~F.col("grain").isin(*GRAINS)
                  | ~F.col("season_type").isin(*SEASON_TYPES) | ~F.col("capture").rlike(r"^\d{8}T\d{6}Z$"))
    return with_floor(bad.withColumn("violation", F.lit("bad_partition_key")), p, "floor_no_partitions")


def manifest_matches_payload(manifests: DataFrame, digests: DataFrame, envelopes: DataFrame,
                             audits: DataFrame | None = None) -> DataFrame:
    """Q-20: per capture, sha256 / bytes / row_count of its manifest, or of
    its audit row if Spark landed it, agree with the landed payload (digests
    from raw bytes, rows from the envelopes, summed over the capture's files)."""
    size = F.coalesce(F.size(F.get("resultSets", F.lit(0))["rowSet"]), F.lit(0))
    rows = envelopes.groupBy(*PARTITIONS).agg(F.sum(size).alias("rows"))
    files = digests.groupBy(*PARTITIONS).agg(F.sort_array(F.collect_list("sha256")).alias("sha256s"),
                                             F.sum("bytes").alias("bytes"))
    m = manifests.select(*PARTITIONS, F.array("payload_sha256").alias("payload_sha256s"),
                         F.col("payload_bytes").cast("long"), F.col("row_count").cast("long"))
    if audits is not None:
        m = m.unionByName(audits.select(*m.columns))
    j = m.join(files, PARTITIONS, "full_outer").join(rows, PARTITIONS, "full_outer")
    kinds = F.array_compact(F.array(
        F.when(distinct_from("payload_sha256s", "sha256s"), F.lit("sha256_mismatch")),
        F.when(distinct_from("payload_bytes", "bytes"), F.lit("bytes_mismatch")),
        F.when(distinct_from("row_count", "rows"), F.lit("row_count_mismatch"))))
    return j.select(*PARTITIONS, F.explode(kinds).alias("violation"))


def bronze_checks(envelopes: DataFrame, bronze: Mapping[str, DataFrame]) -> list[Check]:
    checks = []
    for grain, built in bronze.items():
        keys = NATURAL_KEYS[grain]
        checks += [
            Check(f"{grain}.row_count_matches_landed", row_count_matches_landed(envelopes, built, grain)),
            Check(f"{grain}.latest_capture_wins", latest_capture_wins(envelopes, built, grain)),
            Check(f"{grain}.header_contract", header_contract_drift(envelopes, grain).where(
                (F.size("missing") > 0) | (F.size("extra") > 0) | (F.col("width") != len(CONTRACTS[grain])))),
            Check(f"{grain}.header_order", header_contract_drift(envelopes, grain).where(~F.col("same_order")),
                  severity="warn"),
            Check(f"{grain}.duplicate_key_in_capture", duplicate_key_in_capture(envelopes, grain), severity="warn"),
            Check(f"{grain}.not_null_keys", with_floor(
                not_null(built, list(dict.fromkeys([*keys, "team_id", "season_id", "game_date", "plus_minus",
                                                    "captured_at"]))), built, "floor_empty_model")),
            Check(f"{grain}.unique_key", unique(built, keys)),
        ]
    checks.append(Check("partition_keys_valid", partition_keys_valid(envelopes)))
    checks.append(Check("game_id_fixed_width_bronze",
                        game_id_fixed_width({f"bronze_{g}": b for g, b in bronze.items()},
                                            [f"bronze_{g}" for g in GRAINS])))
    return checks


# ---------------------------------------------------------------- silver
def every_game_has_two_teams(bronze_team: DataFrame, games: DataFrame) -> DataFrame:
    """Q-04: seven violation kinds, home/away re-derived from bronze."""
    collapsed = games.select("game_id", "is_neutral_site", "home_team_id", "away_team_id").select(
        "game_id", F.col("is_neutral_site").alias("is_neutral"),
        F.col("home_team_id").alias("home_id"), F.col("away_team_id").alias("away_id"))
    return pair_violations(bronze_team, collapsed, ["game_id"], home_row(), away_row(), "team_id", a="home",
                           b="away")


def _floors(violations: DataFrame, fact_player: DataFrame, fact_team: DataFrame) -> DataFrame:
    """A check over both facts says nothing when one is empty: a row each."""
    return with_floor(with_floor(violations, fact_player, "floor_empty_player"), fact_team, "floor_empty_team")


def points_reconcile(fact_player: DataFrame, fact_team: DataFrame) -> DataFrame:
    """Q-06: 14 measures, player sums = team row, zero tolerance, long form;
    D-11: a measure NULL on both sides is reported too."""
    cmp = reconcile(fact_team, fact_player, ["game_id", "team_id"], list(RECONCILED_MEASURES),
                    parent_name="team_value", child_name="player_sum")
    both_null = F.col("team_value").isNull() & F.col("player_sum").isNull()
    return _floors(cmp.where(F.col("violates") | both_null), fact_player, fact_team)


def turnovers_never_below(fact_player: DataFrame, fact_team: DataFrame) -> DataFrame:
    """Q-10: team tov ≥ sum of player tov (team-only turnovers exist)."""
    sums = child_sums(fact_player, ["game_id", "team_id"], {"player_tov": "tov"})
    return _floors(qc.parent_below_children(
        fact_team.select("game_id", "team_id", F.col("tov").alias("team_tov")), sums, ["game_id", "team_id"],
        "team_tov", "player_tov"), fact_player, fact_team)


def minutes_regulation_plus_overtime(fact_team: DataFrame) -> DataFrame:
    """Q-11: team minutes = 240 + 25·k, NULL is a violation."""
    return with_floor(qc.residue_violations(fact_team, "minutes_played", 240, 25)
                      .withColumn("violation", F.lit("minutes_not_240_plus_25k")), fact_team, "floor_empty_model")


def made_never_exceeds_attempts(fact_player: DataFrame, fact_team: DataFrame) -> DataFrame:
    """Q-12: fgm ≤ fga on both grains; made beside NULL attempts violates."""
    p = qc.pairwise_bound(fact_player, lower="fgm", upper="fga", bounded="fgm")
    t = qc.pairwise_bound(fact_team, lower="fgm", upper="fga", bounded="fgm")
    out = p.select(F.lit("player").alias("grain"), "game_id", "team_id", "fgm", "fga").unionByName(
        t.select(F.lit("team").alias("grain"), "game_id", "team_id", "fgm", "fga"))
    return _floors(out, fact_player, fact_team)


def out_of_window_games(games: DataFrame, season_prefix: str, minimum: int = 3) -> DataFrame:
    """Q-13 (inverted): the named season must have ≥ ``minimum`` games
    outside October–April; fails when the property is absent."""
    g = games.where(F.substring("season_id", 2, 4) == season_prefix)
    n = g.agg(F.count_if(~F.month("game_date").isin(*WINDOW_MONTHS)).alias("n"))
    return n.where(F.col("n") < minimum).select(F.lit("property_absent").alias("violation"), "n")


def stint_containment(fact_player: DataFrame, games: DataFrame, stints: DataFrame) -> DataFrame:
    """Q-07: every observation lies in exactly one stint naming its team."""
    obs = player_observations(fact_player, games).select("player_id", "game_date", "team_id")
    iv = stints.select("player_id", F.col("team_id").alias("stint_team_id"), "valid_from", "valid_to")
    c = qc.containment(obs, iv, "player_id", "game_date", "team_id", "stint_team_id", bucket="month")
    return with_floor(c.where("violates").withColumn("violation", F.lit("not_contained_once")), obs,
                      "floor_no_observations")


def known_trades_resolve(seed: DataFrame, stints: DataFrame) -> DataFrame:
    """Q-08: each pinned (player, date) resolves to exactly one stint with
    the expected team; floors: empty seed, no interpolated row."""
    pins = seed.select("player_id", "as_of_date", F.col("expected_team_id").alias("expected_value"),
                       F.col("expectation_kind").alias("kind"))
    iv = stints.select("player_id", F.col("team_id").alias("stint_team_id"), "valid_from", "valid_to")
    res = qc.pinned_expectations(pins, iv, "player_id", "as_of_date", "expected_value", "stint_team_id",
                                 bucket="month")
    return res.where("violates")


def stints_not_degenerate(stints: DataFrame) -> DataFrame:
    """Q-09: some (player, season) has >1 stint; no inverted range."""
    return qc.degeneracy_violations(stints, ["player_id", "season_id"], "valid_from", "valid_to")


def two_rows_per_game(fact_team: DataFrame, fact_player: DataFrame) -> DataFrame:
    """Q-21: two team rows per game; player games ⊆ team games."""
    per = fact_team.groupBy("game_id").agg(F.count(F.lit(1)).alias("n")).where("n <> 2").select(
        "game_id", F.lit("team_rows_not_two").alias("violation"))
    orphan = fact_player.select("game_id").distinct().join(fact_team.select("game_id"), "game_id", "left_anti") \
        .select("game_id", F.lit("player_game_without_team_rows").alias("violation"))
    return _floors(per.unionByName(orphan), fact_player, fact_team)


def name_drift_population(bronze_rows: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Q-22 (inverted): the corpus must contain an id observed under two or
    more names, or the latest-name logic goes untested; floor row otherwise."""
    pop = bronze_rows.groupBy(id_col).agg(F.count_distinct(name_col).alias("n_names")).where("n_names > 1")
    return floor_rows(pop, f"no_{id_col}_with_two_names")


def unequal_team_game_counts(fact_team: DataFrame, games: DataFrame) -> DataFrame:
    """D-14: seasons whose teams played different numbers of games (a
    shortened or truncated season); reported, not fatal."""
    per = fact_team.join(games.select("game_id", "season_id"), "game_id").groupBy("season_id", "team_id").agg(
        F.count(F.lit(1)).alias("n_games"))
    return per.groupBy("season_id").agg(F.min("n_games").alias("min_games"), F.max("n_games").alias("max_games")) \
        .where("min_games <> max_games")


def plus_minus_negates(fact_team: DataFrame) -> DataFrame:
    """D-13: the two sides' plus_minus sum to zero per game; a NULL sum does not."""
    return fact_team.groupBy("game_id").agg(F.sum("plus_minus").alias("plus_minus_sum")).where(
        distinct_from("plus_minus_sum", F.lit(0)))


def silver_checks(bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame],
                  seed: DataFrame | None = None, corpus_season: str | None = None) -> list[Check]:
    fp, ft = silver["fact_player_game"], silver["fact_team_game"]
    g, dt, dp, st = silver["dim_game"], silver["dim_team"], silver["dim_player"], silver["dim_player_team_stint"]
    checks = [
        Check("dim_game.two_teams", every_game_has_two_teams(bronze["team"], g)),
        Check("fact_player_game.grain_sentry", qc.grain_sentry(fp, bronze["player"], ["game_id", "player_id"],
                                                               "fact", "bronze")),
        Check("fact_team_game.grain_sentry", qc.grain_sentry(ft, bronze["team"], ["game_id", "team_id"],
                                                             "fact", "bronze")),
        Check("points_reconcile", points_reconcile(fp, ft)),
        Check("turnovers_never_below", turnovers_never_below(fp, ft)),
        Check("minutes_regulation_plus_overtime", minutes_regulation_plus_overtime(ft)),
        Check("made_never_exceeds_attempts", made_never_exceeds_attempts(fp, ft)),
        Check("stint_containment", stint_containment(fp, g, st)),
        Check("stints_not_degenerate", stints_not_degenerate(st)),
        Check("stint_ranges_exclusive", qc.mutually_exclusive_ranges(st, ["player_id"], "valid_from", "valid_to")),
        Check("two_rows_per_game", two_rows_per_game(ft, fp)),
        Check("game_id_fixed_width_silver", game_id_fixed_width(
            {"fact_player_game": fp, "fact_team_game": ft, "dim_game": g},
            ["fact_player_game", "fact_team_game", "dim_game"])),
        Check("dim_game.unique", unique(g, ["game_id"])),
        Check("dim_team.unique", unique(dt, ["team_id"])),
        Check("dim_player.unique", unique(dp, ["player_id"])),
        Check("fact_player_game.unique", unique(fp, ["game_id", "player_id"])),
        Check("fact_team_game.unique", unique(ft, ["game_id", "team_id"])),
        Check("stint.unique_start", unique(st, ["player_id", "valid_from"])),
        Check("stint.one_current", unique(st, ["player_id"], where="is_current")),
        Check("dim_game.not_null", not_null(g, ["game_id", "game_date", "season_id", "season_type",
                                               "is_neutral_site"])),
        Check("dim_player.not_null", not_null(dp, ["player_id", "player_name", "first_observed_game_date",
                                                  "last_observed_game_date"])),
        Check("dim_team.not_null", not_null(dt, ["team_id", "team_name", "team_abbreviation"])),
        Check("stint.not_null", not_null(st, ["player_id", "team_id", "season_id", "valid_from", "valid_to",
                                              "is_current", "last_game_prior_team"])),
        Check("fact_player_game.not_null", not_null(fp, ["game_id", "player_id", "team_id", "plus_minus"])),
        Check("fact_team_game.not_null", not_null(ft, ["game_id", "team_id"])),
        Check("rel.fact_player_game.game_id", relationships(fp, "game_id", g, "game_id")),
        Check("rel.fact_player_game.player_id", relationships(fp, "player_id", dp, "player_id")),
        Check("rel.fact_player_game.team_id", relationships(fp, "team_id", dt, "team_id")),
        Check("rel.fact_team_game.game_id", relationships(ft, "game_id", g, "game_id")),
        Check("rel.fact_team_game.team_id", relationships(ft, "team_id", dt, "team_id")),
        Check("rel.stint.player_id", relationships(st, "player_id", dp, "player_id")),
        Check("rel.stint.team_id", relationships(st, "team_id", dt, "team_id")),
        Check("plus_minus_negates", plus_minus_negates(ft), severity="warn"),
        Check("team_name_drift_population", name_drift_population(bronze["team"], "team_id", "team_name"),
              severity="warn"),
        Check("player_name_drift_population", name_drift_population(bronze["player"], "player_id", "player_name"),
              severity="warn"),
        Check("unequal_team_game_counts", unequal_team_game_counts(ft, g), severity="warn"),
    ]
    if seed is not None:
        checks.append(Check("known_trades_resolve", known_trades_resolve(seed, st)))
    if corpus_season is not None:
        checks.append(Check("out_of_window_games", out_of_window_games(g, corpus_season)))
    return checks


# ---------------------------------------------------------------- gold
def gold_checks(context: DataFrame, fact_player: DataFrame, games: DataFrame) -> list[Check]:
    """One row per season and player of the facts, whole totals, a first rank
    in every season, and z-scores that cancel out within it."""
    played = fact_player.join(games.select("game_id", "season_id"), "game_id")
    expected = played.groupBy("season_id").agg(F.count_distinct("player_id").alias("players"), F.sum("pts").alias("points"))
    got = context.groupBy(F.col("season_id").alias("s")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pts").alias("pts"), F.min("pts_rank").alias("best"), F.max("pts_rank").alias("worst"),
        F.sum("z_score").alias("z"))
    totals = expected.join(got, F.col("season_id").eqNullSafe(F.col("s")), "full_outer").where(
        distinct_from("players", "rows") | distinct_from("points", "pts") | distinct_from("best", F.lit(1))
        | (F.col("worst") > F.col("rows")) | (F.abs("z") > F.lit(1e-6) * F.col("rows")))
    return [
        Check("context.season_totals", with_floor(totals.select("season_id", F.lit("season_differs").alias("violation")), context, "floor_empty_mart")),
        Check("context.unique", unique(context, ["season_id", "player_id"])),
        Check("context.not_null", not_null(context, ["season_id", "player_id", "games", "pts", "pts_rank", "league_avg"])),
    ]
