"""Box-score models and quality suite on the synthetic landing: correct
cases, mutants that must redden a named check, and empty-input floors."""

import hashlib
import json
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.fixtures import BOOMERANG, ENDPOINT, SOURCE, TEAMS, TRADED
from tierline.contracts import NATURAL_KEYS
from tierline.operators.latest import latest_per_key
from tierline.plans import build as build_mod
from tierline.plans.bronze import bronze, decoded, landed_envelopes
from tierline.plans.gold import era_bounded, player_season_context
from tierline.plans.silver import build_silver
from tierline.quality import checks as qc
from tierline.quality import suite
from tierline.sinks.layers import Layer
from tierline.sources.landing import orphan_payloads, payload_digests, read_envelopes, read_manifests, read_seed


@pytest.fixture(scope="module")
def env(spark, landing):
    return landed_envelopes(spark, landing["root"]).cache()


@pytest.fixture(scope="module")
def bronze_tables(env):
    return {g: bronze(env, g).cache() for g in ("player", "team")}


@pytest.fixture(scope="module")
def silver_tables(bronze_tables):
    return {k: v.cache() for k, v in build_silver(bronze_tables["player"], bronze_tables["team"]).items()}


def test_partitions_are_strings_and_orphans_excluded(spark, landing, env):
    assert {f.name: f.dataType.simpleString() for f in env.schema.fields}["season"] == "string"
    assert env.count() == 6
    raw = read_envelopes(spark, landing["root"], SOURCE, ENDPOINT)
    orphans = orphan_payloads(raw, read_manifests(spark, landing["root"], SOURCE, ENDPOINT))
    assert [r.capture for r in orphans.collect()] == ["20260815T130000Z"]


def test_bronze_grain_and_restatement(bronze_tables, landing):
    team, player = bronze_tables["team"], bronze_tables["player"]
    assert team.count() == len(landing["teams"])
    assert player.count() == len(landing["players"])
    restated = {r.team_id: r.video_available for r in team.where("game_id = '0020300003'").collect()}
    assert restated[TEAMS[1][0]] == 99 and restated[TEAMS[2][0]] == 0
    assert dict(team.dtypes)["game_id"] == "string"
    assert team.where("game_id = '0020300001'").first().game_id == "0020300001"
    dnp = player.where("player_id = 1000 and game_id = '0021900001'").first()
    assert dnp.min == 0 and dnp.fg_pct is None and dnp.fga == 0


def test_reordered_headers_decode_by_name(bronze_tables, landing):
    t19 = {(r["GAME_ID"], r["TEAM_ID"]): r["PTS"] for r in landing["teams"] if r["SEASON_ID"] == "22019"}
    got = {(r.game_id, r.team_id): r.pts for r in bronze_tables["team"].where("season_id = '22019'").collect()}
    assert got == t19


def test_strict_decode_raises_on_missing_header(spark):
    from tierline.operators.decode import decode_envelope

    df = spark.createDataFrame([("f1", ["A", "B"], [["1", "2"]])], "source_file string, headers array<string>, "
                                                                  "rows array<array<string>>")
    with pytest.raises(Exception, match="missing header C"):
        decode_envelope(df, [("A", "bigint"), ("C", "bigint")], carry=["source_file"], where="source_file").collect()
    lenient = decode_envelope(df, [("A", "bigint"), ("C", "bigint")], carry=["source_file"], strict=False)
    assert lenient.first().c is None


@pytest.mark.parametrize("headers,rows", [(["A", "B"], [["1"]]), (["A", "X"], [["1", "2"]])])
def test_strict_decode_raises_whatever_is_read(spark, headers, rows):
    from tierline.operators.decode import decode_envelope

    df = spark.createDataFrame([("f1", headers, rows)], "source_file string, headers array<string>, "
                                                        "rows array<array<string>>")
    d = decode_envelope(df, [("A", "bigint"), ("B", "bigint")], carry=["source_file"], where="source_file")
    for read in (d.select("a"), d.select("source_file")):
        with pytest.raises(Exception, match="ragged row in capture f1|missing header B in capture f1"):
            read.collect()
    with pytest.raises(Exception, match="ragged row|missing header"):
        d.count()


@pytest.mark.parametrize("payload", [{}, {"resultSets": []}])
def test_envelope_without_result_set_is_red_and_named(spark, landing, payload):
    env = landed_envelopes(spark, landing["root"])
    lost = env.where("grain = 'team' and season = '2019-20'").withColumn(
        "resultSets", F.from_json(F.lit(json.dumps(payload)), env.select("resultSets").schema)["resultSets"])
    drift = suite.header_contract_drift(lost, "team").collect()
    assert [r.season for r in drift] == ["2019-20"] and "season=2019-20" in drift[0].source_file
    assert bronze(lost, "team").count() == 0


def test_checks_over_empty_facts_have_floors(silver_tables):
    p, t = silver_tables["fact_player_game"].limit(0), silver_tables["fact_team_game"].limit(0)
    for check in (suite.points_reconcile, suite.turnovers_never_below, suite.made_never_exceeds_attempts):
        assert {r.violation for r in check(p, t).collect()} == {"floor_empty_player", "floor_empty_team"}
    assert {r.violation for r in suite.two_rows_per_game(t, p).collect()} == {"floor_empty_player", "floor_empty_team"}


def test_missing_bronze_grain_is_a_violation(env, bronze_tables):
    failed = _errors(build_mod.run_checks([c for c in suite.bronze_checks(env, {"team": bronze_tables["team"]})
                                           if c.name == "game_id_fixed_width_bronze"]))
    assert failed == {"game_id_fixed_width_bronze": 1}


def test_build_refuses_a_root_that_does_not_exist(spark):
    with pytest.raises(FileNotFoundError):
        build_mod.build(spark, tempfile.mkdtemp() + "/nothing", tempfile.mkdtemp())


def test_ragged_row_raises(spark):
    from tierline.operators.decode import decode_envelope

    df = spark.createDataFrame([("f1", ["A", "B"], [["1"]])], "source_file string, headers array<string>, "
                                                             "rows array<array<string>>")
    with pytest.raises(Exception, match="ragged row"):
        decode_envelope(df, [("A", "bigint"), ("B", "bigint")], carry=["source_file"], where="source_file").collect()


def _errors(results):
    return {r.name: r.violations for r in results if r.severity == "error" and r.violations}


def test_bronze_and_silver_checks_pass(spark, env, bronze_tables, silver_tables, landing):
    from tierline.quality.core import run_checks

    assert _errors(run_checks(suite.bronze_checks(env, bronze_tables))) == {}
    seed = read_seed(spark, landing["seed"])
    assert _errors(run_checks(suite.silver_checks(bronze_tables, silver_tables, seed, "2019"))) == {}


def test_header_order_drift_is_reported_as_warning(env):
    drift = suite.header_contract_drift(env, "team").collect()
    assert len(drift) == 1 and drift[0].season == "2019-20" and not drift[0].same_order


def test_stints_follow_boundary_rules(silver_tables):
    st = silver_tables["dim_player_team_stint"]
    t = {r.valid_from.isoformat(): (r.team_id, r.valid_to.isoformat(), r.is_current)
         for r in st.where(f"player_id = {TRADED}").collect()}
    assert t == {"2003-11-01": (TEAMS[0][0], "2003-11-07", False), "2003-11-08": (TEAMS[3][0], "2003-11-12", True)}
    b = st.where(f"player_id = {BOOMERANG}").orderBy("valid_from").collect()
    assert [r.team_id for r in b] == [TEAMS[1][0], TEAMS[2][0], TEAMS[1][0]]
    two = st.where("player_id = 1000").collect()
    assert len(two) == 2 and sum(r.is_current for r in two) == 1


def test_dim_game_neutral_and_home_away(silver_tables):
    g = {r.game_id: r for r in silver_tables["dim_game"].collect()}
    assert g["0020300005"].is_neutral_site and g["0020300005"].home_team_id is None
    assert g["0020300001"].home_team_id == TEAMS[0][0] and g["0020300001"].away_team_id == TEAMS[1][0]
    assert g["0020300001"].season_type == "Regular Season"


def test_latest_name_wins_and_drift_population(bronze_tables, silver_tables):
    t = {r.team_id: r.team_name for r in silver_tables["dim_team"].collect()}
    assert t[TEAMS[2][0]] == "Team 02 Renamed" and t[TEAMS[0][0]] == "Team 00"
    assert silver_tables["dim_player"].where("player_id = 1000").first().player_name == "P1000"
    assert suite.name_drift_population(bronze_tables["team"], "team_id", "team_name").count() == 0
    assert suite.name_drift_population(bronze_tables["team"].where("season_id = '22003'"), "team_id",
                                       "team_name").count() == 1
    assert suite.unequal_team_game_counts(silver_tables["fact_team_game"], silver_tables["dim_game"]).count() == 2


def test_dim_player_span(silver_tables):
    p = silver_tables["dim_player"].where(f"player_id = {TRADED}").first()
    assert (p.first_observed_game_date.isoformat(), p.last_observed_game_date.isoformat()) == ("2003-11-01",
                                                                                               "2003-11-12")


# ---------------------------------------------------------------- mutants
def test_mutant_ascending_dedup_fails_latest_capture_wins(env, bronze_tables):
    rows = decoded(env, "team")
    wrong = latest_per_key(rows, NATURAL_KEYS["team"], [("captured_at", False)]).drop(
        "season", "grain", "season_type", "capture", "source_file")
    assert suite.latest_capture_wins(env, wrong, "team").count() > 0
    assert suite.latest_capture_wins(env, bronze_tables["team"], "team").count() == 0


def test_mutant_team_grouped_stints_fail_ranges_and_containment(silver_tables):
    fp, g = silver_tables["fact_player_game"], silver_tables["dim_game"]
    obs = fp.join(g.select("game_id", "season_id", "game_date"), "game_id")
    wrong = obs.groupBy("player_id", "season_id", "team_id").agg(
        F.min("game_date").alias("valid_from"), F.max("game_date").alias("valid_to"))
    assert qc.mutually_exclusive_ranges(wrong, ["player_id"], "valid_from", "valid_to").count() > 0
    assert suite.stint_containment(fp, g, wrong).count() > 0


def test_mutant_dropped_game_fails_grain_sentry_not_uniqueness(bronze_tables, silver_tables):
    fp = silver_tables["fact_player_game"].where("game_id <> '0020300002'")
    assert qc.duplicate_keys(fp, ["game_id", "player_id"]).count() == 0
    v = qc.grain_sentry(fp, bronze_tables["player"], ["game_id", "player_id"], "fact", "bronze").collect()
    assert {r.violation for r in v} == {"missing_in_fact", "row_count_mismatch"}


def test_mutant_all_neutral_fails_two_teams(bronze_tables, silver_tables):
    g = silver_tables["dim_game"].withColumn("is_neutral_site", F.lit(True))
    kinds = {r.violation for r in suite.every_game_has_two_teams(bronze_tables["team"], g).collect()}
    assert "neutral_flag_wrong" in kinds and "neutral_not_zero_and_two" in kinds


def test_mutant_player_points_change_fails_reconcile(silver_tables):
    fp = silver_tables["fact_player_game"].withColumn(
        "pts", F.when(F.col("player_id") == 1000, F.col("pts") + 1).otherwise(F.col("pts")))
    bad = suite.points_reconcile(fp, silver_tables["fact_team_game"]).collect()
    assert bad and {r.measure for r in bad} == {"pts"}


def test_mutant_wrong_pin_fails_known_trades(spark, silver_tables, landing):
    seed = read_seed(spark, landing["seed"]).withColumn(
        "expected_team_id", F.when(F.col("expectation_kind") == "interpolated", F.lit(1)).otherwise(
            F.col("expected_team_id")))
    assert suite.known_trades_resolve(seed, silver_tables["dim_player_team_stint"]).count() == 2


def test_mutant_overtime_minutes(silver_tables):
    ft = silver_tables["fact_team_game"].withColumn("minutes_played", F.lit(250).cast("bigint"))
    assert suite.minutes_regulation_plus_overtime(ft).count() == ft.count()


# ---------------------------------------------------------------- floors
def test_floors_fire_on_empty_input(spark, env, bronze_tables, silver_tables):
    empty_b = bronze_tables["team"].limit(0)
    v = suite.latest_capture_wins(env.limit(0), empty_b, "team").collect()
    assert [r.violation for r in v] == ["floor_empty_model"]
    fl = qc.grain_sentry(silver_tables["fact_team_game"].limit(0), empty_b, ["game_id", "team_id"], "fact",
                         "bronze").collect()
    assert {r.violation for r in fl} == {"floor_empty_fact", "floor_empty_bronze"}
    assert suite.stints_not_degenerate(silver_tables["dim_player_team_stint"].limit(0)).count() == 1
    empty_seed = read_seed(spark, os.devnull)
    kinds = {r.kind for r in suite.known_trades_resolve(empty_seed, silver_tables["dim_player_team_stint"]).collect()}
    assert kinds == {"floor_no_pins", "floor_no_interpolated_pin"}
    assert suite.partition_keys_valid(env.limit(0)).count() == 1


def test_manifest_matches_payload_and_detects_tamper(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-tamper-")
    shutil.copytree(landing["root"], root, dirs_exist_ok=True)
    env = read_envelopes(spark, root, SOURCE, ENDPOINT)
    man = read_manifests(spark, root, SOURCE, ENDPOINT)
    dig = payload_digests(spark, root, SOURCE, ENDPOINT)
    clean = suite.manifest_matches_payload(man, dig, env).collect()
    # only the orphan payload (no manifest) shows up
    assert {r.capture for r in clean} == {"20260815T130000Z"}
    d = os.path.join(root, SOURCE, ENDPOINT, "season=2003-04", "grain=team", "season_type=regular",
                     "capture=20260815T120000Z")
    m = json.load(open(os.path.join(d, "manifest.json")))
    m["payload_sha256"] = hashlib.sha256(b"other").hexdigest()
    m["row_count"] = 3
    open(os.path.join(d, "manifest.json"), "w").write(json.dumps(m))
    man = read_manifests(spark, root, SOURCE, ENDPOINT)
    kinds = {(r.capture, r.violation) for r in suite.manifest_matches_payload(man, dig, env).collect()
             if r.grain == "team" and r.season == "2003-04"}
    assert kinds == {("20260815T120000Z", "sha256_mismatch"), ("20260815T120000Z", "row_count_mismatch")}


# ---------------------------------------------------------------- build gate
def test_build_publishes_when_green(spark, landing):
    wh = tempfile.mkdtemp(prefix="tierline-wh-")
    res = build_mod.build(spark, landing["root"], wh, seed_path=landing["seed"], corpus_season="2019")
    assert res.read(spark, "dim_player_team_stint").count() == 12 * 2 + 2 + 3
    assert res.read(spark, "bronze_team").count() == len(landing["teams"])
    assert res.read(spark, "player_season_context").where("pts_rank = 1").count() >= 2


def test_build_refuses_to_publish_red_layer(spark, landing):
    wh = tempfile.mkdtemp(prefix="tierline-wh-")
    bad_seed = os.path.join(tempfile.mkdtemp(), "seed.csv")
    with open(landing["seed"]) as f, open(bad_seed, "w") as g:
        g.write(f.read().replace(",interpolated,", ",observed,"))
    with pytest.raises(build_mod.PromotionError, match="known_trades_resolve"):
        build_mod.build(spark, landing["root"], wh, seed_path=bad_seed, corpus_season="2019")
    assert Layer(spark, f"{wh}/bronze").version() == 1
    # nothing is committed, and what was staged is gone
    silver = Layer(spark, f"{wh}/silver")
    assert silver.version() == 0 and silver.tables() == []
    assert not [f for _, _, names in os.walk(f"{wh}/silver") for f in names if f.endswith(".parquet")]


def test_gold_checks_redden_on_mutants(silver_tables):
    fact, games = silver_tables["fact_player_game"], silver_tables["dim_game"]
    ctx = player_season_context(fact, games)
    red = lambda c: {r.name for r in build_mod.run_checks(suite.gold_checks(c, fact, games)) if not r.passed}
    assert red(ctx) == set()
    assert red(ctx.limit(0)) == {"context.season_totals"}
    assert "context.unique" in red(ctx.unionByName(ctx.limit(1)))
    assert red(ctx.withColumn("pts", F.col("pts") + 1)) == {"context.season_totals"}
    assert red(ctx.withColumn("z_score", F.col("z_score") + 1)) == {"context.season_totals"}
    assert "context.not_null" in red(ctx.withColumn("games", F.lit(None).cast("long")))


def test_published_tables_are_documented(spark, landing):
    from tierline.plans.docs import MODEL_DOCS

    res = build_mod.build(spark, landing["root"], tempfile.mkdtemp(prefix="tierline-wh-"))
    assert set(res.tables) == set(MODEL_DOCS)
    for table in res.tables:
        schema = res.read(spark, table).schema
        assert {f.name for f in schema.fields if not f.metadata.get("comment")} == set(), table
        assert {f.metadata.get("table_comment") for f in schema.fields} == {MODEL_DOCS[table][""]}
        assert set(MODEL_DOCS[table]) - {""} == set(schema.names)


# ---------------------------------------------------------------- gold
def test_gold_season_context(silver_tables):
    ctx = player_season_context(silver_tables["fact_player_game"], silver_tables["dim_game"])
    rows = ctx.where("season_id = '22003'").orderBy("pts_rank").collect()
    assert rows[0].pts_rank == 1 and rows[0].pts >= rows[-1].pts
    assert abs(sum(r.z_score for r in rows)) < 1e-6
    eb = era_bounded(ctx, "season_id", "pts_per_100", "22019")
    assert eb.where("season_id = '22003' and pts_per_100 is not null").count() == 0


# ---------------------------------------------------------------- FIXTURES §7 edge cases
def _env_rows(spark, rows):
    from tierline.contracts import ENVELOPE

    return spark.createDataFrame(rows, ENVELOPE).withColumn("source_file", F.lit("mem"))


def _team_env(landing, season, capture, game_ids, season_text, edit=None):
    from tests.fixtures import envelope
    from tierline.contracts import TEAM_COLUMNS

    rows = [dict(r) for r in landing["teams"] if r["GAME_ID"] in game_ids]
    for r in rows:
        (edit or (lambda x: None))(r)
    return {**envelope(TEAM_COLUMNS, rows), "season": season_text, "grain": "team", "season_type": "regular",
            "capture": capture}


def test_duplicate_key_inside_one_capture_is_reported(spark, landing):
    env = _team_env(landing, "2003-04", "20260815T120000Z", ["0020300001"], "2003-04")
    env["resultSets"][0]["rowSet"] = env["resultSets"][0]["rowSet"] * 2
    df = _env_rows(spark, [env])
    assert suite.duplicate_key_in_capture(df, "team").count() == 2
    assert bronze(df, "team").count() == 2  # dedup hides it — which is why the check exists


def test_same_stamp_in_two_partitions_resolves_deterministically(spark, landing):
    def bump(r):
        r["PTS"] += 1

    a = _team_env(landing, "2003-04", "20260815T120000Z", ["0020300001"], "2003-04")
    b = _team_env(landing, "2003-04", "20260815T120000Z", ["0020300001"], "2019-20", bump)
    for order in ([a, b], [b, a]):
        got = {r.team_id: r.pts for r in bronze(_env_rows(spark, order), "team").collect()}
        exp = {r["TEAM_ID"]: r["PTS"] + 1 for r in landing["teams"] if r["GAME_ID"] == "0020300001"}
        assert got == exp  # the greater partition value wins the tie, whatever the file order


def test_measure_null_on_both_grains_is_reported(silver_tables):
    fp = silver_tables["fact_player_game"].withColumn(
        "blk", F.when(F.col("game_id") == "0020300001", F.lit(None).cast("bigint")).otherwise(F.col("blk")))
    ft = silver_tables["fact_team_game"].withColumn(
        "blk", F.when(F.col("game_id") == "0020300001", F.lit(None).cast("bigint")).otherwise(F.col("blk")))
    bad = suite.points_reconcile(fp, ft).collect()
    assert {(r.game_id, r.measure) for r in bad} == {("0020300001", "blk")} and len(bad) == 2


def test_renamed_header_in_landing_is_an_error(spark, landing):
    from tests.fixtures import envelope, write_capture
    from tierline.contracts import TEAM_COLUMNS

    root = tempfile.mkdtemp(prefix="tierline-rename-")
    rows = [r for r in landing["teams"] if r["GAME_ID"] == "0020300001"]
    renamed = tuple("PTS_TOTAL" if h == "PTS" else h for h in TEAM_COLUMNS)
    env = envelope(TEAM_COLUMNS, rows)
    env["resultSets"][0]["headers"] = list(renamed)
    write_capture(root, "2003-04", "team", "20260815T120000Z", env)
    e = landed_envelopes(spark, root)
    drift = suite.header_contract_drift(e, "team").collect()
    assert drift and drift[0].missing == ["PTS"] and drift[0].extra == ["PTS_TOTAL"]
    with pytest.raises(Exception, match="missing header PTS in capture"):
        bronze(e, "team").collect()
