"""Landing jobs: write-once append with audit rows, plan vs landed,
row maps, run metrics and capture diffs."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ENDPOINT, SOURCE, TEAM_COLUMNS, envelope
from tierline.contracts import ENVELOPE
from tierline.plans import landing as L
from tierline.plans.bronze import bronze, decoded, landed_envelopes
from tierline.operators.decode import envelope_parts


def _captures(spark, landing, season, capture, game_ids=None, season_text=None):
    rows = [r for r in landing["teams"] if (game_ids is None or r["GAME_ID"] in game_ids)
            and r["SEASON_ID"] == ("22003" if season == "2003-04" else "22019")]
    env = envelope(TEAM_COLUMNS, rows)
    rec = {**env, "season": season_text or season, "grain": " Team ", "season_type": "Regular", "capture": capture}
    return spark.createDataFrame([rec], ENVELOPE)


def test_land_captures_is_write_once_and_feeds_bronze(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-land-")
    a = L.land_captures(spark, _captures(spark, landing, "2003-04", "20260901T000000Z", season_text=" 2003-04 "),
                        root).collect()
    assert len(a) == 1 and a[0].grain == "team" and a[0].season_type == "regular" and a[0].row_count == 12
    assert len(a[0].payload_sha256s[0]) == 64
    again = L.land_captures(spark, _captures(spark, landing, "2003-04", "20260902T000000Z"), root).collect()
    assert again == []  # partition already complete, no recapture
    re = L.land_captures(spark, _captures(spark, landing, "2003-04", "20260903T000000Z", ["0020300001"]), root,
                         recapture=True).collect()
    assert [r.capture for r in re] == ["20260903T000000Z"]
    landed = L.landed_partitions(spark, root, SOURCE, ENDPOINT)
    assert landed.count() == 2
    ex = L.existing_captures(landed).first()
    assert (ex.n_captures, ex.latest_capture) == (2, "20260903T000000Z")
    b = bronze(landed_envelopes(spark, root), "team")
    assert b.count() == 12
    assert b.where("game_id = '0020300001'").select(F.max("captured_at")).first()[0].isoformat() == \
        "2026-09-03T00:00:00"


def test_plan_splits_landed_and_to_issue(spark, landing):
    root = landing["root"]
    landed = L.landed_partitions(spark, root, SOURCE, ENDPOINT)
    p = {(r.season, r.grain): r.status for r in
         L.plan(spark, landed, ["2003-04", "2019-20", "2024-25"], ["player", "team"]).collect()}
    assert p[("2003-04", "team")] == "landed" and p[("2024-25", "player")] == "to_issue"
    assert {r.status for r in L.plan(spark, landed, ["2003-04"], ["team"], recapture=True).collect()} == {"to_issue"}


def test_row_maps_and_duplicate_header(spark, landing):
    env = envelope_parts(landed_envelopes(spark, landing["root"], grain="team"))
    m = L.row_maps(env).first().row
    assert set(m) == set(TEAM_COLUMNS)
    dup = spark.createDataFrame([("f", ["A", "A"], [["1", "2"]])], "source_file string, headers array<string>, "
                                                                   "rows array<array<string>>")
    with pytest.raises(Exception):
        L.row_maps(dup).collect()


def test_run_metrics_from_run_manifest(spark):
    root = tempfile.mkdtemp(prefix="tierline-runs-")
    d = os.path.join(root, SOURCE, ENDPOINT, "_runs", "run=20260815T120000Z")
    os.makedirs(d)
    calls = [{"season": "2003-04", "grain": g, "season_type": "regular", "attempts": 1, "http_status": 200,
              "row_count": 10, "elapsed_seconds": 0.1, "capture": "20260815T120000Z", "written": g == "team",
              "issued_at": f"2026-08-15T12:00:0{i}"} for i, g in enumerate(["team", "player", "team"])]
    with open(os.path.join(d, "run_manifest.json"), "w") as f:
        f.write(json.dumps({"manifest_version": 1, "source": SOURCE, "endpoint": ENDPOINT,
                            "planned_calls": 3, "calls": calls}) + "\n")
    from tierline.sources.landing import read_run_manifests, run_calls

    m = L.run_metrics(run_calls(read_run_manifests(spark, root, SOURCE, ENDPOINT))).first()
    assert (m.calls_made, m.captures_written, m.captures_skipped, m.rows_landed) == (3, 2, 1, 30)
    assert m.max_spacing_seconds == 1.0


def test_capture_pair_diff_finds_restated_cell(spark, landing):
    rows = decoded(landed_envelopes(spark, landing["root"]), "team")
    d = L.capture_pair_diff(rows.where("game_id = '0020300003'"), ["game_id", "team_id"],
                            ["video_available", "pts"], "20260815T120000Z", "20260815T120030Z").collect()
    assert [(r.column_name, r.value_before, r.value_after) for r in d] == [("video_available", "0", "99")]


def test_superseded_captures_on_fixture(spark, landing):
    rows = decoded(landed_envelopes(spark, landing["root"]), "team")
    # add a capture whose only rows are beaten by the base capture's later restatement
    old = rows.where("capture = '20260815T120000Z' and game_id = '0020300003'").withColumn(
        "capture", F.lit("20260815T110000Z")).withColumn("captured_at", F.to_timestamp_ntz(F.lit("2026-08-15 11:00:00")))
    sup = L.superseded_captures(rows.unionByName(old), ["game_id", "team_id"], ["season", "grain", "capture"],
                                ["captured_at", "capture"]).collect()
    assert [(r.season, r.capture) for r in sup] == [("2003-04", "20260815T110000Z")]


def test_docs_metadata_survives_parquet(spark, landing):
    from tierline.plans.docs import MODEL_DOCS, document
    from tierline.plans.gold import publish_compact

    rows = decoded(landed_envelopes(spark, landing["root"]), "team").select("game_id", "team_id", "pts")
    out = tempfile.mkdtemp(prefix="tierline-docs-") + "/t"
    files = publish_compact(document(rows, {"game_id": MODEL_DOCS["dim_game"]["game_id"]}, "team rows"), out,
                            ["game_id"], rows_per_file=10)
    back = spark.read.parquet(out)
    assert back.schema["game_id"].metadata["comment"].startswith("10-digit")
    assert files == 3 and back.count() == rows.count()


def _files(root, capture):
    base = os.path.join(root, SOURCE, ENDPOINT)
    return sum(f.endswith(".json") for d, _, names in os.walk(base) for f in names if f"capture={capture}" in d)


def test_retry_after_a_crash_before_the_audit_lands_once(spark, landing, monkeypatch):
    root = tempfile.mkdtemp(prefix="tierline-retry-")
    cap = _captures(spark, landing, "2003-04", "20260901T000000Z")
    with monkeypatch.context() as m:
        m.setattr(L, "payload_digests", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            L.land_captures(spark, cap, root)
    assert _files(root, "20260901T000000Z") == 1 and L.landed_partitions(spark, root, SOURCE, ENDPOINT).count() == 0
    audit = L.land_captures(spark, cap, root).collect()
    assert _files(root, "20260901T000000Z") == 1
    assert [(r.row_count, len(r.payload_sha256s)) for r in audit] == [(12, 1)]


def test_one_capture_per_partition_and_batch(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-batch-")
    a, b = (_captures(spark, landing, "2003-04", f"2026090{i}T000000Z") for i in (1, 2))
    other = _captures(spark, landing, "2003-04", "20260901T000000Z", ["0020300001"])
    with pytest.raises(ValueError, match="two different payloads for capture 2003-04/team/regular/20260901T000000Z"):
        L.land_captures(spark, a.unionByName(other), root)
    assert [r.capture for r in L.land_captures(spark, b.unionByName(a).unionByName(a), root).collect()] == \
        ["20260901T000000Z"]
    assert _files(root, "20260901T000000Z") == 1 and _files(root, "20260902T000000Z") == 0
    assert [r.capture for r in L.land_captures(spark, b.unionByName(a), root, recapture=True).collect()] == \
        ["20260902T000000Z"]


def test_manifest_check_takes_spark_landed_captures(spark, landing):
    from tierline.quality.suite import manifest_matches_payload
    from tierline.sources.landing import payload_digests, read_envelopes, read_manifests

    root = tempfile.mkdtemp(prefix="tierline-audit-")
    L.land_captures(spark, _captures(spark, landing, "2003-04", "20260901T000000Z"), root)

    def found():
        return [r.violation for r in manifest_matches_payload(
            read_manifests(spark, root, SOURCE, ENDPOINT), payload_digests(spark, root, SOURCE, ENDPOINT),
            read_envelopes(spark, root, SOURCE, ENDPOINT), L.landing_audits(spark, root, SOURCE, ENDPOINT)).collect()]

    assert found() == []
    d = os.path.join(root, SOURCE, ENDPOINT, "season=2003-04", "grain=team", "season_type=regular",
                     "capture=20260901T000000Z")
    with open(os.path.join(d, "part-extra.json"), "w") as f:
        f.write("{}\n")
    assert sorted(found()) == ["bytes_mismatch", "sha256_mismatch"]
