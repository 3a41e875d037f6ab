"""Incremental bronze through Structured Streaming (availableNow)."""

import os
import shutil
import tempfile

from tests.fixtures import TEAM_COLUMNS, TEAMS, envelope, write_capture
from tierline.plans.bronze import bronze, decoded, landed_envelopes
from tierline.sinks.layers import Layer
from tierline.streaming.incremental import recent_captures, streaming_latest, upsert_bronze


def test_stream_upsert_matches_batch_and_applies_restatement(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-stream-")
    # the orphan payload has no manifest and a stream has no manifest gate: leave it out of this copy
    shutil.copytree(landing["root"], root, dirs_exist_ok=True,
                    ignore=lambda d, names: [n for n in names if n == "capture=20260815T130000Z" and "grain=team" in d])
    target = os.path.join(tempfile.mkdtemp(), "bronze")
    ckpt = os.path.join(tempfile.mkdtemp(), "ckpt")
    q = upsert_bronze(spark, root, target, ckpt, "team")
    q.awaitTermination()
    got = Layer(spark, target).read("bronze_team")
    batch = bronze(landed_envelopes(spark, root), "team")
    cols = sorted(batch.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))

    # a later restatement of one game: only that key changes, every other row survives
    rows = [r for r in landing["teams"] if r["GAME_ID"] == "0021900001"]
    re = [dict(r) for r in rows]
    for r in re:
        r["VIDEO_AVAILABLE"] = 7
    write_capture(root, "2019-20", "team", "20260901T000000Z", envelope(TEAM_COLUMNS, re))
    upsert_bronze(spark, root, target, ckpt, "team").awaitTermination()
    after = Layer(spark, target).read("bronze_team")
    assert after.count() == batch.count()
    changed = after.where("video_available = 7").select("game_id").distinct().collect()
    assert [r.game_id for r in changed] == ["0021900001"]
    assert after.where(f"team_id = {TEAMS[1][0]} and game_id = '0020300003'").first().video_available == 99


def test_streaming_latest_update_mode(spark, landing):
    src = spark.readStream.schema("k long, ts long, v string").json(tempfile.mkdtemp())
    latest = streaming_latest(src, ["k"], ["ts"])
    assert latest.isStreaming
    env = landed_envelopes(spark, landing["root"])
    rows = decoded(env, "team")
    batch_latest = streaming_latest(rows.drop("source_file"), ["game_id", "team_id"], ["captured_at"])
    assert batch_latest.count() == len(landing["teams"])


def test_recent_captures_window(spark, landing):
    env = landed_envelopes(spark, landing["root"])
    assert recent_captures(env, "20260816T000000Z", 2).count() == env.count()
    assert recent_captures(env, "20261001T000000Z", 2).count() == 0


def test_stream_one_file_per_batch_merges_across_batches(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-stream1-")
    shutil.copytree(landing["root"], root, dirs_exist_ok=True,
                    ignore=lambda d, names: [n for n in names if n == "capture=20260815T130000Z" and "grain=team" in d])
    target = os.path.join(tempfile.mkdtemp(), "bronze")
    ckpt = os.path.join(tempfile.mkdtemp(), "ckpt")
    upsert_bronze(spark, root, target, ckpt, "team", max_files_per_trigger=1).awaitTermination()
    got = Layer(spark, target).read("bronze_team")
    batch = bronze(landed_envelopes(spark, root), "team")
    cols = sorted(batch.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))
    assert got.where(f"team_id = {TEAMS[1][0]} and game_id = '0020300003'").first().video_available == 99


def _same(spark, target, root):
    batch = bronze(landed_envelopes(spark, root), "team")
    cols = sorted(batch.columns)
    got = Layer(spark, target).read("bronze_team").select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_merge_equals_refresh_when_a_game_changes_season(spark, landing):
    root = tempfile.mkdtemp(prefix="tierline-moved-")
    target = os.path.join(tempfile.mkdtemp(), "bronze")
    ckpt = os.path.join(tempfile.mkdtemp(), "ckpt")
    old = [r for r in landing["teams"] if r["SEASON_ID"] == "22003"]
    new = [r for r in landing["teams"] if r["SEASON_ID"] == "22019"]
    write_capture(root, "2003-04", "team", "20260901T000000Z", envelope(TEAM_COLUMNS, old))
    write_capture(root, "2019-20", "team", "20260901T000000Z", envelope(TEAM_COLUMNS, new))
    upsert_bronze(spark, root, target, ckpt, "team").awaitTermination()
    _same(spark, target, root)
    # every game of one season moves to a third one: the emptied season must not keep them
    moved = [{**r, "SEASON_ID": "22004"} for r in old]
    write_capture(root, "2004-05", "team", "20260902T000000Z", envelope(TEAM_COLUMNS, moved))
    upsert_bronze(spark, root, target, ckpt, "team").awaitTermination()
    _same(spark, target, root)
    assert {r.season_id for r in Layer(spark, target).read("bronze_team").select("season_id").collect()} == {"22004", "22019"}
    # one capture stamp, two folders: the tie falls as in a refresh, whichever comes first
    tied = [{**r, "VIDEO_AVAILABLE": 5} for r in new]
    write_capture(root, "2018-19", "team", "20260901T000000Z", envelope(TEAM_COLUMNS, tied))
    upsert_bronze(spark, root, target, ckpt, "team").awaitTermination()
    _same(spark, target, root)


def test_merge_into_a_published_build_keeps_other_seasons(spark, landing):
    from tierline.plans.build import build

    root = tempfile.mkdtemp(prefix="tierline-built-")
    shutil.copytree(landing["root"], root, dirs_exist_ok=True,
                    ignore=lambda d, names: [n for n in names if n == "capture=20260815T130000Z" and "grain=team" in d])
    target = build(spark, root, tempfile.mkdtemp()).tables["bronze_team"]
    re = [{**r, "VIDEO_AVAILABLE": 7} for r in landing["teams"] if r["SEASON_ID"] == "22003"]
    write_capture(root, "2003-04", "team", "20260901T000000Z", envelope(TEAM_COLUMNS, re))
    upsert_bronze(spark, root, target, os.path.join(tempfile.mkdtemp(), "c"), "team").awaitTermination()
    _same(spark, target, root)
