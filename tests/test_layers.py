"""Published layers: readers see whole versions whatever a writer does,
merges equal refreshes, and refreshes follow the delta."""

import os
import random
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.fixtures import TEAM_COLUMNS, PLAYER_COLUMNS, envelope, write_capture
from tierline.operators.latest import latest_per_key
from tierline.plans import build as B
from tierline.plans.bronze import landed_envelopes
from tierline.plans.refresh import refresh
from tierline.sinks import layers, storage
from tierline.sinks.layers import Layer, TableSpec
from tierline.streaming.incremental import merge_into_bronze

SPEC = TableSpec(["k"], ["part"], "k div 100", rows_per_file=40)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, sub int, part string, v long")


def rows_of(df):
    return sorted((tuple(r) for r in df.select("k", "sub", "part", "v").collect()), key=str)


def start(spark, path, n=400):
    layer = Layer(spark, path)
    change = layer.begin()
    change.put("t", frame(spark, [(i, 0, f"p{i % 3}", 0) for i in range(n)]).repartition(4), SPEC)
    change.put("u", frame(spark, [(i, 0, "x/y=z", 0) for i in range(5)]), TableSpec(["k"], ["part"]))
    change.commit()
    return layer


def test_versions_and_empty_layer(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    assert layer.version() == 0 and layer.tables() == [] and layer.note("x") is None
    layer = start(spark, str(tmp_path))
    assert layer.version() == 1 and layer.tables() == ["t", "u"]
    assert rows_of(layer.read("t")) == sorted([(i, 0, f"p{i % 3}", 0) for i in range(400)], key=str)
    assert rows_of(layer.read("u")) == [(i, 0, "x/y=z", 0) for i in range(5)]
    change = layer.begin()
    change.put("t", frame(spark, []), SPEC)
    assert change.commit(why="emptied") == 2
    assert layer.read("t").count() == 0 and layer.read("t", 1).count() == 400 and layer.read("u").count() == 5
    assert layer.note("why") == "emptied"
    change = layer.begin()
    assert change.merge("t", frame(spark, [(1, 0, "a", 1)]), ["k", "sub"], ["v"]).files == 0
    change.commit()
    assert rows_of(layer.read("t")) == [(1, 0, "a", 1)]
    with pytest.raises(ValueError, match="no version"):
        layer.read("t", 9)


def test_a_second_writer_of_one_version_fails(spark, tmp_path):
    layer = start(spark, str(tmp_path))
    one, two = layer.begin(), layer.begin()
    one.put("u", frame(spark, [(1, 1, "a", 1)]), TableSpec(["k"]))
    two.put("u", frame(spark, [(2, 2, "b", 2)]), TableSpec(["k"]))
    one.commit()
    with pytest.raises(Exception, match="already exists"):
        two.commit()
    assert rows_of(layer.read("u")) == [(1, 1, "a", 1)]


@pytest.mark.parametrize("seed", range(2))
def test_merge_equals_latest_over_all(spark, tmp_path, seed):
    rng = random.Random(seed)
    layer = start(spark, str(tmp_path))
    everything = [(i, 0, f"p{i % 3}", 0) for i in range(400)]
    for v in range(1, 4):
        keys = [rng.randrange(rng.choice([20, 200, 900])) for _ in range(rng.choice([1, 7, 60]))] + [None]
        new = list({(k, s): (k, s, rng.choice(["p0", "p9", None]), v) for k in keys for s in range(rng.randrange(1, 3))}.values())
        everything += new
        change = layer.begin()
        report = change.merge("t", frame(spark, new).checkpoint(), ["k", "sub"], ["v"])
        change.commit()
        layer.retire()
        want = latest_per_key(frame(spark, everything), ["k", "sub"], ["v"])
        assert rows_of(layer.read("t")) == rows_of(want)
        assert report.files == report.files_read + report.files_kept


def test_merge_reads_few_files(spark, tmp_path):
    layer = Layer(spark, str(tmp_path))
    change = layer.begin()
    change.put("t", spark.range(20_000).select((F.col("id") * 3).alias("k"), F.lit(0).alias("sub"), F.lit("a").alias("part"), F.lit(0).cast("long").alias("v"))
               .repartition(4), TableSpec(["k"], cell="k div 1000", rows_per_file=500))
    change.commit()
    # the 30 keys lie in one file's range, and none of the others' bitmaps can be asked for them
    change = layer.begin()
    report = change.merge("t", frame(spark, [(600 + 3 * i, 0, "a", 1) for i in range(30)]), ["k", "sub"], ["v"])
    assert report.files >= 40 and report.files_read <= 2
    # keys inside files' ranges that no file holds: bitmaps keep nearly all files out
    report = change.merge("t", frame(spark, [(3 * i * 1000 + 1, 0, "a", 1) for i in range(20)]), ["k", "sub"], ["v"])
    assert report.files_read <= 6
    change.commit()
    assert layer.read("t").count() == 20_020


def test_bitmaps_miss_no_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("f"), F.col("id") % 3).alias("path"), (F.col("id") * 7919 % 100_003).alias("k"))
    summary = layers.key_summary(keys, TableSpec(["k"], cell="k % 2"))
    assert summary.count() >= 6 and summary.where("lo > hi").count() == 0
    seg, at = layers._probes(["k"], F.col("segments"))
    got = (keys.withColumn("cell", (F.col("k") % 2).cast("string")).join(summary, ["path", "cell"])
           .where(seg == F.col("segment")).withColumn("a0", at[0]).withColumn("a1", at[1]))
    assert got.where(layers._bit("bits", "a0") & layers._bit("bits", "a1")).count() == 5000


class Killed(Exception):
    pass


def crash_points(monkeypatch, at):
    """Raise at the ``at``-th step of a writer: before and after every write
    of files, and inside commit and retire."""
    seen = [0]

    def step(name):
        seen[0] += 1
        if seen[0] == at:
            raise Killed(name)

    def around(owner, name):
        real = getattr(owner, name)

        def wrapped(*a, **k):
            step(f"before {name}")
            out = real(*a, **k)
            step(f"after {name}")
            return out

        monkeypatch.setattr(owner, name, wrapped)

    around(layers.Change, "_write")
    around(layers.Change, "_list")
    around(layers, "key_summary")
    around(storage, "rename")
    around(storage, "delete")
    return seen


def test_a_kill_at_any_step_leaves_a_whole_version(spark, tmp_path):
    source = str(tmp_path / "source")
    start(spark, source, 12)
    new = frame(spark, [(i, 0, "p0", 1) for i in (1, 7, 900)]).checkpoint()
    before = rows_of(Layer(spark, source).read("t"))
    after = rows_of(latest_per_key(Layer(spark, source).read("t").unionByName(new), ["k", "sub"], ["v"]))

    def write(layer):
        change = layer.begin()
        change.merge("t", new, ["k", "sub"], ["v"])
        change.put("u", frame(spark, [(7, 7, "b", 7)]), TableSpec(["k"]))
        change.commit()
        layer.retire(keep=1)

    at, outcomes = 0, []
    while True:
        at += 1
        path = str(tmp_path / f"run{at}")
        shutil.copytree(source, path)
        layer = Layer(spark, path)
        with pytest.MonkeyPatch.context() as m:
            crash_points(m, at)
            try:
                write(layer)
                killed = False
            except Killed:
                killed = True
        got = rows_of(layer.read("t")), rows_of(layer.read("u"))
        assert got in [(before, [(i, 0, "x/y=z", 0) for i in range(5)]), (after, [(7, 7, "b", 7)])], at
        outcomes.append(got[0] == after)
        if at % 8 == 0 or not killed:
            # the writer's next attempt succeeds and clears what the dead one left
            write(layer)
            assert rows_of(layer.read("t")) == after and rows_of(layer.read("u")) == [(7, 7, "b", 7)]
            live = {e["files"] for e in layer.pointer()["tables"].values()}
            assert {f"_files/{n}" for n in storage.names(spark, f"{path}/_files")} == live
        if not killed:
            break
    assert at > 12 and outcomes == sorted(outcomes) and not outcomes[0] and outcomes[-1]


# ---------------------------------------------------------------- refresh
SILVER = ["fact_player_game", "fact_team_game", "dim_game", "dim_team", "dim_player", "dim_player_team_stint", "player_history", "team_history"]


def values(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


def restate(root, landing, rng, k):
    """One capture per grain that restates some games: values, names, teams
    of players, dates of games."""
    stamp = f"202609{k + 10:02d}T000000Z"
    games = rng.sample(sorted({r["GAME_ID"] for r in landing["teams"] if r["SEASON_ID"] == "22003"}), 2)
    shift = rng.choice([0, 0, 1])
    team = [dict(r) for r in landing["teams"] if r["GAME_ID"] in games]
    player = [dict(r) for r in landing["players"] if r["GAME_ID"] in games]
    for r in team + player:
        if shift and r["GAME_ID"] == games[0]:
            r["GAME_DATE"] = r["GAME_DATE"][:-2] + f"{int(r['GAME_DATE'][-2:]) + shift:02d}"
    for r in rng.sample(player, 3):
        r["PLAYER_NAME"] = f"Renamed {k}"
    for r in rng.sample(team, 1):
        r["TEAM_NAME"] = f"Renamed team {k}"
    if k % 2:
        write_capture(root, "2003-04", "player", stamp, envelope(PLAYER_COLUMNS, player))
    write_capture(root, "2003-04", "team", stamp, envelope(TEAM_COLUMNS, team))
    return stamp


def test_refresh_equals_build_after_restatements(spark, landing, monkeypatch):
    monkeypatch.setattr("tierline.plans.refresh.silver_checks", lambda *a, **k: [])  # moved dates break checks on purpose here
    root, wh = tempfile.mkdtemp(prefix="tierline-delta-"), tempfile.mkdtemp(prefix="tierline-wh-")
    shutil.copytree(landing["root"], root, dirs_exist_ok=True)
    B.build(spark, root, wh)
    rng = random.Random(4)
    for k in range(2):
        stamp = restate(root, landing, rng, k)
        env = landed_envelopes(spark, root).where(F.col("capture") == stamp)
        for grain in ("player", "team"):
            merge_into_bronze(spark, env.where(F.col("grain") == grain), f"{wh}/bronze", grain)
        report = refresh(spark, wh)
        assert not report.full and report.changed["bronze_team"] > 0
        bronze = Layer(spark, f"{wh}/bronze")
        want = B.silver_tables(bronze.read("bronze_player"), bronze.read("bronze_team"))
        silver = Layer(spark, f"{wh}/silver")
        for t in SILVER:
            assert values(silver.read(t)) == values(want[t]), (k, t)
        from tierline.plans.gold import player_season_context

        gold = Layer(spark, f"{wh}/gold").read("player_season_context")
        assert values(gold) == values(player_season_context(want["fact_player_game"], want["dim_game"]))
    assert refresh(spark, wh).changed == {}  # nothing new


def test_merge_takes_the_keys_of_its_rows_once(spark):
    layer = Layer(spark, os.path.join(tempfile.mkdtemp(), "layer"))
    change = layer.begin()
    change.put("t", spark.range(100).selectExpr("id as k", "0 as v"), TableSpec(["k"]))
    change.commit()
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(50, 150).selectExpr("id as k", "1 as v").mapInArrow(seen, "k long, v int")
    change = layer.begin()
    change.merge("t", rows, ["k"], ["v"])
    change.commit()
    assert read.value == 200  # for the keys, and with the old rows
    assert {r.k: r.v for r in layer.read("t").collect()} == {k: int(k >= 50) for k in range(150)}


def test_refresh_gate_keeps_the_published_version(spark, landing):
    root, wh = tempfile.mkdtemp(prefix="tierline-delta-"), tempfile.mkdtemp(prefix="tierline-wh-")
    shutil.copytree(landing["root"], root, dirs_exist_ok=True)
    B.build(spark, root, wh)
    team = [dict(r) for r in landing["teams"] if r["GAME_ID"] == "0020300001"]
    team[0]["PTS"] += 1
    write_capture(root, "2003-04", "team", "20260915T000000Z", envelope(TEAM_COLUMNS, team))
    env = landed_envelopes(spark, root, grain="team").where("capture = '20260915T000000Z'")
    merge_into_bronze(spark, env, f"{wh}/bronze", "team")
    before = Layer(spark, f"{wh}/silver").version()
    with pytest.raises(B.PromotionError, match="points_reconcile"):
        refresh(spark, wh)
    assert Layer(spark, f"{wh}/silver").version() == before
    # the correction arrives: the refresh goes through, from the version it was made from or anew
    team[0]["PTS"] -= 1
    write_capture(root, "2003-04", "team", "20260916T000000Z", envelope(TEAM_COLUMNS, team))
    env = landed_envelopes(spark, root, grain="team").where("capture = '20260916T000000Z'")
    merge_into_bronze(spark, env, f"{wh}/bronze", "team")
    assert refresh(spark, wh).result.versions["silver"] == before + 1


def test_replayed_batch_is_left_out(spark, landing):
    path = os.path.join(tempfile.mkdtemp(), "bronze")
    env = landed_envelopes(spark, landing["root"], grain="team")
    merge_into_bronze(spark, env, path, "team", stream="s", epoch=0)
    version = Layer(spark, path).version()
    merge_into_bronze(spark, env, path, "team", stream="s", epoch=0)
    assert Layer(spark, path).version() == version
