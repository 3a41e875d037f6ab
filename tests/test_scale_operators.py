"""Operators that split hot groups and long intervals, against plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators.asof import asof_join, dyadic_pieces
from tierline.operators.rank import distributed_rank
from tierline.operators.stints import segmented_stints, stints
from tierline.operators.versions import changed_buckets, version_diff
from tierline.plans import landing as L

DAY = dt.date(1960, 1, 1)


def test_dyadic_pieces_cover_each_day_once(spark):
    rng = random.Random(1)
    spans = [(0, 0), (-1, 0), (-7, -7), (3, 66), (-65, 64), (0, 4095), (1, 4094)] + [(a := rng.randrange(-5000, 5000), a + rng.choice([0, 1, 5, 90, 4000]))
                                                                                   for _ in range(60)]
    top = 7
    df = spark.createDataFrame(spans, "lo long, hi long").select("lo", "hi", dyadic_pieces("lo", "hi", top).alias("p"))
    for r in df.collect():
        days = [d for p in r.p for d in range(p.block * 4 ** p.level, (p.block + 1) * 4 ** p.level)]
        assert sorted(days) == list(range(r.lo, r.hi + 1))
        assert len(r.p) <= 6 * (top + 1)
    far = spark.range(1).select(dyadic_pieces("10000", "2932896", 11).alias("p")).first().p  # to 9999-12-31
    assert len(far) <= 66 and sum(4 ** p.level for p in far) == 2932896 - 10000 + 1


@pytest.mark.parametrize("how", ["left", "inner"])
def test_dyadic_asof_matches_a_range_join(spark, how):
    rng = random.Random(2)
    day = lambda n: DAY + dt.timedelta(days=n)
    iv = [(rng.randrange(8) if rng.random() < 0.9 else None, day(a := rng.randrange(9000)), rng.choice([day(a + rng.randrange(-3, 400)), dt.date(9999, 12, 31)]), i)
          for i in range(120)]
    # one entity holds a third of the left rows; rows repeat; some have no key or day
    left = [(rng.randrange(10) if i % 3 else 1, day(rng.randrange(9500)), i % 50) for i in range(600)] + [(None, DAY, 1), (2, None, 1)]
    left = spark.createDataFrame(left + left[:40], "k long, d date, valid_from int")
    iv = spark.createDataFrame(iv, "k long, lo date, hi date, v long")
    got = asof_join(left, iv, ["k"], "d", "lo", "hi", how, bucket="dyadic")
    want = asof_join(left, iv, ["k"], "d", "lo", "hi", how, bucket=None)
    rows = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert got.columns == want.columns and rows(got) == rows(want)
    assert asof_join(left.limit(0), iv, ["k"], "d", "lo", "hi", bucket="dyadic").count() == 0
    assert asof_join(left, iv.limit(0), ["k"], "d", "lo", "hi", bucket="dyadic").count() == left.count()


def test_dyadic_asof_keeps_the_pieces_out_of_the_driver(spark):
    far, day = dt.date(9999, 12, 31), lambda n: DAY + dt.timedelta(days=n)
    iv = spark.createDataFrame([(k, day(1 + 40 * i), day(40 * i + 40) if i < 9 else far, 10 * k + i) for k in range(3) for i in range(10)],
                               "k int, lo date, hi date, v int")
    left = spark.createDataFrame([(k, day(n)) for k in range(3) for n in range(0, 500, 7)], "k int, d date")
    got = asof_join(left, iv, ["k"], "d", "lo", "hi", bucket="dyadic")
    plan = got._jdf.queryExecution().executedPlan().toString()
    pieces = plan[:plan.index("Generate")]
    assert "SortMergeJoin" in pieces.splitlines()[max(i for i, ln in enumerate(pieces.splitlines()) if "Join" in ln)]
    want = {(k, day(n)): (10 * k + min((n - 1) // 40, 9) if n else None) for k in range(3) for n in range(0, 500, 7)}
    assert {(r.k, r.d): r.v for r in got.collect()} == want


def test_dyadic_asof_with_times(spark):
    left = spark.sql("select 1 as k, timestamp_ntz'2024-03-05 09:00' as t union all select 1, timestamp_ntz'2024-03-05 11:00'")
    iv = spark.sql("select 1 as k, timestamp_ntz'2024-03-05 10:00' as lo, timestamp_ntz'9999-01-01 00:00' as hi, 'x' as v")
    got = {str(r.t): r.v for r in asof_join(left, iv, ["k"], "t", "lo", "hi", bucket="dyadic").collect()}
    assert got == {"2024-03-05 09:00:00": None, "2024-03-05 11:00:00": "x"}


def test_distributed_rank_equals_windows(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(1500)] + [("one", 5, -1)]
    df = spark.createDataFrame(rows, "g string, x long, id long").repartition(6)
    w, g = Window.partitionBy("g").orderBy(F.col("x").desc()), Window.partitionBy("g")
    want = df.select("id", F.rank().over(w).alias("r"), F.round(F.percent_rank().over(w), 12).alias("p"), F.round(F.avg("x").over(g), 9).alias("a"),
                     F.round(F.try_divide(F.col("x") - F.avg("x").over(g), F.stddev_pop("x").over(g)), 9).alias("z"))
    got = distributed_rank(df, "g", "x").select("id", F.col("x_rank").alias("r"), F.round("x_pct_rank", 12).alias("p"), F.round("group_avg", 9).alias("a"),
                                                F.round("z_score", 9).alias("z"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert distributed_rank(df.limit(0), "g", "x").count() == 0


def test_distributed_rank_splits_a_hot_group(spark):
    df = spark.range(20_000).select(F.lit("s").alias("g"), (F.col("id") % 5000).alias("x"))
    plan = distributed_rank(df, "g", "x")
    ranged = df.repartitionByRange(8, "g", F.col("x").desc()).select(F.spark_partition_id().alias("p")).groupBy("p").count()
    assert ranged.count() == 8 and plan.agg(F.max("x_rank")).first()[0] == 19_997


@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_segmented_stints_equal_windows(spark, bucket):
    rng = random.Random(4)
    rows, last = [], {}
    for i in range(1200):
        e = 1 if i % 3 == 0 else rng.randrange(2, 12)
        d = rng.randrange(900)
        v = last.get(e, "a") if rng.random() < 0.7 else rng.choice(["a", "b", "c", None])
        last[e] = v
        rows.append((e, v, 2000 + d // 365, DAY + dt.timedelta(days=d), i))
    obs = spark.createDataFrame(rows, "e long, v string, y int, d date, n long").dropDuplicates(["e", "d"])
    args = dict(entity="e", value="v", period="y", at="d", tiebreak=["n"])
    a, b = stints(obs, **args), segmented_stints(obs, bucket=bucket, **args)
    assert a.columns == b.columns and a.count() > 100
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_segmented_stints_split_the_hot_entity(spark):
    obs = spark.range(3000).select(F.lit(1).alias("e"), (F.col("id") % 7 < 4).cast("string").alias("v"), F.lit(1).alias("y"),
                                   F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"))
    plan = segmented_stints(obs, "e", "v", "y", "d")._jdf.queryExecution().optimizedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    rows = [ln for ln in windows if "row_number" in ln or "__prior" in ln]
    assert rows and all("__bucket" in ln.split("windowspecdefinition(")[1] for ln in rows)


def test_version_diff_finds_exactly_the_changed_cells(spark):
    rng = random.Random(5)
    old = {(i, i % 3 or None): [rng.choice(["x", "y", None]), rng.randrange(3)] for i in range(800)}
    new = {k: list(v) for k, v in old.items()}
    for k in rng.sample(sorted(new, key=str), 12):
        new[k][rng.randrange(2)] = rng.choice([None, 9])
    gone, come = rng.sample(sorted(old, key=str), 2), [(5000, None), (5001, 1)]
    for k in gone:
        new.pop(k, None)
    for k in come:
        new[k] = ["z", None]
    frame = lambda t: spark.createDataFrame([(*k, *v) for k, v in t.items()], "a long, b int, v string, n int")
    text = lambda v: None if v is None else str(v)
    want = sorted((str((*k, c, text(old.get(k, [None] * 2)[i]), text(new.get(k, [None] * 2)[i]))) for k in {*old, *new} for i, c in enumerate(("v", "n"))
                   if old.get(k, [None] * 2)[i] != new.get(k, [None] * 2)[i]))
    before, after = frame(old).repartition(3), frame(new)
    for buckets in (1, 64, 4096):
        assert sorted(str(tuple(r)) for r in version_diff(before, after, ["a", "b"], ["v", "n"], buckets).collect()) == want
    assert changed_buckets(before, after, ["a", "b"], ["v", "n"], 4096).count() <= 16
    assert version_diff(before, before, ["a", "b"], ["v", "n"]).count() == 0
    # a value that moves from one null cell to another is a change
    a, b = spark.createDataFrame([(1, "1", None)], "k int, p string, q string"), spark.createDataFrame([(1, None, "1")], "k int, p string, q string")
    assert version_diff(a, b, ["k"], ["p", "q"]).count() == 2


def test_version_diff_deals_sides_laid_out_by_key_no_further(spark):
    from tierline.operators.latest import latest_per_key

    rows = spark.createDataFrame([(None if i == 7 else i % 40, i % 4, i) for i in range(200)], "k int, v int, at int")
    diff = version_diff(latest_per_key(rows, ["k"], [("at", False)]), latest_per_key(rows, ["k"], ["at"]), ["k"], ["v", "at"])
    assert "SortMergeJoin [__b_k" in diff._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.value_before, r.value_after) for r in diff.where("column_name = 'at'").collect()} == {
        (k, str(k + 40 * (k == 7)), str(k + 160)) for k in range(40)}


def test_plan_arguments_are_checked(spark):
    landed = spark.createDataFrame([], "season string, grain string, season_type string, capture string")
    for bad in (dict(seasons=[], grains=["team"]), dict(seasons=["2003"], grains=["team"]), dict(seasons=["2003-04", "2003-04"], grains=["team"]),
                dict(seasons="2003-04", grains=["team"]), dict(seasons=["2003-04"], grains=["league"]),
                dict(seasons=["2003-04"], grains=["team"], season_types=["summer"])):
        with pytest.raises(ValueError):
            L.plan(spark, landed, **bad)
    assert L.plan(spark, landed, ["2003-04"], ["team"], ["regular", "playoffs"]).count() == 2


def test_ordered_captures_and_padded_pairs(spark):
    landed = spark.createDataFrame([("s", "team", "regular", c) for c in ("20260902T000000Z", "20260901T000000Z", "20260902T000000Z")],
                                   "season string, grain string, season_type string, capture string")
    assert [r.captures for r in L.ordered_captures(landed).collect()] == ["20260901T000000Z,20260902T000000Z"]
    df = spark.createDataFrame([(["A", "B", "C"], ["1"]), (["A"], ["1", "2"]), ([], [])], "h array<string>, c array<string>")
    got = [[tuple(p) for p in r[0]] for r in df.select(L.padded_pairs(F.col("h"), F.col("c"))).collect()]
    assert got == [[("A", "1"), ("B", None), ("C", None)], [("A", "1"), (None, "2")], []]
