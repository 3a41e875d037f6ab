"""Operators against brute-force references on the driver tables (sf0.001)
and on small hand-made frames."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierline.operators.asof import asof_join
from tierline.operators.edits import apply_cell_edit, capture_diff, upsert
from tierline.operators.gaps import consecutive_gaps
from tierline.operators.latest import latest_per_key
from tierline.operators.pairs import collapse_pair, pair_violations
from tierline.operators.reconcile import child_sums, reconcile
from tierline.operators.reshape import unpivot
from tierline.operators.sampling import first_groups, keep_groups
from tierline.operators.stints import stints

SF = "/root/testdata/sf0.001"


def _rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_per_key_methods_agree(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    a = latest_per_key(li, keys, order, method="aggregate")
    w = latest_per_key(li, keys, order, method="window")
    assert _rows(a) == _rows(w)
    assert a.count() == li.select(*keys).distinct().count()


def test_latest_per_key_breaks_ties_the_same_way_in_every_form(spark):
    from tierline.streaming.incremental import streaming_latest

    df = spark.createDataFrame([(1, 5, "b", 1), (1, 5, "a", 9), (2, 1, "z", 0), (3, 1, None, 7), (3, 1, "c", 2)],
                               "k long, ts long, v string, n long")
    forms = [latest_per_key(df, ["k"], ["ts"], method="aggregate"), latest_per_key(df, ["k"], ["ts"], method="window"),
             streaming_latest(df, ["k"], ["ts"])]
    for f in forms:
        assert _rows(f, ["k", "ts", "v", "n"]) == [(1, 5, "b", 1), (2, 1, "z", 0), (3, 1, "c", 2)]


def _brute_asof(left: pd.DataFrame, iv: pd.DataFrame):
    out = []
    for r in left.itertuples(index=False):
        hits = iv[(iv.k == r.k) & (iv.lo <= r.d) & (iv.hi >= r.d)]
        out += [(r.k, r.d, h.v) for h in hits.itertuples(index=False)] or [(r.k, r.d, None)]
    return sorted(out, key=lambda t: (t[0], t[1], t[2] or ""))


@pytest.mark.parametrize("bucket", [None, "week", "month", "year"])
def test_asof_join_matches_brute_force(spark, bucket):
    rnd = random.Random(7)
    base = pd.Timestamp("2024-01-01")
    ivs, lefts = [], []
    for k in range(6):
        start = rnd.randint(0, 40)
        for j in range(5):
            length = rnd.choice([0, 0, 3, 20, 70])
            lo = base + pd.Timedelta(days=start)
            hi = lo + pd.Timedelta(days=length)
            ivs.append((k, lo.date(), hi.date(), f"v{k}{j}"))
            start += length + rnd.choice([1, 2, 5])
        for _ in range(25):
            lefts.append((k, (base + pd.Timedelta(days=rnd.randint(0, 200))).date()))
    ivp = pd.DataFrame(ivs, columns=["k", "lo", "hi", "v"])
    lp = pd.DataFrame(lefts, columns=["k", "d"])
    iv = spark.createDataFrame(ivp)
    lf = spark.createDataFrame(lp)
    got = asof_join(lf, iv, on=["k"], at="d", lower="lo", upper="hi", bucket=bucket)
    res = sorted([(r.k, r.d, r.v) for r in got.collect()], key=lambda t: (t[0], t[1], t[2] or ""))
    assert res == _brute_asof(lp, ivp)


@pytest.mark.parametrize("split", ["minute", "hour", "range"])
def test_consecutive_gaps_match_brute_force(spark, split):
    ev = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("date").alias("day"), "ts")
    got = {r.day: (r.n_rows, r.max_gap_us) for r in consecutive_gaps(ev, ["day"], "ts", split=split,
                                                                       partitions=7).collect()}
    pdf = ev.toPandas().sort_values("ts")
    exp = {}
    for day, g in pdf.groupby("day"):
        us = g.ts.astype("int64") // 1000
        gaps = us.diff().dropna()
        exp[day] = (len(g), int(gaps.max()) if len(gaps) else None)
    assert got == exp


def test_consecutive_gaps_range_split_handles_a_hot_group(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    hot = ev.select(F.when(F.col("user_id") < 5, F.lit(-1)).otherwise(F.col("user_id")).alias("g"), "ts")
    got = {r.g: (r.n_rows, r.max_gap_us) for r in consecutive_gaps(hot, ["g"], "ts", split="range",
                                                                     partitions=16).collect()}
    pdf = hot.toPandas().sort_values("ts")
    exp = {}
    for g, grp in pdf.groupby("g"):
        us = grp.ts.astype("int64") // 1000
        gaps = us.diff().dropna()
        exp[g] = (len(grp), int(gaps.max()) if len(gaps) else None)
    assert got == exp


def test_stints_a_b_a_and_gap_rule(spark):
    d = pd.to_datetime
    obs = pd.DataFrame({
        "e": [1, 1, 1, 1, 2], "v": ["A", "A", "B", "A", "X"], "p": ["s", "s", "s", "s", "s"],
        "at": [d("2024-01-01"), d("2024-01-03"), d("2024-01-07"), d("2024-01-09"), d("2024-01-02")],
    })
    obs["at"] = obs["at"].dt.date
    st = stints(spark.createDataFrame(obs), "e", "v", "p", "at").orderBy("e", "valid_from").collect()
    got = [(r.e, r.v, str(r.valid_from), str(r.valid_to), r.is_current) for r in st]
    assert got == [(1, "A", "2024-01-01", "2024-01-06", False), (1, "B", "2024-01-07", "2024-01-08", False),
                   (1, "A", "2024-01-09", "2024-01-09", True), (2, "X", "2024-01-02", "2024-01-02", True)]


def test_pair_collapse_and_violations(spark):
    df = spark.createDataFrame([(1, "H", 10), (1, "A", 11), (2, "A", 20), (2, "A", 21), (3, "H", 30), (3, "H", 31),
                                (4, "H", 40), (4, "A", 40)], "g long, side string, id long")
    h, a = F.col("side") == "H", F.col("side") == "A"
    c = {r.g: r for r in collapse_pair(df, ["g"], h, a, "id", "h", "a").collect()}
    assert (c[1].h_id, c[1].a_id) == (10, 11) and c[2].is_neutral and c[3].h_id is None
    v = {(r.g, r.violation) for r in pair_violations(df, collapse_pair(df, ["g"], h, a, "id", "h", "a"),
                                                     ["g"], h, a, "id", "h", "a").collect()}
    assert v == {(3, "sided_not_one_and_one"), (3, "ids_null_iff_neutral"), (4, "same_id_both_sides")}


def test_reconcile_detects_child_change_and_missing_parent(spark):
    child = spark.createDataFrame([(1, 2), (1, 3), (2, 5), (3, 1)], "k long, x long")
    parent = spark.createDataFrame([(1, 5), (2, 6), (4, 0)], "k long, x long")
    res = {(r.k, r.parent_value, r.child_value) for r in reconcile(parent, child, ["k"], ["x"]).where("violates")
           .collect()}
    assert res == {(2, 6, 5), (3, None, 1), (4, 0, None)}
    assert child_sums(child, ["k"], ["x"]).count() == 3


def test_unpivot_null_policy(spark):
    df = spark.createDataFrame([(1, None, 2)], "k long, a long, b long")
    assert unpivot(df, ["k"], ["a", "b"]).count() == 2
    assert unpivot(df, ["k"], ["a", "b"], keep_nulls=False).count() == 1


def test_whole_group_sample_keeps_every_row(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    chosen = first_groups(li, "l_orderkey", ["l_shipdate"], 10)
    kept = keep_groups({"lineitem": (li, "l_orderkey"), "orders": (orders, "o_orderkey")}, chosen, "l_orderkey")
    keys = {r.l_orderkey for r in chosen.collect()}
    assert len(keys) == 10
    assert kept["lineitem"].count() == li.where(F.col("l_orderkey").isin(*keys)).count()
    assert kept["orders"].count() == 10
    missing = spark.createDataFrame([(10**12,)], "l_orderkey long")
    bad = keep_groups({"orders": (orders, "o_orderkey")}, missing, "l_orderkey")
    with pytest.raises(Exception, match="chosen group absent"):
        bad["orders"].collect()


def test_sampling_guards(spark):
    from tierline.operators.sampling import groups_where

    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    with pytest.raises(Exception, match="fewer than"):
        first_groups(li, "l_orderkey", ["l_shipdate"], 10**7).collect()
    assert groups_where(li, "l_orderkey", F.col("l_returnflag") == "R", require=True).count() > 0
    with pytest.raises(Exception, match="no group matches"):
        groups_where(li, "l_orderkey", F.col("l_returnflag") == "?", require=True).collect()


def test_cell_edit_guards(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    edited, log = apply_cell_edit(o, F.col("o_orderkey") == 1, "o_orderstatus", "X", "test")
    assert edited.where("o_orderstatus = 'X'").count() == 1 and log.first().value_after == "X"
    with pytest.raises(ValueError):
        apply_cell_edit(o, F.col("o_orderkey") < 0, "o_orderstatus", "X")
    with pytest.raises(ValueError):
        apply_cell_edit(o, F.col("o_orderkey") < 3, "o_orderstatus", "X")


def test_capture_diff_and_upsert(spark):
    df = spark.createDataFrame([(1, 1, "a", 10), (1, 2, "b", 10), (2, 1, "c", 5)], "k long, v long, s string, x long")
    d = {(r.k, r.column_name, r.value_before, r.value_after) for r in capture_diff(df, ["k"], ["v"], ["s", "x"])
         .collect()}
    assert d == {(1, "s", "a", "b")}
    base = spark.createDataFrame([(1, "o", 1), (2, "o", 1)], "k long, s string, version int")
    upd = spark.createDataFrame([(2, "f", 2), (3, "n", 2)], "k long, s string, version int")
    assert _rows(upsert(base, upd, ["k"], ["version"])) == [(1, "o", 1), (2, "f", 2), (3, "n", 2)]


def test_cluster_settings_size_partitions_and_never_override(spark):
    from tierline.session import apply_settings, cluster_settings

    conf = cluster_settings(100 * 2**40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert "spark.checkpoint.dir" not in conf
    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_settings(spark, {"spark.sql.shuffle.partitions": "999"})
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_asof_join_takes_inverted_intervals(spark):
    from tierline.operators.asof import asof_join

    left = spark.sql("select 1 as k, date'2020-01-15' as at union all select 2, date'2020-01-15'")
    iv = spark.sql("select 1 as k, date'2020-01-01' as valid_from, date'2020-03-01' as valid_to, 'ok' as v "
                   "union all select 2, date'2020-03-01', date'2020-01-01', 'inverted'")
    got = {r.k: r.v for r in asof_join(left, iv, ["k"], "at").collect()}
    assert got == {1: "ok", 2: None}


def test_landed_vs_built_names_a_wrong_group(spark):
    from tierline.quality.checks import landed_vs_built

    raw = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a")], "k long, ts long, g string")
    built = latest_per_key(raw, ["k"], ["ts"])
    assert landed_vs_built(raw, built, ["k"], ["ts"], ["g"]).where("violates").count() == 0
    oldest = latest_per_key(raw, ["k"], [("ts", False)])
    assert landed_vs_built(raw, oldest, ["k"], ["ts"], ["g"]).where("violates").count() == 2
