"""Clustering against whole Lloyd rounds in Python integers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from tests import parity
from tierline.llm import sphere_kmeans as K


def lloyd(rows, k=8, rounds=10, scale=1024):
    keep = [(i, [math.floor(Fraction(c) * scale) for c in x]) for i, x in rows
            if x is not None and len(x) == 64 and all(c is not None and math.isfinite(c) for c in x)]
    order = sorted(keep, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cent))
    for _ in range(rounds):
        got = [near(v)[1] for _, v in keep]
        for i in range(len(cent)):
            mine = [v for (_, v), g in zip(keep, got) if g == i]
            if mine:
                cent[i] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [near(v) for _, v in keep]
    total = sum(d for d, _ in last)
    per = {i: sum(d for d, g in last if g == i) for i in range(len(cent))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    fit = lambda n: n if n < 1 << 63 else None
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    return sorted(((i, g, fit(d), fit(per[g]), fit(total), sha[g]) for (i, _), (d, g) in zip(keep, last)), key=key)


def result(df):
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


def vectors(n, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(12, 64))
    return (mid[rng.integers(0, 12, n)] + rng.normal(size=(n, 64)) * spread).astype(np.float32).astype(float)


SCHEMA = "vec_id long, embedding array<double>, cluster string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "clash", 1) for i, x in rows], SCHEMA)


def test_against_lloyd(spark):
    x = vectors(400, 1)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63), (905, [float("nan")] + [0.5] * 63),
             (906, [float("-inf")] + [0.5] * 63), rows[3], rows[3], (4, rows[5][1]), (None, rows[7][1]), (907, [0.0] * 64), (908, [-1e-300] * 64)]
    assert result(K.cluster(frame(spark, rows).repartition(5))) == lloyd(rows)


def test_ties_and_copies(spark):
    """A third of the vectors equal, all on a small grid with many ties."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, (120, 64)) / 1024
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert result(K.cluster(frame(spark, rows))) == lloyd(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few(spark, n):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(max(n, 1), 3)[:n])]
    assert result(K.cluster(frame(spark, rows))) == lloyd(rows)


def test_huge_components(spark):
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(vectors(40, 4), [1.0, 1e6, 1e9, 1e40, 1e300] * 8))]
    assert result(K.cluster(frame(spark, rows).repartition(3))) == lloyd(rows)


def test_loosening_is_a_bound():
    rng = np.random.default_rng(5)
    below = 0
    for _ in range(300):
        center, old = rng.integers(-50, 50, 6), rng.integers(-50, 50, 6)
        new, radius = old + rng.integers(-20, 20, 6), float(rng.uniform(0, 40))
        far = K.loosening(center.tolist(), radius, old.tolist(), new.tolist())
        d = rng.normal(size=(2000, 6))
        x = center + d / np.linalg.norm(d, axis=1)[:, None] * radius * rng.uniform(0, 1, (2000, 1)) ** 0.2
        gain = np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)
        assert gain.max() <= far + 1e-9
        below += far < 0.9 * np.linalg.norm(new - old)
    assert below > 100


def test_bounds_spare_comparisons():
    """Bounds leave most vectors of later rounds uncompared, and change nothing."""
    x = vectors(3000, 6, 0.15)
    v = K.integers(x, 1024)
    cent = v[:8].tolist()
    a, up, lo = np.full(len(x), -1), np.full(len(x), np.inf), np.zeros(len(x))
    move, spared = K.Move(cent, cent, {}), 0
    for r in range(10):
        a, up, lo, _, scanned = K.assign(x, 1024, a, up, lo, move)
        d = np.stack([K.squared(v, c) for c in cent], 1)
        assert (a == d.argmin(1)).all()
        spared += (len(x) - scanned) if r else 0
        new = [(v[a == i].sum(0) // (a == i).sum()).tolist() if (a == i).any() else cent[i] for i in range(8)]
        move, cent = K.Move(cent, new, {i: float(up[a == i].max()) for i in range(8) if (a == i).any()}), new
    assert spared > 0.5 * 9 * len(x)


def test_oracle(spark, tmp_path):
    import duckdb

    rows = [(i, v.tolist()) for i, v in enumerate(vectors(150, 7))] + [(200, [1.0]), (201, None), (202, [float("nan")] * 64)]
    frame(spark, rows).select("vec_id", "embedding").write.parquet(f"{tmp_path}/e")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/e/*.parquet'")
    res = con.execute(K.oracle_sql())
    cols = [d[0] for d in res.description]
    got = K.cluster(frame(spark, rows))
    assert parity.rows_of(cols, res.fetchall()) == parity.rows_of(got.columns, [tuple(r) for r in got.collect()])
