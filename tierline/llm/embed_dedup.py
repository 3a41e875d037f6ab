"""Embedding near-dedup by collision counting (operator 2).

Unit vectors are projected on many random lines.  Two vectors collide on a
line where their values lie within a query-centred window.  The window and
the number of collisions asked for are set so that a pair at the threshold
passes with the wanted recall; pairs that pass are verified in double
precision.

One line's window holds a constant share of all vectors, so counting over
whole lines would be quadratic.  The first lines are therefore taken in
groups: vectors in one cell of a group (each line cut at a random offset) meet
in a task, sorted along a line, and collisions are counted there.  The number
of lines in a group grows with the logarithm of the input, so a cell holds
about ``cell_rows`` unrelated vectors at any size, and there are as many
groups as the recall asks for.  Cells that near copies make large are split
into blocks that meet pairwise.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.components import connected_components
from tierline.llm.shared import ship, staged


def _phi(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


class Plan:
    """Lines, cells and the collision count for ``rows`` vectors."""

    def __init__(self, rows: int, cosine: float, recall: float, cell_rows: int, lines: int, seed: int):
        near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
        self.width = 4 * near
        # share of pairs in one cell of width w on one line, by distance
        self.near_cell, self.far_cell = self._same(near), self._same(far)
        self.k = max(1, round(math.log(max(2, rows / cell_rows)) / -math.log(self.far_cell)))
        miss = (1 - recall) / 2
        self.groups = math.ceil(math.log(miss) / math.log(1 - self.near_cell**self.k))
        self.window, self.lines, self.seed, self.cosine = 2.5 * near, lines, seed, cosine
        p = 2 * _phi(2.5) - 1
        # calibrated count: the largest with at most ``miss`` of the threshold pairs below it
        below, self.count = 0.0, 0
        for c in range(lines + 1):
            below += math.comb(lines, c) * p**c * (1 - p) ** (lines - c)
            if below > miss:
                self.count = c
                break

    def _same(self, d: float) -> float:
        t = np.linspace(-self.width, self.width, 4001)
        return float(((1 - np.abs(t) / self.width) * np.exp(-t * t / (2 * d * d)) / (d * math.sqrt(2 * math.pi))).sum() * (t[1] - t[0]))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """64-bit cell of each vector in each group."""
        rng = np.random.default_rng([self.seed, unit.shape[1]])
        a = rng.normal(size=(unit.shape[1], self.groups * self.k))
        off = rng.uniform(0, self.width, self.groups * self.k)
        q = np.floor((unit @ a + off) / self.width).astype(np.int64).reshape(len(unit), self.groups, self.k)
        h = np.full((len(unit), self.groups), unit.shape[1], np.uint64) + np.arange(self.groups, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for j in range(self.k):
            h = (h ^ q[:, :, j].astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(1)).astype(np.int64)

    def values(self, unit: np.ndarray) -> np.ndarray:
        return unit @ np.random.default_rng([self.seed + 1, unit.shape[1]]).normal(size=(unit.shape[1], self.lines))


def _units(raw: list[list[float]]) -> np.ndarray:
    x = np.array(raw, np.float64)
    # by powers of two first, which rounds nothing, so that no square over- or underflows
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.sqrt((x * x).sum(1))[:, None]


def near_vectors(table: DataFrame, cosine: float = 0.9, recall: float = 0.995, cell_rows: int = 256, block: int = 2048,
                 lines: int = 16, seed: int = 11) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of
    ``table(vec_id, embedding)``.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths.  Equal vectors are
    one class, whose members link with each other and with all members of
    linked classes.  Repeated rows count as vectors of their own; a null
    vec_id is reported with the component of its class.  An empty table gives
    no rows; extra columns are ignored."""
    spark = table.sparkSession
    ship(spark)
    t = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.coalesce(finite & F.exists("e", lambda v: v != 0), F.lit(False))
    t = t.withColumn("e", F.when(good, F.col("e")))
    classes = staged(t.where("e is not null").groupBy("e").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
                     .withColumn("cid", F.expr("xxhash64(e)")), "vector-classes")
    plan = spark.sparkContext.broadcast(Plan(classes.count(), cosine, recall, cell_rows, lines, seed))

    def place(batches):
        for b in batches:
            raw, cid = b.column("e").to_pylist(), b.column("cid").to_numpy()
            size = np.array([len(v) for v in raw])
            for m in np.unique(size):
                at = np.flatnonzero(size == m)
                for k in range(0, len(at), 1000):
                    rows = at[k:k + 1000]
                    x = np.array([raw[i] for i in rows])
                    c = plan.value.cells(_units(x))
                    g = c.shape[1]
                    e = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) * g + 1) * m, pa.int32()), pa.array(np.repeat(x, g, 0).ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(c.ravel()), pa.array(np.repeat(cid[rows], g)), e], ["cell", "cid", "e"])

    def links(batches):
        held: list[tuple] = []
        key = None

        def solve(run):
            out = []
            for m in {len(v[2]) for v in run}:
                rows = [v for v in run if len(v[2]) == m]
                cid, side = np.array([v[0] for v in rows]), np.array([v[1] for v in rows])
                unit = _units([v[2] for v in rows])
                out += _pairs(plan.value, unit, cid, side)
            return out

        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("cell", "i", "j", "cid", "side", "e"))))
            found = []
            for r in rows:
                if r[:3] != key:
                    if len(held) > 1:
                        found += solve(held)
                    held, key = [], r[:3]
                held.append(r[3:])
            if found:
                yield _edges(found)
        if len(held) > 1:
            found = solve(held)
            if found:
                yield _edges(found)

    placed = classes.select("cid", "e").mapInArrow(place, "cell long, cid long, e array<double>")
    # cells with one vector have no pairs; crowded ones are split into blocks
    sizes = staged(placed.select("cell").groupBy("cell").agg(F.count("*").alias("m")).where("m > 1"), "cells")
    parts = F.ceil(F.col("m") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
    dealt = (placed.join(sizes, "cell").withColumn("parts", parts).withColumn("own", own)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("cell", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "cid", (F.col("own") <= F.col("o")).alias("side"), "e"))
    pairs = (dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(links, "a long, b long").distinct())
    pairs = staged(pairs, "vector-links")
    comp = connected_components(pairs)
    sizes_of = classes.select("cid", "least", "n")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    out = (both.join(sizes_of.select(F.col("cid").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("other")))
    named = (classes.join(comp, classes.cid == comp.node, "left").join(out, classes.cid == out.a, "left")
             .select("e", "least", "n", F.coalesce("component", "cid").alias("c"), F.coalesce("other", F.lit(0)).alias("other")))
    low = named.groupBy("c").agg(F.min("least").alias("component_id"))
    found = named.join(low, "c").select("e", (F.col("other") + F.col("n") - 1).alias("n_links"), "component_id")
    res = t.join(found, "e", "left")
    return (res.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])


def _pairs(plan: Plan, unit: np.ndarray, cid: np.ndarray, side: np.ndarray, most: int = 1_000_000) -> list[tuple[int, int]]:
    """Verified pairs of a cell: windows along the first line, then line by
    line, leaving a pair once it can no longer reach the count.  In a cell of
    two blocks only pairs across them are tried."""
    v = plan.values(unit)
    order = np.argsort(v[:, 0], kind="stable")
    v, unit, cid, side = v[order], unit[order], cid[order], side[order]
    two, out = len(np.unique(side)) > 1, []
    # a pair may miss the first line and still pass, so the window there is wide enough to miss none of note
    end = np.searchsorted(v[:, 0], v[:, 0] + 1.6 * plan.window, "right")
    n = np.maximum(end - np.arange(len(v)) - 1, 0)
    lo = 0
    while lo < len(v):
        hi, total = lo + 1, n[lo]
        while hi < len(v) and total + n[hi] <= most:
            total += n[hi]
            hi += 1
        x = np.repeat(np.arange(lo, hi), n[lo:hi])
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n[lo:hi]) - n[lo:hi], n[lo:hi])
        if two:
            ok = side[x] != side[y]
            x, y = x[ok], y[ok]
        miss = np.zeros(len(x), np.int16)
        for k in range(v.shape[1]):
            miss += np.abs(v[x, k] - v[y, k]) > plan.window
            ok = miss <= v.shape[1] - plan.count
            x, y, miss = x[ok], y[ok], miss[ok]
        sure = np.einsum("ij,ij->i", unit[x], unit[y]) >= plan.cosine
        a, b = cid[x[sure]], cid[y[sure]]
        out += zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())
        lo = hi
    return out
