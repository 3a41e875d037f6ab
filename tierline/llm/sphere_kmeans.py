"""Centroid clustering with geometric drift bounds (operator 13).

Lloyd's rounds over integer vectors.  Besides its cluster each vector carries
an upper bound of the distance to its centroid and a lower bound of that to
any other.  After the centroids move, the members of cluster ``i`` lie in the
sphere around its old centroid whose radius is their largest upper bound.  A
centroid that moves from ``c`` to ``c'`` comes nearer to a point ``x`` by
``2 |c' - c| t / (|x - c| + |x - c'|)``, ``t`` being the distance of ``x``
beyond the middle plane; as the denominator is at least twice the distance of
``x`` from the middle point ``m``, that is at most ``|c' - c| cos(angle)``
with the angle at ``m`` between ``x`` and the direction of the move.  In the
plane through ``m``, the sphere's centre and that direction, the sphere fixes
the smallest angle, and so loosens the lower bounds of cluster ``i`` by less
than the whole drift, by nothing where it lies behind the middle plane.
Vectors whose bounds still overlap are compared exactly, in integers.

Centroids, radii and drifts are k rows on the driver; vectors stay in a table
in the shared folder, which each round writes anew before the last goes.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.shared import ship, staged, work_dir

#: Integers below this size keep every squared distance of 64 components in 63 bits.
SAFE = 1 << 26
#: Share by which bounds in floating point must differ to count.
SLACK = 1e-9
_LIMB = 60
STATE = "vec_id long, x array<double>, a int, upper double, lower double, pos int, limb int, value long, radius double"


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), ``scale`` a power of two: 64-bit where that is small
    enough for exact distances, Python integers else."""
    with np.errstate(over="ignore"):
        v = np.floor(x * scale)
    if not v.size or np.abs(v).max() < SAFE:
        return v.astype(np.int64)
    return np.array([[math.floor(Fraction(float(c)) * scale) for c in row] for row in x], object)


def squared(v: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Exact squared distances of the rows to a centroid."""
    if v.dtype != object and max(map(abs, centroid), default=0) < SAFE:
        d = v - np.array(centroid, np.int64)
        return np.einsum("ij,ij->i", d, d)
    d = v.astype(object) - np.array(centroid, object)
    return (d * d).sum(1)


def _root(n: int) -> float:
    return math.sqrt(n) if n < 1 << 1000 else math.inf


def _distance(a: list[int], b: list[int]) -> float:
    return _root(sum((p - q) ** 2 for p, q in zip(a, b)))


def loosening(center: list[int], radius: float, old: list[int], new: list[int]) -> float:
    """By how much a centroid that moves from ``old`` to ``new`` can come
    nearer to any point of the sphere."""
    drift = _distance(old, new)
    if not drift:
        return 0.0
    middle = [(p + q) / 2 for p, q in zip(old, new)]
    away = math.sqrt(sum((p - q) ** 2 for p, q in zip(center, middle)))
    if away <= radius * (1 + SLACK):
        return drift * (1 + SLACK)
    along = sum((c - m) * (q - p) for c, m, p, q in zip(center, middle, old, new)) / (away * drift)
    angle = math.acos(max(-1.0, min(1.0, along))) - math.asin(min(1.0, radius / away)) - SLACK
    return drift * max(0.0, math.cos(max(0.0, angle))) * (1 + SLACK) + SLACK * drift


class Move:
    """What a round needs to know of the last one's moves."""

    def __init__(self, old: list[list[int]], new: list[list[int]], radii: dict[int, float]):
        k = len(new)
        self.centroids = new
        #: bounds in floating point serve while no centroid has huge components; else all vectors are compared
        self.bounded = all(abs(c) < SAFE for v in [*old, *new] for c in v)
        if not self.bounded:
            self.drift = self.loose = np.zeros(k)
            self.half = np.full(k, -1.0)
            return
        self.drift = np.array([_distance(o, n) * (1 + SLACK) for o, n in zip(old, new)])
        self.loose = np.array([max((loosening(old[i], radii.get(i, 0.0), old[j], new[j]) for j in range(k) if j != i), default=0.0) for i in range(k)])
        self.half = np.array([min((_distance(new[i], new[j]) for j in range(k) if j != i), default=math.inf) / 2 for i in range(k)])


def assign(x: np.ndarray, scale: int, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move) -> tuple[np.ndarray, ...]:
    """New cluster, bounds and integers of the vectors, and how many had to be
    compared exactly.  A cluster below 0 means not assigned yet."""
    v = integers(x, scale)
    a, upper, lower = a.copy(), upper.copy(), lower.copy()
    old = a >= 0
    upper[old] += move.drift[a[old]]
    lower[old] -= move.loose[a[old]]
    reach = np.where(old, np.maximum(lower, move.half[a]), -1.0)
    open_ = np.flatnonzero(~(upper * (1 + SLACK) < reach * (1 - SLACK)))
    if v.dtype == object or not move.bounded:
        open_ = np.arange(len(v))
    if len(open_):
        d = np.stack([squared(v[open_], c) for c in move.centroids], 1)
        # the first of equal distances is that of the smaller number
        best = np.array([min(range(len(r)), key=r.__getitem__) for r in d.tolist()], np.int64) if d.dtype == object else d.argmin(1)
        near = np.array([[_root(n) for n in r] for r in d.tolist()]) if d.dtype == object else np.sqrt(d.astype(float))
        a[open_] = best
        upper[open_] = near[np.arange(len(best)), best] * (1 + SLACK)
        near[np.arange(len(best)), best] = np.inf
        lower[open_] = near.min(1) * (1 - SLACK)
    return a, upper, lower, v, len(open_)


def _limbs(value: int) -> list[tuple[int, int]]:
    out, i = [], 0
    while value not in (0, -1) and abs(value) >= 1 << _LIMB:
        value, low = divmod(value, 1 << _LIMB)
        out.append((i, low))
        i += 1
    return [(i, n) for i, n in [*out, (i, value)] if n]


def _rows(**columns) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values())
    kinds = {"vec_id": pa.int64(), "x": pa.list_(pa.float64()), "a": pa.int32(), "upper": pa.float64(), "lower": pa.float64(),
             "pos": pa.int32(), "limb": pa.int32(), "value": pa.int64(), "radius": pa.float64()}
    arrays = [c if isinstance(c := columns.get(k), pa.Array) else pa.nulls(n, t) if c is None else pa.array(c, t) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _step(state: DataFrame, move: Move, scale: int, width: int) -> DataFrame:
    """Each vector's new state; per task and cluster the sums of the members'
    components, their number (at ``pos = width``) and the largest upper bound."""
    k = len(move.centroids)

    def step(batches):
        sums, count, radius = [[0] * width for _ in range(k)], [0] * k, [0.0] * k
        for b in batches:
            if not b.num_rows:
                continue
            a, upper, lower = (b.column(c).to_numpy(zero_copy_only=False) for c in ("a", "upper", "lower"))
            a, upper, lower, v, _ = assign(_matrix(b.column("x"), width), scale, a.astype(np.int64), upper, lower, move)
            for i in np.unique(a).tolist():
                mine = a == i
                sums[i] = [p + int(q) for p, q in zip(sums[i], v[mine].sum(0))]
                count[i] += int(mine.sum())
                radius[i] = max(radius[i], float(upper[mine].max()))
            yield _rows(vec_id=b.column("vec_id"), x=b.column("x"), a=a.astype(np.int32), upper=upper, lower=lower)
        rows = [(i, p, limb, n) for i in range(k) if count[i] for p, s in enumerate([*sums[i], count[i]]) for limb, n in _limbs(s)]
        if rows:
            c, p, limb, n = map(list, zip(*rows))
            yield _rows(a=c, pos=p, limb=limb, value=n, radius=[radius[i] for i in c])

    return state.mapInArrow(step, STATE)


def _moved(table: DataFrame, centroids: list[list[int]], width: int) -> tuple[list[list[int]], dict[int, float]]:
    """New centroids and radii; at most k * (width + 1) * limbs rows reach the driver."""
    rows = (table.where("pos is not null").groupBy("a", "pos", "limb")
            .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("n"), F.max("radius").alias("r")).collect())
    total: dict[tuple[int, int], int] = {}
    radii: dict[int, float] = {}
    for r in rows:
        total[r.a, r.pos] = total.get((r.a, r.pos), 0) + (int(r.n) << (_LIMB * r.limb))
        radii[r.a] = max(radii.get(r.a, 0.0), r.r)
    new = [[total.get((i, p), 0) // total[i, width] for p in range(width)] if (i, width) in total else c for i, c in enumerate(centroids)]
    return new, radii


def _retire(path: str) -> None:
    """Remove a table that no later plan reads."""
    fs, at = pafs.FileSystem.from_uri(path)
    fs.delete_dir(at)


def usable(table: DataFrame, width: int) -> DataFrame:
    """``vec_id, x`` of the vectors with ``width`` finite components."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == width) & ~bad)


def cluster(table: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """Per vector of ``table(vec_id, embedding)`` with ``width`` finite
    components: ``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``.

    Components count as floor(scale * x).  The first centroids are the k
    vectors with the smallest sha256 of ``seed:vec_id`` (a null id counts as
    empty text, equal ids by their components).  Ties go to the smaller
    cluster, empty clusters keep their centroid; fewer than k vectors make
    fewer clusters.  Repeated rows and ids are vectors of their own; null,
    short, long and non-finite vectors give no row; an empty table gives no
    rows; other columns are ignored.  Sums and distances are exact at any size
    of the components; a distance or inertia beyond 64 bits is null."""
    spark: SparkSession = table.sparkSession
    ship(spark)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    vectors = usable(table, width)
    first = vectors.orderBy(key, "x").limit(k).collect()
    centroids = [[int(c) for c in integers(np.array([r.x]), scale)[0]] for r in first]
    state = vectors.selectExpr("vec_id", "x", "-1 as a", "double('inf') as upper", "double(0) as lower")
    move, last = Move(centroids, centroids, {}), None
    for _ in range(rounds if centroids else 0):
        path = work_dir(spark, "kmeans")
        _step(state, move, scale, width).write.parquet(path)
        if last:
            _retire(last)
        written, last = spark.read.schema(STATE).parquet(path), path
        new, radii = _moved(written, centroids, width)
        move, centroids = Move(centroids, new, radii), new
        state = written.where("x is not null").select("vec_id", "x", "a", "upper", "lower")

    def finish(batches):
        for b in batches:
            if not b.num_rows:
                continue
            a, upper, lower = (b.column(c).to_numpy(zero_copy_only=False) for c in ("a", "upper", "lower"))
            a, _, _, v, _ = assign(_matrix(b.column("x"), width), scale, a.astype(np.int64), upper, lower, move)
            far = np.zeros(len(a), object)
            for i in np.unique(a).tolist():
                far[a == i] = squared(v[a == i], move.centroids[i]).astype(object)
            far = [int(f) for f in far]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(a.astype(np.int32)), pa.array([str(f) for f in far])], ["vec_id", "cluster", "far"])

    done = staged(state.mapInArrow(finish, "vec_id long, cluster int, far string"), "clusters")
    # sums in decimal: a row per cluster, k at most, reaches the driver
    sums = {r.cluster: r.s for r in done.groupBy("cluster").agg(F.sum(F.expr("try_cast(far as decimal(38,0))")).alias("s")).collect()}
    whole = sum((int(s) for s in sums.values()), 0) if None not in sums.values() else None
    long = lambda n: int(n) if n is not None and n < 1 << 63 else None
    facts = [(i, long(sums.get(i)), long(whole), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(move.centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (done.join(F.broadcast(facts), "cluster")  # k rows
            .select("vec_id", "cluster", F.expr("try_cast(far as bigint)").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256"))


def oracle_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same clustering as one DuckDB statement over ``embeddings``: every
    round compares all vectors with all centroids."""
    parts = [f"""
e as (select vec_id, [floor({scale} * c::double)::bigint for c in embedding] as v from embeddings
      where len(embedding) = {width} and len([c for c in embedding if c is null or isnan(c) or isinf(c)]) = 0),
x as materialized (select vec_id, unnest(v) as v, generate_subscripts(v, 1) as pos from e),
s as (select vec_id, row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as c from e),
c0 as materialized (select s.c, x.pos, x.v from s join x using (vec_id) where s.c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
a{r} as materialized (select vec_id, arg_min(c, struct_pack(d, c)) as c, min(d) as d from (
      select x.vec_id, c.c, sum((x.v - c.v) * (x.v - c.v)) as d from x join c{r} c using (pos) group by all) group by vec_id)""")
        if r < rounds:
            parts.append(f"""
c{r + 1} as materialized (select c{r}.c, c{r}.pos, coalesce(m.v, c{r}.v) as v from c{r} left join (
      select a.c, x.pos, (sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) as v from a{r} a join x using (vec_id) group by all) m
      on m.c = c{r}.c and m.pos = c{r}.pos)""")
    return "with" + ",".join(parts) + f"""
select a.vec_id, a.c::int as cluster, a.d::bigint as distance, (sum(a.d) over (partition by a.c))::bigint as cluster_inertia,
       (sum(a.d) over ())::bigint as inertia, h.h as centroid_sha256
from a{rounds} a join (select c, sha256(string_agg(v::varchar, ',' order by pos)) as h from c{rounds} group by c) h using (c)"""
