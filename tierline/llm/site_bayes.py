"""Quality classifier by hierarchical empirical Bayes (operator 10).

A logistic model over byte-pair shares and document statistics gives each
document its own log-odds.  Grouped sums over all documents give every host
and every path of a host a Beta posterior of its share of good documents: the
prior of a host is the global share, that of a path the posterior of its
host, each with a strength estimated by the moments of the level's shares.
Sparse sites so stay near the prior above them.  The verdict adds the path's
posterior log-odds, less the model's own prior, to the document's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import textstats
from tierline.llm.quality_rules import features, labelled_sample
from tierline.llm.shared import ship, staged, veiled

BUCKETS = 1024


def evidence_features(texts: pa.Array) -> np.ndarray:
    s = textstats.Spans(texts)
    n = len(s.off) - 1
    x = np.zeros((n, BUCKETS))
    b = s.buf.astype(np.int64)
    pair = (b[:-1] * 31 + b[1:] * 17 + (b[:-1] ^ b[1:]) * 5) % BUCKETS if len(b) > 1 else np.zeros(0, np.int64)
    for i in range(n):
        lo, hi = s.off[i], max(s.off[i], s.off[i + 1] - 1)
        if hi > lo:
            x[i] = np.sqrt(np.bincount(pair[lo:hi], minlength=BUCKETS) / (hi - lo))
    return np.concatenate([x, np.clip(features(textstats.counts(texts)), -10, 10) / 3], 1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = 5000, steps: int = 150) -> tuple[np.ndarray, float, float] | None:
    """``(weights, bias, prior log-odds)`` on at most ``rows`` labelled
    documents; None where a class is missing."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            for at, n in textstats.slices(b.column("text")):
                x = evidence_features(b.column("text").slice(at, n)).astype("<f4")
                yield pa.RecordBatch.from_arrays([b.column("y").slice(at, n).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], ["y", "x"])

    got = sorted((r.y, bytes(r.x)) for r in labelled_sample(docs, labels, rows).mapInArrow(run, "y int, x binary").collect())
    y = np.array([g[0] for g in got], float)
    if len(set(y.tolist())) < 2:
        return None
    x = np.stack([np.frombuffer(g[1], "<f4") for g in got]).astype(float)
    w, b = np.zeros(x.shape[1]), 0.0
    mw, vw = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        r = 1 / (1 + np.exp(-(x @ w + b))) - y
        g = np.append(x.T @ r / len(y) + 1e-4 * w, r.mean())
        mw, vw = 0.9 * mw + 0.1 * g, 0.99 * vw + 0.01 * g * g
        step = 0.1 * (mw / (1 - 0.9**t)) / (np.sqrt(vw / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    m = y.mean()
    return w, float(b), float(np.log(m / (1 - m)))


def evidence(docs: DataFrame, model, name: str = "doc_logit") -> DataFrame:
    """``docs`` with the document's own log-odds (0 without a model)."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for at, n in textstats.slices(b.column("text_")):
                part = b.slice(at, n)
                if held.value is None:
                    z = np.zeros(n)
                else:
                    w, bias, _ = held.value
                    z = evidence_features(part.column("text_")) @ w + bias
                names = [x for x in part.schema.names if x != "text_"]
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), pa.array(z)], [*names, name])

    d = docs.drop(name).withColumn("text_", F.col("text").cast("string"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name != "text_"] + [f"`{name}` double"])
    return d.mapInArrow(run, schema)


def _strength(level: DataFrame, share: str, above: str, n: str) -> float:
    """Prior strength by moments: what the shares of the level vary beyond
    binomial noise, as pseudo-counts between 1 and 1000."""
    m = level.agg(F.sum(F.col(n) * (F.col(share) - F.col(above)) ** 2).alias("v"),
                  F.sum(F.col(above) * (1 - F.col(above))).alias("noise"), F.sum(n).alias("n"),
                  F.sum(F.col(n) * F.col(above) * (1 - F.col(above))).alias("full")).first()
    if not m.n or m.v is None or m.v <= m.noise or not m.full:
        return 1000.0
    between = (m.v - m.noise) / m.n
    return float(min(1000.0, max(1.0, (m.full / m.n) / between - 1)))


def site_posteriors(scored: DataFrame, host: str = "host", path: str = "path", z: str = "doc_logit") -> DataFrame:
    """``(host, path, path_posterior, host_posterior, n_docs)`` from all rows
    of ``scored``.  Null hosts and paths are sites of their own."""
    p = 1 / (1 + F.exp(-F.col(z)))
    paths = staged(scored.groupBy(host, path).agg(F.count("*").alias("n"), F.sum(p).alias("good")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = (total.good + 1) / (total.n + 2) if total.n else 0.5
    hosts = (paths.groupBy(F.col(host).alias("h_")).agg(F.sum("n").alias("hn"), F.sum("good").alias("hg"))
             .withColumn("hs", F.col("hg") / F.col("hn")).withColumn("prior", F.lit(share)))
    k = _strength(hosts, "hs", "prior", "hn")
    hosts = hosts.select("h_", ((F.col("hg") + k * F.col("prior")) / (F.col("hn") + k)).alias("host_posterior"))
    both = paths.join(hosts, paths[host].eqNullSafe(hosts.h_)).withColumn("ps", F.col("good") / F.col("n"))
    k2 = _strength(both, "ps", "host_posterior", "n")
    return both.select(F.col(host).alias("h_"), F.col(path).alias("p_"), F.col("n").alias("n_docs"), "host_posterior",
                       ((F.col("good") + k2 * F.col("host_posterior")) / (F.col("n") + k2)).alias("path_posterior"))


def classify(docs: DataFrame, model, host: str = "source", path: str = "lang", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``doc_logit, host_posterior, path_posterior, score,
    kept``; columns of those names are replaced.  Null text is scored as
    empty.  Repeated rows count as often as they occur and get equal scores;
    without a model every document is kept; an empty table gives none.

    The texts are scored twice, once for the sums and once for the verdict,
    which is cheaper than writing them with the score in between."""
    own = ["doc_logit", "host_posterior", "path_posterior", "score", "kept"]
    hidden, back = veiled(docs, [c for c in docs.columns if c not in own])
    d = docs.select(F.col(host).alias("host"), F.col(path).alias("path"), "text")
    sites = staged(site_posteriors(evidence(d, model)), "sites")
    e = evidence(docs.select(*hidden, F.col(host).alias("host"), F.col(path).alias("path"), "text"), model)
    j = e.join(sites, e["host"].eqNullSafe(sites.h_) & e["path"].eqNullSafe(sites.p_), "left")
    prior = model[2] if model is not None else 0.0
    s = 1 / (1 + F.exp(-(F.col("doc_logit") - F.lit(prior) + F.log(F.col("path_posterior") / (1 - F.col("path_posterior"))))))
    j = j.withColumn("score", s).withColumn("kept", F.lit(True) if model is None else F.col("score") >= threshold)
    return j.select(*back, *own)
