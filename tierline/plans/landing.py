"""Landing-side jobs, re-aimed from single-machine tools to Spark work.

* ``land_captures`` (J-01): write-once batch append of new captures.
  Partition components are normalised (trim, lower case); partitions that
  already hold a complete capture are skipped unless ``recapture`` (then a
  new capture lands *beside* the old one; the directory of a complete capture
  is never written again).  Payloads are written partitioned by
  season/grain/season_type/capture; one audit row per capture (rows, bytes,
  sha256 of the written bytes) is appended afterwards to ``_audit`` and is
  the completeness marker.  A retry after a crash in between replaces the
  payloads of the captures that have no audit row yet.
* ``existing_captures`` (J-02), ``plan`` (J-03), ``row_maps`` (J-07),
  ``run_metrics`` (J-08), ``capture_pair_diff`` (J-09),
  ``superseded_captures`` (D-15).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import DEFAULT_ENDPOINT, DEFAULT_SOURCE, GRAINS, PARTITIONS, SEASON_PATTERN, SEASON_TYPES
from tierline.functions.columns import distinct_from
from tierline.operators.gaps import consecutive_gaps
from tierline.operators.latest import latest_per_key
from tierline.quality.checks import plan_vs_landed
from tierline.sources.landing import endpoint_root, path_exists, payload_digests, read_manifests


AUDIT = ("season string, grain string, season_type string, capture string, row_count long, payload_bytes long, "
         "payload_sha256s array<string>, landed_at timestamp")


def audit_path(root: str, source: str, endpoint: str) -> str:
    return f"{endpoint_root(root, source, endpoint)}/_audit"


def landing_audits(spark: SparkSession, root: str, source: str, endpoint: str) -> DataFrame | None:
    """The audit rows of captures landed by ``land_captures``; None without any."""
    ap = audit_path(root, source, endpoint)
    return spark.read.parquet(ap) if path_exists(spark, ap) else None


def landed_partitions(spark: SparkSession, root: str, source: str, endpoint: str) -> DataFrame:
    """(season, grain, season_type, capture) of every complete capture:
    manifest sidecars plus Spark-landed audit rows."""
    parts = read_manifests(spark, root, source, endpoint).select(*PARTITIONS)
    audits = landing_audits(spark, root, source, endpoint)
    if audits is not None:
        parts = parts.unionByName(audits.select(*PARTITIONS))
    return parts.distinct()


def land_captures(spark: SparkSession, captures: DataFrame, root: str, source: str = DEFAULT_SOURCE,
                  endpoint: str = DEFAULT_ENDPOINT, recapture: bool = False) -> DataFrame:
    """Append new captures; returns the audit rows written (possibly none).

    Without ``recapture`` the earliest capture of each partition in the batch
    lands and the others are skipped, as they would be in a later batch.  A
    capture repeated in the batch lands once; two different payloads for one
    capture are an error and nothing is written."""
    norm = captures.select(*[F.lower(F.trim(F.col(p))).alias(p) if p != "capture" else F.upper(F.trim(F.col(p)))
                             .alias(p) for p in PARTITIONS],
                           *[c for c in captures.columns if c not in PARTITIONS])
    existing = landed_partitions(spark, root, source, endpoint)
    if recapture:
        todo = norm.join(existing, PARTITIONS, "left_anti")
    else:
        todo = norm.join(existing.select(*PARTITIONS[:3]).distinct(), PARTITIONS[:3], "left_anti")
        first = todo.groupBy(*PARTITIONS[:3]).agg(F.min("capture").alias("capture"))
        todo = todo.join(first, PARTITIONS, "left_semi")
    payload = F.sha2(F.to_json(F.struct(*[c for c in norm.columns if c not in PARTITIONS])), 256)
    todo = todo.withColumn("__payload", payload).checkpoint()  # fixed set of captures for both writes below
    clash = todo.groupBy(*PARTITIONS).agg(F.count_distinct("__payload").alias("n")).where("n > 1").first()
    if clash is not None:
        raise ValueError("two different payloads for capture " + "/".join(str(clash[p]) for p in PARTITIONS))
    todo = todo.dropDuplicates([*PARTITIONS, "__payload"]).drop("__payload")
    base = endpoint_root(root, source, endpoint)
    # no capture in ``todo`` is complete, so the overwrite only replaces what an earlier failed attempt left
    (todo.repartition(*PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS).json(base))
    rows = todo.select(*PARTITIONS, _envelope_rows().alias("row_count"))
    # One entry per folder just written, which the scan below lists on the driver anyway; as literals they prune it.
    new = todo.select(*PARTITIONS).distinct().collect()
    if not new:
        return spark.createDataFrame([], AUDIT)
    dig = payload_digests(spark, root, source, endpoint)
    for p in PARTITIONS:
        dig = dig.where(F.col(p).isin(sorted({r[p] for r in new})))
    dig = dig.join(todo.select(*PARTITIONS), PARTITIONS, "left_semi")
    audit = rows.join(dig.groupBy(*PARTITIONS).agg(
        F.sum("bytes").alias("payload_bytes"), F.sort_array(F.collect_list("sha256")).alias("payload_sha256s")),
        PARTITIONS).withColumn("landed_at", F.current_timestamp())
    audit = audit.checkpoint()
    audit.write.mode("append").parquet(audit_path(root, source, endpoint))
    return audit


def _envelope_rows() -> Column:
    """Rows of an envelope's first result set, 0 where it has none."""
    return F.coalesce(F.size(F.get("resultSets", F.lit(0))["rowSet"]), F.lit(0)).cast("bigint")


def existing_captures(landed: DataFrame) -> DataFrame:
    """J-02: per partition, number of complete captures and the newest."""
    return landed.groupBy(*PARTITIONS[:3]).agg(F.count(F.lit(1)).alias("n_captures"),
                                               F.max("capture").alias("latest_capture"))


def ordered_captures(landed: DataFrame) -> DataFrame:
    """J-02 / SO-3: per partition its complete captures, oldest first, as one
    comma-joined text.  A partition has as many as it was landed times."""
    stamps = F.sort_array(F.collect_set("capture"))
    return landed.groupBy(*PARTITIONS[:3]).agg(F.array_join(stamps, ",").alias("captures"))


def plan(spark: SparkSession, landed: DataFrame, seasons: Sequence[str], grains: Sequence[str],
         season_types: Sequence[str] = ("regular",), recapture: bool = False) -> DataFrame:
    """J-03: the expected season × grain × season_type product split into
    ``landed`` and ``to_issue``; with ``recapture`` everything is issued.  An
    empty list, a repeated entry and one that no landing could hold are errors."""
    for name, given, fits in (("seasons", seasons, lambda s: re.fullmatch(SEASON_PATTERN, s)), ("grains", grains, GRAINS.__contains__),
                              ("season types", season_types, SEASON_TYPES.__contains__)):
        if isinstance(given, str) or not given or len(set(given)) < len(given):
            raise ValueError(f"{name} must be a list of different values, got {given!r}")
        if wrong := [g for g in given if not fits(g)]:
            raise ValueError(f"{name} cannot be {wrong}")
    expected = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in seasons])).alias("season")).select(
        "season", F.explode(F.array(*[F.lit(g) for g in grains])).alias("grain")).select(
        "season", "grain", F.explode(F.array(*[F.lit(t) for t in season_types])).alias("season_type"))
    if recapture:
        return expected.withColumn("status", F.lit("to_issue"))
    return plan_vs_landed(expected, landed.select(*PARTITIONS[:3]), PARTITIONS[:3])


def row_maps(envelopes: DataFrame, carry: Sequence[str] = ("source_file",)) -> DataFrame:
    """J-07: one (header → cell) map per row of ``headers``/``rows``
    envelopes.  ``map_from_arrays`` raises on a ragged row (size mismatch)
    and on a duplicate header (key dedup policy EXCEPTION) instead of
    silently pairing the wrong cells."""
    # paired before the explode, so that no row carries the header list beside its own map
    rows = F.transform("rows", lambda cells: F.map_from_arrays(F.col("headers"), cells))
    return envelopes.select(*carry, F.explode(rows).alias("row"))


def padded_pairs(a: Column, b: Column) -> Column:
    """FN-4: the items of two lists side by side, the shorter one padded with
    nulls, where a map would raise."""
    return F.arrays_zip(a.alias("left"), b.alias("right"))


def run_metrics(calls: DataFrame) -> DataFrame:
    """J-08: per run — planned vs made, written vs skipped, rows landed, and
    the spacing between consecutive calls (from ``issued_at``)."""
    c = calls.withColumn("__ts", F.to_timestamp_ntz("issued_at"))
    per = c.groupBy("run").agg(
        F.count(F.lit(1)).alias("calls_made"), F.count_if("written").alias("captures_written"),
        F.count_if(~F.col("written")).alias("captures_skipped"), F.sum("row_count").alias("rows_landed"),
        F.max("attempts").alias("max_attempts"))
    gaps = consecutive_gaps(c, ["run"], "__ts", split="hour").select(
        "run", (F.col("max_gap_us") / 1e6).alias("max_spacing_seconds"))
    return per.join(gaps, "run", "left")


def capture_pair_diff(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], before: str,
                      after: str) -> DataFrame:
    """J-09: (key…, column, before, after) for every value that differs
    between two captures; a key present in one capture only shows with the
    other side NULL."""
    a = rows.where(F.col("capture") == before).select(*keys, *[F.col(c).cast("string").alias(f"__a_{c}")
                                                               for c in columns])
    b = rows.where(F.col("capture") == after).select(*keys, *[F.col(c).cast("string").alias(f"__b_{c}")
                                                              for c in columns])
    j = a.join(b, list(keys), "full_outer")
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"__a_{c}").alias("value_before"),
                      F.col(f"__b_{c}").alias("value_after")) for c in columns]
    return j.select(*keys, F.inline(F.array(*pairs))).where(distinct_from("value_before", "value_after"))


def superseded_captures(rows: DataFrame, keys: Sequence[str], capture: Sequence[str],
                        order: Sequence[str]) -> DataFrame:
    """D-15: captures that win no key — every row they hold is beaten by a
    later capture — listed as candidates for retirement.  One latest-wins
    pass over narrow columns, then an anti join of the (small) capture
    list against the winning captures."""
    narrow = rows.select(*keys, *dict.fromkeys([*order, *capture]))
    won = latest_per_key(narrow, keys, list(order)).select(*capture).distinct()
    return rows.select(*capture).distinct().join(won, list(capture), "left_anti")
