"""Scans of the landing tree.

Layout: ``<root>/<source>/<endpoint>/season=…/grain=…/season_type=…/capture=…/``
holding ``payload.json`` (or Spark-written ``part-*.json``) and
``manifest.json``.  ``_runs/`` and ``_error_cases/`` start with ``_`` and are
skipped by Spark's file listing, so they never enter a payload scan.
Schemas are explicit; partition columns are declared as strings so
``season=2019`` can never become an integer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import ENVELOPE, MANIFEST, PARTITIONS, RUN_MANIFEST, SEED
from tierline.sinks import storage

PAYLOAD_FILES = "{payload.json,part-*.json}"


def _has_metadata(df: DataFrame) -> bool:
    """File scans expose the hidden ``_metadata`` column; an empty local
    frame (nothing landed yet) does not."""
    try:
        df.select("_metadata.file_path")
        return True
    except Exception:  # noqa: BLE001
        return False


def endpoint_root(root: str, source: str, endpoint: str) -> str:
    return f"{root.rstrip('/')}/{source}/{endpoint}"


def _json(spark: SparkSession, schema, path: str, **options) -> DataFrame:
    """JSON scan that yields an empty frame (same schema) when nothing has
    landed yet, instead of failing on a glob without matches."""
    from pyspark.errors import AnalysisException

    r = spark.read.schema(schema).option("mode", "FAILFAST")
    for k, v in options.items():
        r = r.option(k, v)
    try:
        return r.json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    return storage.exists(spark, path)


def _glob(base: str, grain: str | None) -> str:
    return f"{base}/season=*/grain={grain or '*'}/season_type=*/capture=*/"


def read_envelopes(spark: SparkSession, root: str, source: str, endpoint: str,
                   grain: str | None = None) -> DataFrame:
    """One row per landed payload file, with partition columns and the
    file path.  ``grain`` selects one grain by path (pruned at listing)."""
    base = endpoint_root(root, source, endpoint)
    df = _json(spark, ENVELOPE, _glob(base, grain), basePath=base, pathGlobFilter=PAYLOAD_FILES)
    return df.withColumn("source_file", F.col("_metadata.file_path") if _has_metadata(df)
                         else F.lit(None).cast("string"))


def read_manifests(spark: SparkSession, root: str, source: str, endpoint: str,
                   grain: str | None = None) -> DataFrame:
    base = endpoint_root(root, source, endpoint)
    df = _json(spark, MANIFEST, _glob(base, grain), basePath=base, pathGlobFilter="manifest.json")
    return df.withColumn("manifest_file", F.col("_metadata.file_path") if _has_metadata(df)
                         else F.lit(None).cast("string"))


def complete_captures(envelopes: DataFrame, manifests: DataFrame) -> DataFrame:
    """Payloads whose capture directory also holds a manifest (the manifest
    is written last, so it marks the capture complete).  An orphan payload
    is excluded instead of being ingested."""
    keys = manifests.select(*PARTITIONS).distinct()
    return envelopes.join(keys, PARTITIONS, "left_semi")


def orphan_payloads(envelopes: DataFrame, manifests: DataFrame) -> DataFrame:
    keys = manifests.select(*PARTITIONS).distinct()
    return envelopes.join(keys, PARTITIONS, "left_anti").select(*PARTITIONS, "source_file")


def read_run_manifests(spark: SparkSession, root: str, source: str, endpoint: str) -> DataFrame:
    """``_runs/run=<stamp>/run_manifest.json`` — an explicit path under an
    underscore directory is readable even though listings skip it."""
    base = endpoint_root(root, source, endpoint)
    return (spark.read.schema(RUN_MANIFEST).option("mode", "FAILFAST")
            .json(f"{base}/_runs/run=*/run_manifest.json")
            .withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), r"run=([^/]+)", 1)))


def run_calls(runs: DataFrame) -> DataFrame:
    return runs.select("run", "source", "endpoint", F.inline("calls"))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEED).option("header", True).option("mode", "FAILFAST").csv(path)


def payload_digests(spark: SparkSession, root: str, source: str, endpoint: str) -> DataFrame:
    """sha256 and byte length of every payload file, computed on executors
    from the raw bytes (``binaryFile``), keyed by partition columns.  A
    filter on those columns prunes the folders that are read."""
    base = endpoint_root(root, source, endpoint)
    raw = (spark.read.format("binaryFile").option("basePath", base).option("pathGlobFilter", PAYLOAD_FILES)
           .load(_glob(base, None)))
    return raw.select(*[F.col(p).cast("string").alias(p) for p in PARTITIONS],
                      F.col("path").alias("source_file"), F.sha2("content", 256).alias("sha256"),
                      F.col("length").alias("bytes"))
