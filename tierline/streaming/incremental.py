"""Incremental bronze (declared in the reference as the nightly-increment
and restatement roadmap, not built there).

* ``stream_envelopes`` — file-source Structured Streaming over the landing
  tree with the explicit envelope schema; new capture files are picked up
  exactly once (the stream checkpoint tracks seen files).
* ``upsert_bronze`` — ``foreachBatch`` sink: decode the micro-batch, merge
  it by latest-capture-wins with the published bronze rows in the files that
  may hold its games, and commit the result as the layer's next version.
  State lives in the table, not in the stream, so it does not grow with every
  key ever seen; rows absent from a restated capture survive (upsert, never
  delete).
  A file stream sees a payload as soon as it lands, so there is no manifest
  gate here: landers must publish the payload last.  (``land_captures``
  appends its audit rows after the payloads, so a stream may read a capture
  whose audit row is still to come.)
* ``streaming_latest`` — the stateful alternative: latest-wins as a
  streaming aggregation in update mode.  Its state holds one row per key
  forever; use it only where the key space is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierline.contracts import CONTRACTS, DEFAULT_ENDPOINT, DEFAULT_SOURCE, ENVELOPE, NATURAL_KEYS
from tierline.plans.bronze import bronze as bronze_model
from tierline.plans.bronze import bronze_order
from tierline.plans.build import SPECS
from tierline.sinks.layers import Layer, MergeReport
from tierline.sources.landing import PAYLOAD_FILES, endpoint_root


def stream_envelopes(spark: SparkSession, root: str, source: str = DEFAULT_SOURCE,
                     endpoint: str = DEFAULT_ENDPOINT, grain: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    base = endpoint_root(root, source, endpoint)
    r = (spark.readStream.schema(ENVELOPE).option("basePath", base).option("pathGlobFilter", PAYLOAD_FILES)
         .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    glob = f"{base}/season=*/grain={grain or '*'}/season_type=*/capture=*/"
    return r.json(glob).withColumn("source_file", F.col("_metadata.file_path"))


def merge_into_bronze(spark: SparkSession, batch: DataFrame, layer: str, grain: str, stream: str | None = None,
                      epoch: int | None = None, keep: int = 10) -> MergeReport | None:
    """Merge one batch of envelopes into the bronze layer at ``layer``, laid
    out as the build publishes it.  Gives what a full refresh over all captures
    gives, and writes only the files that may hold a game of the batch.

    The merge is one new version of the layer: after a failure at any point
    readers see the version before it or the one after.  The version notes the
    last batch of the stream it holds, so a replayed batch that was committed
    before is left out.  The newest ``keep`` versions stay, so that silver can
    be refreshed from the one it was made from."""
    table, note = f"bronze_{grain}", f"stream {stream}"
    published = Layer(spark, layer)
    done = published.note(note)
    if epoch is not None and done is not None and done >= epoch:
        return None
    new = bronze_model(batch, grain, provenance=True).checkpoint()  # decoded once
    if new.isEmpty():
        return None
    change, keys = published.begin(), NATURAL_KEYS[grain]
    if table in change.entries:
        report = change.merge(table, new, keys, bronze_order(CONTRACTS[grain], keys))
    else:
        change.put(table, new, SPECS[table])
        report = None
    change.commit(**({note: epoch} if epoch is not None else {}))
    published.retire(keep)
    return report


def upsert_bronze(spark: SparkSession, root: str, layer: str, checkpoint: str, grain: str,
                  available_now: bool = True, **kw) -> StreamingQuery:
    """A file stream merged into the bronze layer batch by batch.  The two
    grains are tables of one layer, which has one writer at a time: run their
    streams one after the other, or over layers of their own."""
    stream = stream_envelopes(spark, root, grain=grain, **kw)
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, epoch: merge_into_bronze(spark, df, layer, grain, checkpoint, epoch) and None)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def streaming_latest(decoded: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stateful latest-wins (update mode): max of (order…, rest…) per key."""
    rest = [c for c in decoded.columns if c not in keys and c not in order]
    w = F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("__w")
    return decoded.groupBy(*keys).agg(w).select(*keys, *[F.col(f"__w.{c}").alias(c) for c in [*order, *rest]])


def recent_captures(envelopes: DataFrame, now_stamp: str, days: int) -> DataFrame:
    """Trailing-window re-pull selection: captures within ``days`` of
    ``now_stamp`` (capture stamps are fixed-width UTC text)."""
    from tierline.functions.columns import stamp_to_timestamp

    cutoff = F.timestamp_add("DAY", F.lit(-days), stamp_to_timestamp(F.lit(now_stamp)))
    return envelopes.where(stamp_to_timestamp("capture") >= cutoff)

