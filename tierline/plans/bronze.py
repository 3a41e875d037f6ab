"""Bronze: decode landed envelopes by header name, type them, keep the
latest capture of every natural key.  No joins, no filters, no renames
beyond lower-casing.

Latest capture wins *globally* per natural key (not per partition); a
restated capture is an upsert, so rows absent from it survive.  Ties on the
capture stamp fall back to the partition columns and then the full row, so
the winner never depends on file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import CONTRACTS, DEFAULT_ENDPOINT, DEFAULT_SOURCE, NATURAL_KEYS, PARTITIONS
from tierline.functions.columns import stamp_to_timestamp
from tierline.operators.decode import decode_envelope, envelope_parts
from tierline.operators.latest import latest_per_key
from tierline.sources.landing import complete_captures, read_envelopes


CAPTURE_ORDER = ["captured_at", "capture", "season", "season_type", "source_file"]


def decoded(envelopes: DataFrame, grain: str, strict: bool = True,
            contract: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every landed row decoded (before dedup), with capture provenance."""
    parts = envelope_parts(envelopes.where(F.col("grain") == grain))
    carry = [*PARTITIONS, "source_file"]
    out = decode_envelope(parts, contract or CONTRACTS[grain], carry=carry, strict=strict, where="source_file")
    return out.withColumn("captured_at", stamp_to_timestamp("capture"))


def bronze_order(contract: list[tuple[str, str]], keys: list[str]) -> list[str | tuple[str, bool]]:
    """The whole ordering of bronze winners, for refresh and merge alike."""
    return [*CAPTURE_ORDER, *[(n.lower(), False) for n, _ in contract if n.lower() not in keys]]


def bronze(envelopes: DataFrame, grain: str, strict: bool = True, contract: list[tuple[str, str]] | None = None,
           keys: list[str] | None = None, provenance: bool = False) -> DataFrame:
    """Model: one row per natural key, the contract columns (32 player / 29
    team by default) plus ``captured_at``.  Latest capture wins; a tie on the
    capture (same stamp, or one key twice inside one capture) falls to the
    partition columns and then to the row's own values, ascending.
    ``provenance`` adds the other ordering columns, which a later merge needs
    to pick the same winner as a full refresh."""
    contract = contract or CONTRACTS[grain]
    rows = decoded(envelopes, grain, strict, contract)
    keys = keys or NATURAL_KEYS[grain]
    winners = latest_per_key(rows, keys, bronze_order(contract, keys))
    return winners.select(*[n.lower() for n, _ in contract], *(CAPTURE_ORDER if provenance else CAPTURE_ORDER[:1]))


def landed_envelopes(spark: SparkSession, root: str, source: str = DEFAULT_SOURCE,
                     endpoint: str = DEFAULT_ENDPOINT, grain: str | None = None,
                     require_manifest: bool = True) -> DataFrame:
    env = read_envelopes(spark, root, source, endpoint, grain)
    if require_manifest:
        from tierline.plans.landing import landed_partitions

        env = complete_captures(env, landed_partitions(spark, root, source, endpoint))
    return env


def bronze_player(spark: SparkSession, root: str, **kw) -> DataFrame:
    return bronze(landed_envelopes(spark, root, grain="player", **kw), "player")


def bronze_team(spark: SparkSession, root: str, **kw) -> DataFrame:
    return bronze(landed_envelopes(spark, root, grain="team", **kw), "team")
