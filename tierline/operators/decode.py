"""Column-store envelope decode.

An envelope carries column names once (``headers``) and rows as parallel
string arrays (``rows``).  Decoding resolves each contract column's position
in the row's *own* capture headers **before** the explode, so the generator
carries a handful of INT positions instead of copying the header list onto
every row, then projects cells by name and casts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Contract = Sequence[tuple[str, str]]  # (header name, spark type)


def envelope_parts(envelopes: DataFrame, result_set: int = 0) -> DataFrame:
    """Raw envelope scan → ``headers`` / ``rows`` columns of one result set,
    NULL where the envelope lacks it (``header_drift`` reports that file)."""
    rs = F.get("resultSets", F.lit(result_set))
    other = [c for c in envelopes.columns if c != "resultSets"]
    return envelopes.select(*other, rs["headers"].alias("headers"), rs["rowSet"].alias("rows"))


def explode_positions(envelopes: DataFrame, names: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row per cell array with the 1-based header positions of ``names``
    resolved once per envelope (0 = header absent)."""
    pos = [F.array_position("headers", F.lit(n)).cast("int").alias(f"__pos{i}") for i, n in enumerate(names)]
    return envelopes.select(*carry, F.size("headers").alias("__width"), *pos,
                            F.explode("rows").alias("__cells"))


def _headers_whole(names: Sequence[str], where: Column) -> Column:
    """True, or raises when the envelope's headers lack one of ``names``.  An
    envelope with neither headers nor rows passes: it has nothing to decode."""
    missing = F.array_except(F.array(*[F.lit(n) for n in names]), F.coalesce("headers", F.array().cast("array<string>")))
    bad = (F.size(missing) > 0) & (F.col("headers").isNotNull() | (F.size("rows") > 0))
    return F.when(bad, F.raise_error(F.concat(F.lit("missing header "), F.array_join(missing, ", "),
                                              F.lit(" in capture "), F.coalesce(where, F.lit("?"))))).otherwise(True)


def _row_whole(where: Column) -> Column:
    """True, or raises when a row has another width than its headers."""
    ok = F.size("__cells").eqNullSafe(F.col("__width"))
    return F.when(~ok, F.raise_error(F.concat(F.lit("ragged row in capture "), F.coalesce(where, F.lit("?"))))).otherwise(True)


def decode_envelope(envelopes: DataFrame, contract: Contract, carry: Sequence[str] = (),
                    strict: bool = True, where: str | None = None,
                    lower_names: bool = True) -> DataFrame:
    """Decode ``headers``/``rows`` envelopes into typed columns by header name.

    ``strict``: a missing header or a ragged row raises (naming the capture
    in ``where``) instead of decoding to NULL.  Both tests are filters, so
    they run whatever columns are read, ``count()`` included.  With ANSI mode on (the Spark 4
    default) a cell that does not parse as its contract type raises too.
    """
    names = [n for n, _ in contract]
    where_col = F.col(where).cast("string") if where else F.lit("")
    if strict:
        envelopes = envelopes.where(_headers_whole(names, where_col))
    exploded = explode_positions(envelopes, names, carry)
    if strict:
        exploded = exploded.where(_row_whole(where_col))
    out = []
    for i, (name, typ) in enumerate(contract):
        pos = F.col(f"__pos{i}")
        cell = F.when(pos > 0, F.try_element_at("__cells", pos))
        out.append(cell.cast(typ).alias(name.lower() if lower_names else name))
    return exploded.select(*carry, *out)


def header_drift(envelopes: DataFrame, expected: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row per envelope whose header list drifts from ``expected``:
    missing names, extra names, same set in another order, wrong width.  An
    envelope without the result set counts as one without headers."""
    exp = F.array(*[F.lit(n) for n in expected])
    h = F.coalesce("headers", F.array().cast("array<string>"))
    checked = envelopes.select(
        *carry,
        F.array_except(exp, h).alias("missing"),
        F.array_except(h, exp).alias("extra"),
        F.size(h).alias("width"),
        (h == exp).alias("same_order"),
    )
    return checked.where(
        (F.size("missing") > 0) | (F.size("extra") > 0) | ~F.col("same_order") | (F.col("width") != len(expected))
    )
