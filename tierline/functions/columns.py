"""Scalar column builders shared by operators, models and checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The capture stamp format of the landing layout (YYYYMMDDTHHMMSSZ).
CAPTURE_STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distinct_from(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality (SQL ``IS DISTINCT FROM``)."""
    return ~_c(a).eqNullSafe(_c(b))


def stamp_to_timestamp(stamp: str | Column) -> Column:
    """Capture stamp text → TIMESTAMP_NTZ, independent of the session zone."""
    return F.to_timestamp_ntz(_c(stamp), F.lit(CAPTURE_STAMP_FORMAT))


def timestamp_to_stamp(ts: str | Column) -> Column:
    return F.date_format(_c(ts), CAPTURE_STAMP_FORMAT)


def code_label(code: str | Column, mapping: Mapping[str, str]) -> Column:
    """Simple CASE without ELSE: unknown codes map to NULL on purpose, so a
    not-null check turns a new code into a red build instead of a guess."""
    expr = None
    for key, label in mapping.items():
        expr = (F.when(_c(code) == F.lit(key), F.lit(label)) if expr is None
                else expr.when(_c(code) == F.lit(key), F.lit(label)))
    return expr if expr is not None else F.lit(None).cast("string")


def numeric_text(v: str | Column) -> Column:
    """Text form used to compare a typed value with its raw cell: numbers are
    normalised through DOUBLE so ``'5'`` and ``'5.0'`` agree; other text
    stays as is."""
    return F.coalesce(_c(v).try_cast("double").cast("string"), _c(v).cast("string"))
