"""As-of interval join: each left row finds the interval(s) of its entity
whose closed range ``[lower, upper]`` contains the left date.

Spark has no native range join, and an equi key alone lets one long-lived
entity multiply every left row by every interval it ever had.  The work is
bounded by bucketing time: each interval is exploded into the calendar
buckets (week / month / year) it touches, each left row into its one bucket,
and the join runs on (entity, bucket) with the range as a residual.  Each
interval appears once per bucket and each left row has one bucket, so the
result is exact — no duplicates, no misses.

``dyadic`` serves intervals of any length, such as open ones that end in the
year 9999.  An interval, as far as it reaches into the days of the left side,
is cut into aligned blocks of 16, 64, 256, … days that cover it, at most six of
a size, so its number of pieces grows with the logarithm of its length.  The
distinct (entity, day) pairs of the left side look up the block of each size
that holds their day; at most one piece of an interval does.  The left rows
then meet what their own (entity, day) found, so an entity with a very large
share of them is spread over its days.  Spark takes the pieces for as few as
the intervals, so that join names the merge: a broadcast would bring every
piece to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = {"week": "1 week", "month": "1 month", "year": "1 year"}


#: Days of a block of one size, as a power of two, per block of the next smaller.
_BITS = 2
#: Days of the smallest block, as a power of two.
_UNIT = 4


def dyadic_pieces(lower: str, upper: str, top: int) -> Column:
    """``array<struct<level, block>>``: the aligned blocks that make up the
    days from ``lower`` to ``upper`` (day numbers), no block inside a larger
    one.  Block ``b`` of level ``k`` starts at day ``b * 4^k``."""
    size = f"pow({1 << _BITS}, k)"
    first, last = f"ceil({lower} / {size})", f"floor(({upper} + 1) / {size}) - 1"
    up_first, up_last = f"ceil({lower} / ({size} * {1 << _BITS}))", f"floor(({upper} + 1) / ({size} * {1 << _BITS})) - 1"
    run = lambda a, b: f"if({a} <= {b}, sequence(cast({a} as bigint), cast({b} as bigint)), cast(array() as array<bigint>))"
    whole = f"k = {top} or {up_last} < {up_first}"
    blocks = (f"if({whole}, {run(first, last)}, concat({run(first, f'({up_first}) * {1 << _BITS} - 1')}, "
              f"{run(f'({up_last} + 1) * {1 << _BITS}', last)}))")
    return F.expr(f"flatten(transform(sequence(0, {top}), k -> transform({blocks}, b -> struct(k as level, b as block))))")


def _dyadic(left: DataFrame, iv: DataFrame, keys: list[str], at: str, lower: str, upper: str) -> tuple[DataFrame, list[Column]]:
    """For the distinct keys and days of ``left``, the intervals that touch
    the day; with the condition by which left rows meet them."""
    iv = iv.where(F.col(f"__r_{lower}") <= F.col(f"__r_{upper}"))
    day = F.unix_date(F.col(f"__l_{at}").cast("date"))
    ends = left.agg(F.min(day), F.max(day)).first()
    first, last = (0, -1) if ends[0] is None else ends
    lo = F.greatest(F.unix_date(F.col(f"__r_{lower}").cast("date")), F.lit(first))
    hi = F.least(F.unix_date(F.col(f"__r_{upper}").cast("date")), F.lit(last))
    units = (last >> _UNIT) - (first >> _UNIT) + 1
    top = max(0, (units.bit_length() + _BITS - 1) // _BITS)
    cut = iv.withColumns({"__lo": lo, "__hi": hi}).where("__lo <= __hi")
    cut = cut.withColumns({"__ulo": F.shiftright("__lo", _UNIT), "__uhi": F.shiftright("__hi", _UNIT)})
    cut = cut.withColumn("__piece", F.explode(dyadic_pieces("__ulo", "__uhi", top))).drop("__ulo", "__uhi")
    probes = left.select(*[F.col(f"__l_{k}").alias(f"__p_{k}") for k in keys], day.alias("__p_day")).where("__p_day is not null").distinct()
    probes = probes.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    block = F.floor(F.shiftright("__p_day", _UNIT) / F.pow(F.lit(1 << _BITS), F.col("__level")))
    # the blocks at an interval's ends reach beyond it
    met = cut.hint("merge").join(probes.hint("merge"), [
        *[F.col(f"__r_{k}") == F.col(f"__p_{k}") for k in keys], F.col("__piece.level") == F.col("__level"), F.col("__piece.block") == block,
        F.col("__p_day").between(F.col("__lo"), F.col("__hi"))])
    return met.drop("__piece", "__level", "__lo", "__hi", *[f"__r_{k}" for k in keys]), [*[F.col(f"__l_{k}") == F.col(f"__p_{k}") for k in keys], day == F.col("__p_day")]


def asof_join(left: DataFrame, intervals: DataFrame, on: Sequence[str], at: str,
              lower: str = "valid_from", upper: str = "valid_to", how: str = "left",
              bucket: str | None = "month", extra_keys: Sequence[str] = ()) -> DataFrame:
    """``left`` ⋈ ``intervals`` on ``on`` (+ ``extra_keys``) and
    ``left.at between lower and upper``.  Interval columns other than the
    keys are appended; with ``how='left'`` unmatched rows keep NULLs.
    Columns are addressed by (prefixed) name only, so both inputs may share
    lineage (checkpoints, self-joins) without ambiguity."""
    keys = list(on) + list(extra_keys)
    iv_cols = [c for c in intervals.columns if c not in keys]
    iv = intervals.select(*[F.col(c).alias(f"__r_{c}") for c in intervals.columns])
    lft = left.select(*[F.col(c).alias(f"__l_{c}") for c in left.columns])
    cond = [F.col(f"__l_{k}") == F.col(f"__r_{k}") for k in keys]
    if bucket == "dyadic":
        iv, cond = _dyadic(lft, iv, keys, at, lower, upper)
    elif bucket:
        if bucket not in _STEP:
            raise ValueError(f"bucket must be one of {sorted([*_STEP, 'dyadic'])}")
        # an inverted interval holds no value; its buckets would be an error
        iv = iv.where(F.col(f"__r_{lower}") <= F.col(f"__r_{upper}")).withColumn("__r_bucket", F.explode(F.sequence(
            F.trunc(F.col(f"__r_{lower}"), bucket), F.trunc(F.col(f"__r_{upper}"), bucket),
            F.expr(f"interval {_STEP[bucket]}"))))
        lft = lft.withColumn("__l_bucket", F.trunc(F.col(f"__l_{at}").cast("date"), bucket))
        cond.append(F.col("__l_bucket") == F.col("__r_bucket"))
    cond.append(F.col(f"__l_{at}").between(F.col(f"__r_{lower}"), F.col(f"__r_{upper}")))
    joined = lft.join(iv, cond, how)
    return joined.select(*[F.col(f"__l_{c}").alias(c) for c in left.columns],
                         *[F.col(f"__r_{c}").alias(c) for c in iv_cols])
