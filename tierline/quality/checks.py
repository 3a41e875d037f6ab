"""Singular checks, written once over column-name parameters so that the
box-score models and the driver tables share them.

Functions named ``*_summary`` / comparisons return the whole comparison
(one row per group with a ``violates`` flag); the box-score suite filters
them to violations.  Everything else returns violations only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.functions.columns import distinct_from
from tierline.operators.asof import asof_join
from tierline.quality.core import floor_rows


def _floor(population: DataFrame, label: str, label_col: str, like: DataFrame) -> DataFrame:
    fl = floor_rows(population, label, label_col)
    return fl.select(*[F.col(label_col) if f.name == label_col else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in like.schema.fields])


# ---------------------------------------------------------------- Q-01
def landed_vs_built(raw: DataFrame, built: DataFrame, keys: Sequence[str], order: Sequence[str],
                    group: Sequence[str]) -> DataFrame:
    """Winners re-derived from the raw rows by a plain ``max`` of the ordering
    columns (not by the model's ``latest_per_key``) counted per ``group``,
    full-outer joined with the built table's counts; ``violates`` is a
    null-safe inequality.  A floor row (group NULL, ``floor`` true) appears
    when the raw side is empty."""
    ranked = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *group])])
    landed = raw.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(F.max(ranked).alias("__w")) \
        .groupBy(*[F.col(f"__w.{g}").alias(g) for g in group]).agg(F.count(F.lit(1)).alias("landed_rows"))
    built_n = built.groupBy(*group).agg(F.count(F.lit(1)).alias("built_rows"))
    lt, bt = landed.alias("l"), built_n.alias("b")
    j = lt.join(bt, [F.col(f"l.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group], "full_outer")
    cmp = j.select(*[F.coalesce(F.col(f"l.{g}"), F.col(f"b.{g}")).alias(g) for g in group],
                   F.col("landed_rows"), F.col("built_rows"),
                   distinct_from("landed_rows", "built_rows").alias("violates"),
                   F.lit(False).alias("floor"))
    fl = floor_rows(raw, "x", "__x").select(
        *[F.lit(None).cast(cmp.schema[g].dataType).alias(g) for g in group],
        F.lit(None).cast("bigint").alias("landed_rows"), F.lit(None).cast("bigint").alias("built_rows"),
        F.lit(True).alias("violates"), F.lit(True).alias("floor"))
    return cmp.unionByName(fl)


# ---------------------------------------------------------------- Q-02
def recaptured_keys(df: DataFrame, keys: Sequence[str], capture: str) -> DataFrame:
    """Keys seen in more than one distinct capture, with the latest one."""
    return df.groupBy(*keys).agg(
        F.count_distinct(capture).alias("n_captures"), F.max(capture).alias("latest_capture")
    ).where("n_captures > 1")


def losing_vs_winning(raw: DataFrame, winners: DataFrame, keys: Sequence[str], version: Sequence[str],
                      capture: str, columns: Sequence[str]) -> DataFrame:
    """For recaptured keys only, every (losing version, column) whose value
    differs from the surviving row: (keys…, losing_capture, column_name,
    losing_value, winning_value).  The expensive part is gated on the
    recaptured key set by a semi join."""
    rk = recaptured_keys(raw, keys, capture).select(*keys)
    losers = raw.join(rk, list(keys), "left_semi")
    wcols = list(dict.fromkeys(list(version) + list(columns)))
    w = winners.join(rk, list(keys), "left_semi").select(*keys, *[F.col(c).alias(f"__w_{c}") for c in wcols])
    j = losers.join(w, list(keys))
    is_loser = None
    for c in version:
        d = distinct_from(c, f"__w_{c}")
        is_loser = d if is_loser is None else (is_loser | d)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("losing_value"),
                      F.col(f"__w_{c}").cast("string").alias("winning_value")) for c in columns]
    long = j.where(is_loser).select(*keys, F.col(capture).alias("losing_capture"), F.inline(F.array(*pairs)))
    return long.where(distinct_from("losing_value", "winning_value"))


# ---------------------------------------------------------------- Q-07 / Q-08
def containment(obs: DataFrame, intervals: DataFrame, entity: str, at: str, observed: str,
                interval_value: str, bucket: str | None = "month") -> DataFrame:
    """Per observation: how many intervals of its entity contain it and how
    many of those name the observed value; violates unless both are 1."""
    j = asof_join(obs, intervals, on=[entity], at=at, bucket=bucket)
    g = j.groupBy(*obs.columns).agg(
        F.count("valid_from").alias("containing"),
        F.count_if(F.col(interval_value) == F.col(observed)).alias("agreeing"))
    return g.withColumn("violates", ~((F.col("containing") == 1) & (F.col("agreeing") == 1)))


def change_pins(obs: DataFrame, entity: str, period: str, at: str, value: str) -> DataFrame:
    """Pinned expectations read off the raw observations, independently of
    any interval model: at every change of value inside a period, the last
    date of the old value, the first date of the new one, and — when the
    dates are not adjacent — the day before the change, which must still
    resolve to the old value (``interpolated``).  One pass: each change
    row emits its pins through ``inline``."""
    w = Window.partitionBy(entity, period).orderBy(at)
    b = obs.select(entity, at, value, F.lag(at).over(w).alias("__prev_at"),
                   F.lag(value).over(w).alias("__prev_value"))
    ch = b.where(F.col("__prev_value").isNotNull() & distinct_from(value, "__prev_value"))

    def pin(date, val, kind):
        return F.struct(date.alias("as_of_date"), val.alias("expected_value"), F.lit(kind).alias("kind"))

    pins = F.array_compact(F.array(
        pin(F.col("__prev_at"), F.col("__prev_value"), "observed_before"),
        pin(F.col(at), F.col(value), "observed_after"),
        F.when(F.datediff(at, "__prev_at") > 1,
               pin(F.date_sub(at, 1), F.col("__prev_value"), "interpolated"))))
    return ch.select(entity, F.inline(pins))


def pinned_expectations(pins: DataFrame, intervals: DataFrame, entity: str, at: str, expected: str,
                        interval_value: str, bucket: str | None = "month") -> DataFrame:
    """Each pin must resolve to exactly one interval naming the expected
    value.  Two floors: no pins at all, and no interpolated pin (the rule
    that matters most would go untested), both from one count over the pins."""
    j = asof_join(pins, intervals, on=[entity], at=at, bucket=bucket)
    g = j.groupBy(*pins.columns).agg(
        F.count("valid_from").alias("n_containing"),
        F.count_if(F.col(interval_value) == F.col(expected)).alias("n_agreeing"))
    res = g.withColumn("violates", ~((F.col("n_containing") == 1) & (F.col("n_agreeing") == 1)))
    # Floors count the pins (cheap: observations only), not the joined result.
    counts = pins.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "interpolated").alias("ni"))
    kinds = F.array_compact(F.array(F.when(F.col("n") == 0, F.lit("floor_no_pins")),
                                    F.when(F.col("ni") == 0, F.lit("floor_no_interpolated_pin"))))
    floors = counts.select(F.explode(kinds).alias("kind")).select(
        *[F.col("kind") if f.name == "kind" else (F.lit(True) if f.name == "violates" else
                                                  F.lit(None).cast(f.dataType)).alias(f.name)
          for f in res.schema.fields])
    return res.unionByName(floors)


# ---------------------------------------------------------------- Q-10
def parent_below_children(parent: DataFrame, sums: DataFrame, keys: Sequence[str], p: str, c: str) -> DataFrame:
    """One-sided inequality: parent must be ≥ the child sum.  Inner on
    purpose — presence is the grain sentry's job."""
    return parent.join(sums, list(keys)).where(F.col(p) < F.col(c)).select(*keys, p, c)


# ---------------------------------------------------------------- Q-05
def grain_sentry(parent: DataFrame, child: DataFrame, key: str | Sequence[str], parent_name: str = "parent",
                 child_name: str = "child") -> DataFrame:
    """No silent loss: every parent key has children and every child key a
    parent, and the parent row count equals the distinct child keys.
    Returns (violation, key…)."""
    keys = [key] if isinstance(key, str) else list(key)
    pk = parent.select(*keys)
    ck = child.select(*keys).distinct()
    miss_c = pk.join(ck, keys, "left_anti").select(F.lit(f"missing_in_{child_name}").alias("violation"), *keys)
    miss_p = ck.join(pk, keys, "left_anti").select(F.lit(f"missing_in_{parent_name}").alias("violation"), *keys)
    tagged = pk.select(F.lit(1).alias("__p"), F.lit(0).alias("__c")).unionByName(
        ck.select(F.lit(0).alias("__p"), F.lit(1).alias("__c")))
    counts = tagged.agg(F.sum("__p").alias("np"), F.sum("__c").alias("nc"))
    np_, nc_ = F.coalesce(F.col("np"), F.lit(0)), F.coalesce(F.col("nc"), F.lit(0))
    count_rows = counts.select(F.explode(F.array_compact(F.array(
        F.when(np_ != nc_, F.lit("row_count_mismatch")),
        F.when(np_ == 0, F.lit(f"floor_empty_{parent_name}")),
        F.when(nc_ == 0, F.lit(f"floor_empty_{child_name}")),
    ))).alias("violation"), *[F.lit(None).cast(parent.schema[k].dataType).alias(k) for k in keys])
    return miss_c.unionByName(miss_p).unionByName(count_rows)


# ---------------------------------------------------------------- Q-17
def relationship_summary(rels: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per relationship: child rows and orphan rows (non-null key without a
    parent); violates when orphans exist or the child side is empty."""
    parts = None
    for name, child, fk, parent, pk in rels:
        keys = parent.select(F.col(pk).alias("__pk")).distinct()
        j = child.select(F.col(fk).alias("__fk")).join(keys, F.col("__fk") == F.col("__pk"), "left")
        s = j.agg(F.count(F.lit(1)).alias("child_rows"),
                  F.count_if(F.col("__fk").isNotNull() & F.col("__pk").isNull()).alias("orphan_rows")) \
            .select(F.lit(name).alias("relationship"), "child_rows", "orphan_rows")
        parts = s if parts is None else parts.unionByName(s)
    return parts.withColumn("violates", (F.col("orphan_rows") > 0) | (F.col("child_rows") == 0))


# ---------------------------------------------------------------- Q-15 / Q-16
def duplicate_keys(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    data = df.where(where) if where else df
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


# ---------------------------------------------------------------- Q-14
def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count) in one scan."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols]
    return agg.select(F.lit(table_name).alias("table_name"), F.col("__rows").alias("row_count"),
                      F.inline(F.array(*pairs))).select("table_name", "column_name", "row_count", "null_count")


# ---------------------------------------------------------------- Q-18
def mutually_exclusive_ranges(df: DataFrame, partition: Sequence[str], lower: str, upper: str,
                              zero_length_allowed: bool = True, with_summary: bool = False) -> DataFrame:
    """Closed ranges per partition must not overlap: ``upper < next lower``
    (strict, because the as-of join is closed on both ends) and
    ``lower <= upper`` (``<`` when zero-length ranges are not allowed).
    Returns (kind, partition…, lower, upper, next_lower, n); with
    ``with_summary`` one extra ``ranges_checked`` row carries the count."""
    w = Window.partitionBy(*partition).orderBy(lower, upper)
    x = df.select(*partition, lower, upper, F.lead(lower).over(w).alias(f"next_{lower}"))
    inverted = (F.col(lower) > F.col(upper)) if zero_length_allowed else (F.col(lower) >= F.col(upper))
    kinds = F.array_compact(F.array(F.when(inverted, F.lit("inverted")),
                                    F.when(F.col(upper) >= F.col(f"next_{lower}"), F.lit("overlap"))))
    v = x.select(F.explode(kinds).alias("kind"), *partition, lower, upper, f"next_{lower}",
                 F.lit(1).cast("bigint").alias("n"))
    if not with_summary:
        return v
    summ = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("ranges_checked").alias("kind"),
        *[F.lit(None).cast(v.schema[c].dataType).alias(c) for c in [*partition, lower, upper, f"next_{lower}"]],
        "n")
    return v.unionByName(summ)


# ---------------------------------------------------------------- Q-09
def multi_interval_periods(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The population that proves the interval model did not degenerate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_intervals")).where("n_intervals > 1")


def degeneracy_violations(df: DataFrame, keys: Sequence[str], lower: str, upper: str) -> DataFrame:
    pop = multi_interval_periods(df, keys)
    inv = df.where(F.col(upper) < F.col(lower)).select(F.lit("inverted_range").alias("violation"))
    fl = floor_rows(pop, "no_multi_interval_population")
    return inv.unionByName(fl)


# ---------------------------------------------------------------- Q-03 / Q-24
def id_shape_summary(spark: SparkSession, models: Mapping[str, DataFrame],
                     shapes: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Per expected (model, column, pattern): rows checked, NULL ids, ids not
    matching the pattern.  The expected list drives a left join, so a model
    that produced nothing reports ``rows_checked = 0`` and violates."""
    parts = None
    for model, column, pattern in shapes:
        if model not in models:
            continue
        df = models[model]
        s = df.agg(F.count(F.lit(1)).alias("rows_checked"),
                   F.count_if(F.col(column).isNull()).alias("null_ids"),
                   F.count_if(~F.col(column).rlike(pattern)).alias("bad_shape")) \
            .select(F.lit(model).alias("model_name"), "rows_checked", "null_ids", "bad_shape")
        parts = s if parts is None else parts.unionByName(s)
    expected = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.lit(c).alias("column_name")) for m, c, _ in shapes])))
    j = expected.join(parts, "model_name", "left") if parts is not None else expected.select(
        "*", *[F.lit(None).cast("bigint").alias(c) for c in ("rows_checked", "null_ids", "bad_shape")])
    out = j.select("model_name", "column_name",
                   *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
                     for c in ("rows_checked", "null_ids", "bad_shape")])
    return out.withColumn("violates", (F.col("rows_checked") == 0) | (F.col("null_ids") > 0) | (F.col("bad_shape") > 0))


# ---------------------------------------------------------------- Q-11
def residue_summary(df: DataFrame, group: Sequence[str], column: str, base: float, step: float) -> DataFrame:
    """Rule ``column >= base and (column - base) % step == 0``; NULL is a
    violation.  Returns per group: n_rows, n_violations."""
    bad = F.col(column).isNull() | (F.col(column) < base) | (((F.col(column) - base) % step) != 0)
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_violations"))


def residue_violations(df: DataFrame, column: str, base: float, step: float) -> DataFrame:
    bad = F.col(column).isNull() | (F.col(column) < base) | (((F.col(column) - base) % step) != 0)
    return df.where(bad)


# ---------------------------------------------------------------- Q-12
def pairwise_bound(df: DataFrame, lower: str, upper: str, bounded: str | None = None) -> DataFrame:
    """``lower <= upper``.  The *bounded* column (default ``upper``) being
    non-null beside a NULL bound is also a violation — made shots beside
    missing attempts; the reverse is legal."""
    bounded = bounded or upper
    other = lower if bounded == upper else upper
    return df.where((F.col(upper) < F.col(lower)) | (F.col(bounded).isNotNull() & F.col(other).isNull()))


# ---------------------------------------------------------------- Q-13
def out_of_window(df: DataFrame, date_col: str, months: Sequence[int], minimum: int) -> DataFrame:
    """Inverted corpus property: per year, rows outside the month window;
    violates when fewer than ``minimum`` exist (the property is absent)."""
    m = F.month(date_col)
    g = df.groupBy(F.year(date_col).cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~m.isin(*months)).alias("n_out_of_window"))
    return g.withColumn("violates", F.col("n_out_of_window") < minimum)


# ---------------------------------------------------------------- J-03
def plan_vs_landed(expected: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected partitions split into ``landed`` and ``to_issue``."""
    mark = landed.select(*keys).distinct().withColumn("__landed", F.lit(True))
    j = expected.join(mark, list(keys), "left")
    return j.select(*expected.columns, F.when(F.col("__landed"), F.lit("landed")).otherwise(F.lit("to_issue"))
                    .alias("status"))
