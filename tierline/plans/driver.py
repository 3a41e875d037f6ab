"""The library's operators run over the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
whole tables.  Box-score notions map onto the tables as:

* capture / natural key  → lineitem versions of ``(l_orderkey, l_linenumber)``
  ordered by ``(l_shipdate, l_partkey, l_suppkey)`` (a total order);
* entity / observation   → ``events`` per ``(user_id, day)``, latest by
  ``(ts, event_id)``; affiliation = ``event_type``; season = ISO week;
* parent / child grains  → ``orders`` / ``lineitem``, and order / order×supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.contracts import PARTITIONS, WINDOW_MONTHS
from tierline.functions.columns import code_label, stamp_to_timestamp, timestamp_to_stamp
from tierline.operators.asof import asof_join
from tierline.operators.decode import decode_envelope, envelope_parts, header_drift
from tierline.operators.edits import apply_cell_edit, capture_diff, upsert
from tierline.operators.gaps import consecutive_gaps, observed_span
from tierline.operators.latest import latest_per_key
from tierline.operators.pairs import collapse_pair, pair_violations
from tierline.operators.reconcile import child_sums, reconcile
from tierline.operators.sampling import first_groups, groups_where, keep_groups
from tierline.operators.stints import stints as build_stints
from tierline.plans.gold import season_rankings
from tierline.quality import checks as qc
from tierline.quality.suite import manifest_matches_payload
from tierline.sources.tables import Tables

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_VERSION = ["l_shipdate", "l_partkey", "l_suppkey"]
LINE_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]
MONEY = "decimal(18,2)"

# Lineitem as a column-store contract (header name, type), canonical order.
LINE_CONTRACT = [
    ("L_ORDERKEY", "bigint"), ("L_PARTKEY", "bigint"), ("L_SUPPKEY", "bigint"), ("L_LINENUMBER", "int"),
    ("L_QUANTITY", "double"), ("L_EXTENDEDPRICE", "double"), ("L_DISCOUNT", "double"), ("L_TAX", "double"),
    ("L_RETURNFLAG", "string"), ("L_LINESTATUS", "string"), ("L_SHIPDATE", "timestamp_ntz"),
]


# ---------------------------------------------------------------- inputs
def lineitem_envelopes(li: DataFrame) -> DataFrame:
    """Stand-in landing: lineitem rows packed as column-store envelopes, one
    capture per order stamped with the order's latest ship date, headers
    rotated by that date's day of week so that decoding by position would be
    wrong.  Gives rows in the envelope schema only; decoding is the job's
    work.  Rows travel the shuffle typed and become text after it."""
    names = [n for n, _ in LINE_CONTRACT]
    n = len(names)
    # collect_list gains nothing from a map-side partial aggregate (it keeps every row), so hash-partition by the
    # envelope key first: the same one shuffle, and the collection runs in the reducers instead of a map-side sort.
    grouped = li.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("__cap"),
        F.collect_list(F.struct(*[F.col(x.lower()) for x in names])).alias("__rows"))
    shift = F.dayofweek("__cap") - 1

    def rotate(arr):
        return F.concat(F.slice(arr, shift + 1, F.lit(n) - shift), F.slice(arr, F.lit(1), shift))

    headers = rotate(F.array(*[F.lit(x) for x in names]))
    row_set = F.transform("__rows", lambda r: rotate(F.array(*[r[x.lower()].cast("string") for x in names])))
    return grouped.select(
        F.concat(F.lit("lineitem/order="), F.col("l_orderkey").cast("string")).alias("source_file"),
        F.lit("line").alias("grain"), timestamp_to_stamp("__cap").alias("capture"),
        F.array(F.struct(F.lit("LineItems").alias("name"), headers.alias("headers"), row_set.alias("rowSet")))
        .alias("resultSets"))


def lineitem_landing(li: DataFrame) -> DataFrame:
    """The packed envelopes with the landing's partition columns (season =
    capture year), so the bronze model reads them like landed files."""
    env = lineitem_envelopes(li)
    return env.select("source_file", F.substring("capture", 1, 4).alias("season"), "grain",
                      F.lit("regular").alias("season_type"), "capture", "resultSets")


def line_winners(t: Tables) -> DataFrame:
    return latest_per_key(t.lineitem, LINE_KEYS, LINE_VERSION)


def event_observations(t: Tables) -> DataFrame:
    """One observation per (user, day): the latest event of the day."""
    ev = t.events.select("user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id", "event_type")
    obs = latest_per_key(ev, ["user_id", "day"], ["ts", "event_id"])
    return obs.select("user_id", "day", "event_type", F.trunc("day", "week").alias("season"))


def event_stints(t: Tables) -> DataFrame:
    obs = event_observations(t)
    return build_stints(obs, entity="user_id", value="event_type", period="season", at="day")


def _stint_intervals(t: Tables) -> DataFrame:
    return event_stints(t).select("user_id", F.col("event_type").alias("stint_type"), "valid_from", "valid_to")


# ---------------------------------------------------------------- queries
def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    env = envelope_parts(lineitem_envelopes(t.lineitem))
    out = decode_envelope(env, LINE_CONTRACT, carry=["capture"], where="capture")
    return out.select(*[n.lower() for n, _ in LINE_CONTRACT], stamp_to_timestamp("capture").alias("captured_at"))


def header_drift_q(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    env = envelope_parts(lineitem_envelopes(t.lineitem))
    d = header_drift(env, [n for n, _ in LINE_CONTRACT], carry=["source_file", "capture"])
    return d.select("source_file", "capture", F.size("missing").cast("bigint").alias("n_missing"),
                    F.size("extra").cast("bigint").alias("n_extra"), F.col("width").cast("bigint").alias("width"),
                    "same_order")


def bronze_model(spark: SparkSession, sf: str) -> DataFrame:
    """M-1 over whole lineitem: the bronze model itself — decode by header
    name, latest capture per (l_orderkey, l_linenumber), typed projection."""
    from tierline.plans.bronze import bronze

    env = lineitem_landing(Tables(spark, sf).lineitem)
    return bronze(env, "line", contract=LINE_CONTRACT, keys=LINE_KEYS)


def dup_key_in_capture(spark: SparkSession, sf: str) -> DataFrame:
    """D-08: natural keys present twice inside one capture, found on the
    decoded envelopes before any dedup could hide them."""
    t = Tables(spark, sf)
    env = envelope_parts(lineitem_envelopes(t.lineitem))
    rows = decode_envelope(env, LINE_CONTRACT, carry=["source_file", "capture"], where="source_file")
    return qc.duplicate_keys(rows, ["source_file", "capture", *LINE_KEYS])


def json_unwrap(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events
    return ev.select("event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    return line_winners(Tables(spark, sf))


def latest_tie(spark: SparkSession, sf: str) -> DataFrame:
    """SO-2: one order per customer by the priority text alone.  Many orders
    tie; the remaining columns, greatest first, decide."""
    return latest_per_key(Tables(spark, sf).orders, ["o_custkey"], ["o_orderpriority"])


def landed_vs_built(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    cmp = qc.landed_vs_built(raw=t.lineitem, built=line_winners(t), keys=LINE_KEYS, order=LINE_VERSION,
                             group=["l_returnflag"])
    return cmp


def recaptured_keys(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return qc.recaptured_keys(li, LINE_KEYS, "l_shipdate")


def value_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return qc.losing_vs_winning(t.lineitem, line_winners(t), LINE_KEYS, LINE_VERSION, "l_shipdate",
                                [c for c in LINE_VALUES if c != "l_shipdate"])


def as_of_latest(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type", "value")
    w = latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return w.select("user_id", F.col("ts").alias("latest_ts"), F.col("event_type").alias("latest_event_type"),
                    F.col("value").alias("latest_value"))


def observed_span_q(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return observed_span(t.customer, t.orders, key="c_custkey", obs_key="o_custkey", at="o_orderdate",
                         carry=["c_name"])


def two_sided_collapse(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return collapse_pair(li, ["l_orderkey"], F.col("l_returnflag") == "R", F.col("l_returnflag") == "N",
                         "l_suppkey", a="r", b="n")


def two_sided_check(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    ra, nb = F.col("l_returnflag") == "R", F.col("l_returnflag") == "N"
    collapsed = collapse_pair(li, ["l_orderkey"], ra, nb, "l_suppkey", a="r", b="n")
    return pair_violations(li, collapsed, ["l_orderkey"], ra, nb, "l_suppkey", a="r", b="n")


# Priority digit → label; any other digit stays NULL on purpose.
PRIORITY_LABELS = {"1": "URGENT", "2": "HIGH"}


def prefix_decode(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_orderpriority",
                    code_label(F.substring("o_orderpriority", 1, 1), PRIORITY_LABELS).alias("priority_label"))


def fact_projection(spark: SparkSession, sf: str) -> DataFrame:
    w = line_winners(Tables(spark, sf))
    return w.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extended_price"),
                    F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))


def stints_q(spark: SparkSession, sf: str) -> DataFrame:
    return event_stints(Tables(spark, sf))


def asof_join_q(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    obs = event_observations(t)
    span = obs.groupBy("user_id").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = span.select("user_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    st = event_stints(t).select("user_id", "event_type", "season", "valid_from", "valid_to")
    j = asof_join(cal, st, on=["user_id"], at="day", bucket="week")
    return j.select("user_id", "day", "event_type", "season", "valid_from")


def containment(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    obs = event_observations(t).select("user_id", "day", "event_type")
    return qc.containment(obs, _stint_intervals(t), entity="user_id", at="day", observed="event_type",
                          interval_value="stint_type", bucket="week")


def pinned_dates(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    obs = event_observations(t)
    pins = qc.change_pins(obs, entity="user_id", period="season", at="day", value="event_type")
    return qc.pinned_expectations(pins, _stint_intervals(t), entity="user_id", at="as_of_date",
                                  expected="expected_value", interval_value="stint_type", bucket="week")


RECON_MEASURES = ["l_quantity", "l_extendedprice", "l_tax"]


def reconcile_long(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    parent = child_sums(li, ["l_orderkey"], RECON_MEASURES, MONEY)
    child = child_sums(li, ["l_orderkey", "l_suppkey"], RECON_MEASURES, MONEY)
    return reconcile(parent, child, ["l_orderkey"], RECON_MEASURES, MONEY)


def _order_vs_lines(t: Tables) -> DataFrame:
    parent = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total"))
    child = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("total"))
    return reconcile(parent, child, ["o_orderkey"], ["total"], MONEY, "order_total", "line_total")


def reconcile_violations(spark: SparkSession, sf: str) -> DataFrame:
    cmp = _order_vs_lines(Tables(spark, sf))
    return cmp.where("violates").select("o_orderkey", "order_total", "line_total")


def inequality(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    parent = t.orders.select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("order_total"))
    sums = child_sums(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"],
                      {"line_total": "l_extendedprice"}, MONEY)
    return qc.parent_below_children(parent, sums, ["o_orderkey"], "order_total", "line_total")


def grain_sentry(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return qc.grain_sentry(t.orders.select(F.col("o_orderkey").alias("key")),
                           t.lineitem.select(F.col("l_orderkey").alias("key")), "key",
                           parent_name="orders", child_name="lines").withColumnRenamed("key", "o_orderkey")


def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    rels = [
        ("lineitem.l_partkey->part.p_partkey", t.lineitem, "l_partkey", t.part, "p_partkey"),
        ("lineitem.l_suppkey->supplier.s_suppkey", t.lineitem, "l_suppkey", t.supplier, "s_suppkey"),
        ("supplier.s_nationkey->nation.n_nationkey", t.supplier, "s_nationkey", t.nation, "n_nationkey"),
    ]
    return qc.relationship_summary(rels)


def uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return qc.duplicate_keys(Tables(spark, sf).lineitem, LINE_KEYS)


def not_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    return qc.null_profile(t.customer, "customer").unionByName(qc.null_profile(t.orders, "orders"))


def ranges_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    st = event_stints(Tables(spark, sf))
    return qc.mutually_exclusive_ranges(st, ["user_id"], "valid_from", "valid_to", with_summary=True)


def degeneracy(spark: SparkSession, sf: str) -> DataFrame:
    st = event_stints(Tables(spark, sf))
    return qc.multi_interval_periods(st, ["user_id", "season"])


# Expected identifier shapes per model.
ID_SHAPES = [("customer", "c_name", "^Customer#[0-9]{9}$"), ("supplier", "s_name", "^Supplier#[0-9]{9}$")]


def id_shape(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    models = {name: getattr(t, name) for name, _, _ in ID_SHAPES}
    return qc.id_shape_summary(spark, models, ID_SHAPES)


def residue(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return qc.residue_summary(li, ["l_returnflag"], "l_quantity", base=0, step=5)


def pair_bound(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    j = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey", "left")
    return qc.pairwise_bound(j, lower="o_orderdate", upper="l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")


def out_of_window(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    return qc.out_of_window(o, "o_orderdate", WINDOW_MONTHS, minimum=3)


def whole_group_sample(spark: SparkSession, sf: str, n: int = 100) -> DataFrame:
    t = Tables(spark, sf)
    chosen = first_groups(t.lineitem, "l_orderkey", ["l_shipdate"], n)
    kept = keep_groups({"lineitem": (t.lineitem, "l_orderkey"), "orders": (t.orders, "o_orderkey")},
                       chosen, "l_orderkey")
    return kept["lineitem"]


def groups_where_q(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    keys = groups_where(li, "l_orderkey", F.col("l_returnflag") == "R")
    return li.join(keys.withColumnRenamed("l_orderkey", "__k"), F.col("l_orderkey") == F.col("__k"),
                   "left_semi")


def cell_override(spark: SparkSession, sf: str, orderkey: int = 1, status: str = "X") -> DataFrame:
    o = Tables(spark, sf).orders
    edited, _log = apply_cell_edit(o, F.col("o_orderkey") == orderkey, "o_orderstatus", status,
                                   reason="restatement test data")
    return edited


def capture_diff_q(spark: SparkSession, sf: str) -> DataFrame:
    li = Tables(spark, sf).lineitem
    return capture_diff(li, LINE_KEYS, LINE_VERSION, LINE_VALUES)


# The years a complete landing is expected to hold.
EXPECTED_YEARS = list(range(1993, 2003))


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    expected = t.nation.select("n_nationkey", F.explode(F.array(*[F.lit(y).cast("bigint") for y in EXPECTED_YEARS]))
                               .alias("year"))
    per_cust = t.orders.select("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).distinct()
    landed = per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")) \
        .select(F.col("c_nationkey").alias("n_nationkey"), "year").distinct()
    return qc.plan_vs_landed(expected, landed, ["n_nationkey", "year"])


def existing_captures_q(spark: SparkSession, sf: str) -> DataFrame:
    """J-02 over the packed lineitem landing: complete captures per
    partition and the newest one."""
    from tierline.contracts import PARTITIONS
    from tierline.plans.landing import existing_captures

    landed = lineitem_landing(Tables(spark, sf).lineitem).select(*PARTITIONS).distinct()
    return existing_captures(landed)


def superseded_captures_q(spark: SparkSession, sf: str) -> DataFrame:
    """Captures (ship date and supplier) that are the surviving version of no key."""
    from tierline.plans.landing import superseded_captures

    li = Tables(spark, sf).lineitem
    return superseded_captures(li, LINE_KEYS, ["l_shipdate", "l_suppkey"], LINE_VERSION)


def ordered_captures_q(spark: SparkSession, sf: str) -> DataFrame:
    from tierline.contracts import PARTITIONS
    from tierline.plans.landing import ordered_captures

    return ordered_captures(lineitem_landing(Tables(spark, sf).lineitem).select(*PARTITIONS))


def merge_vs_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """D-02: lineitem up to a ship date published as a layer, everything later
    merged into it in two batches, the table read back.  Equals the latest
    version per key over all rows."""
    import uuid

    from tierline.session import checkpoint_dir
    from tierline.sinks.layers import Layer, TableSpec

    li = Tables(spark, sf).lineitem
    layer = Layer(spark, f"{checkpoint_dir(spark).rstrip('/')}/merge-{uuid.uuid4().hex}")
    late = [F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "2000-01-01")]
    base = li.where((F.col("l_shipdate") < late[0]) | F.col("l_shipdate").isNull())
    change = layer.begin()
    change.put("line", latest_per_key(base, LINE_KEYS, LINE_VERSION), TableSpec(["l_orderkey"], cell="l_orderkey div 10000"))
    change.commit()
    for batch in (li.where((F.col("l_shipdate") >= late[0]) & (F.col("l_shipdate") < late[1])), li.where(F.col("l_shipdate") >= late[1])):
        change = layer.begin()
        change.merge("line", latest_per_key(batch, LINE_KEYS, LINE_VERSION).checkpoint(), LINE_KEYS, LINE_VERSION)
        change.commit()
    return layer.read("line")


def version_diff_q(spark: SparkSession, sf: str) -> DataFrame:
    """J-09 by digests: the oldest version of every line against the newest."""
    from tierline.operators.versions import version_diff

    li = Tables(spark, sf).lineitem
    # the oldest under the order that ``latest_per_key`` completes with all other columns
    oldest = [(c, False) for c in [*LINE_VERSION, *[c for c in li.columns if c not in LINE_KEYS and c not in LINE_VERSION]]]
    return version_diff(latest_per_key(li, LINE_KEYS, oldest), line_winners(Tables(spark, sf)), LINE_KEYS, LINE_VALUES)


def segmented_stints_q(spark: SparkSession, sf: str) -> DataFrame:
    from tierline.operators.stints import segmented_stints

    obs = event_observations(Tables(spark, sf))
    return segmented_stints(obs, entity="user_id", value="event_type", period="season", at="day")


def asof_open_ended(spark: SparkSession, sf: str) -> DataFrame:
    """JN-6 with intervals up to the year 9999: every line beside its
    customer's latest order on the day it shipped."""
    from pyspark.sql import Window

    t = Tables(spark, sf)
    days = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from")).agg(F.min("o_orderkey").alias("latest_order"))
    nxt = F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from"))
    iv = days.withColumn("valid_to", F.coalesce(F.date_sub(nxt, 1), F.to_date(F.lit("9999-12-31"))))
    # both grow with the data; the size of the orders' file tells little of the memory that its rows take in the driver
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day")).join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").hint("merge"), "l_orderkey")
    j = asof_join(lines, iv, on=["o_custkey"], at="day", bucket="dyadic")
    return j.select("l_orderkey", "l_linenumber", "day", "latest_order", F.col("valid_from").alias("since"))


def distributed_rank_q(spark: SparkSession, sf: str) -> DataFrame:
    from tierline.operators.rank import distributed_rank

    o = Tables(spark, sf).orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_totalprice").cast(MONEY).alias("price"))
    r = distributed_rank(o, "year", "price")
    return r.select("o_orderkey", "year", "price", "price_rank", F.round("price_pct_rank", 9).alias("price_pct_rank"),
                    F.round("group_avg", 2).alias("year_avg"), F.round("z_score", 6).alias("z_score"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    ev = Tables(spark, sf).events.select(F.col("ts").cast("date").alias("day"), "ts")
    return consecutive_gaps(ev, ["day"], "ts", split="minute")


def upsert_q(spark: SparkSession, sf: str) -> DataFrame:
    o = Tables(spark, sf).orders
    base = o.withColumn("version", F.lit(1))
    restated = o.where(F.col("o_orderstatus") == "O").withColumn("o_orderstatus", F.lit("F")) \
        .withColumn("version", F.lit(2))
    return upsert(base, restated, ["o_orderkey"], ["version"])


def league_context(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    per_cust = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("rev"), F.count(F.lit(1)).alias("n"))
    per_nation = per_cust.join(t.customer.select("c_custkey", "c_nationkey"),
                               F.col("o_custkey") == F.col("c_custkey")) \
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "year") \
        .agg(F.sum("rev").cast(MONEY).alias("revenue"), F.sum("n").alias("n_orders"))
    ranked = season_rankings(per_nation, "year", "revenue", avg_digits=2, z_digits=6)
    return ranked.select("n_nationkey", "year", "revenue", "n_orders", "revenue_rank", "revenue_pct_rank",
                         "league_avg", "z_score")


def manifest_check(spark: SparkSession, sf: str) -> DataFrame:
    """Q-20 over whole orders and lineitem.  Orders are the payload files of
    their date's capture and lines their rows.  The audit rows stand for an
    earlier state: orders whose key 16 divides had another content, those 23
    divides a longer one, and lines of quantity 50 were not there."""
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.array(F.col("l_linenumber").cast("string"))).alias("rowSet"),
                                                 F.count_if(F.col("l_quantity") != 50).alias("declared"))
    key = F.col("o_orderkey")
    o = (t.orders.join(lines, key == F.col("l_orderkey"), "left")
         .select(F.date_format("o_orderdate", "yyyy").alias("season"), F.lit("order").alias("grain"), F.lit("regular").alias("season_type"),
                 F.date_format("o_orderdate", "yyyyMMdd'T000000Z'").alias("capture"), "rowSet", "declared",
                 F.concat_ws("|", key, "o_custkey").alias("body"),
                 F.when(key % 23 == 0, F.concat_ws("|", key, "o_custkey", F.lit("old"))).when(key % 16 == 0, F.concat_ws("/", key, "o_custkey"))
                 .otherwise(F.concat_ws("|", key, "o_custkey")).alias("earlier")))
    digests = o.select(*PARTITIONS, F.sha2("body", 256).alias("sha256"), F.octet_length("body").alias("bytes"))
    envelopes = o.select(*PARTITIONS, F.array(F.struct("rowSet")).alias("resultSets"))
    audits = o.groupBy(*PARTITIONS).agg(F.sort_array(F.collect_list(F.sha2("earlier", 256))).alias("payload_sha256s"),
                                        F.sum(F.octet_length("earlier")).alias("payload_bytes"),
                                        F.sum(F.coalesce("declared", F.lit(0))).alias("row_count"))
    none = audits.where("false").withColumn("payload_sha256", F.lit(None).cast("string"))
    return manifest_matches_payload(none, digests, envelopes, audits)


QUERIES = {
    "manifest_check": manifest_check,
    "envelope_roundtrip": envelope_roundtrip,
    "header_drift": header_drift_q,
    "bronze_model": bronze_model,
    "dup_key_in_capture": dup_key_in_capture,
    "json_unwrap": json_unwrap,
    "latest_wins": latest_wins,
    "latest_tie": latest_tie,
    "landed_vs_built": landed_vs_built,
    "recaptured_keys": recaptured_keys,
    "value_mismatch": value_mismatch,
    "as_of_latest": as_of_latest,
    "observed_span": observed_span_q,
    "two_sided_collapse": two_sided_collapse,
    "prefix_decode": prefix_decode,
    "fact_projection": fact_projection,
    "stints": stints_q,
    "asof_join": asof_join_q,
    "containment": containment,
    "pinned_dates": pinned_dates,
    "reconcile_long": reconcile_long,
    "reconcile_violations": reconcile_violations,
    "inequality": inequality,
    "grain_sentry": grain_sentry,
    "fk_orphans": fk_orphans,
    "uniqueness": uniqueness,
    "not_null_profile": not_null_profile,
    "ranges_exclusive": ranges_exclusive,
    "degeneracy": degeneracy,
    "id_shape": id_shape,
    "residue": residue,
    "pair_bound": pair_bound,
    "out_of_window": out_of_window,
    "two_sided_check": two_sided_check,
    "whole_group_sample": whole_group_sample,
    "groups_where": groups_where_q,
    "cell_override": cell_override,
    "capture_diff": capture_diff_q,
    "completeness": completeness,
    "run_metrics": run_metrics,
    "superseded_captures": superseded_captures_q,
    "existing_captures": existing_captures_q,
    "upsert": upsert_q,
    "league_context": league_context,
    "ordered_captures": ordered_captures_q,
    "merge_vs_refresh": merge_vs_refresh,
    "version_diff": version_diff_q,
    "segmented_stints": segmented_stints_q,
    "asof_open_ended": asof_open_ended,
    "distributed_rank": distributed_rank_q,
}

