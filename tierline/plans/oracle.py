"""Oracle SQL (DuckDB dialect) for every driver query in ``plans.driver``.

Each statement computes the same result as the Spark query, written the
plain way a SQL user would (window ``row_number``, joins with ``between``),
over the pre-registered views of the driver tables.  Column names and types
are aligned with the Spark output: counts BIGINT, money DECIMAL(18,2).
"""

from __future__ import annotations

MONEY = "decimal(18,2)"

W_LINE = """
select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc) as rn
  from lineitem) where rn = 1"""

# Supplier lists of the two flags by order; the orders with one line of either flag, whose lines pair up once;
# and those with two N lines and no R line.
SIDES = """
o as (from (select l_orderkey, l_returnflag as flag, l_suppkey from lineitem) pivot (list(l_suppkey) for flag in ('R' as rs, 'N' as ns) group by l_orderkey)),
pair as (select r.l_orderkey, r.l_suppkey as r_id, n.l_suppkey as n_id from lineitem r join lineitem n using (l_orderkey)
         where r.l_returnflag = 'R' and n.l_returnflag = 'N' qualify count(*) over (partition by r.l_orderkey) = 1),
neutral as (select l_orderkey from o where coalesce(len(rs), 0) = 0 and len(ns) = 2)"""

OBS = """
select user_id, day, event_type, cast(date_trunc('week', day) as date) as season from (
  select user_id, cast(ts as date) as day, event_type,
         row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) as rn
  from events) where rn = 1"""

STINTS = f"""
with obs as ({OBS}),
starts as (
  select o.user_id, o.season, o.event_type, o.day as valid_from
  from obs o
  where o.event_type is distinct from (
    select e.event_type from obs e
    where e.user_id = o.user_id and e.season = o.season and e.day < o.day
    order by e.day desc limit 1)),
periods as (
  select *, min(valid_from) over (partition by user_id, season order by valid_from
                                  rows between 1 following and 1 following) as next_start
  from starts)
select p.user_id, p.event_type, p.season, p.valid_from,
       coalesce(cast(p.next_start - interval 1 day as date), max(o.day)) as valid_to,
       p.valid_from = max(p.valid_from) over (partition by p.user_id) as is_current,
       max(o.day) as last_seen, p.next_start
from periods p
join obs o on o.user_id = p.user_id and o.season = p.season and o.day >= p.valid_from
          and (p.next_start is null or o.day < p.next_start)
group by p.user_id, p.event_type, p.season, p.valid_from, p.next_start"""

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


def _pairs(a: str, b: str, cols: list[str], names: tuple[str, str, str]) -> str:
    items = ", ".join(
        f"{{'{names[0]}': '{c}', '{names[1]}': cast({a}.{c} as varchar), '{names[2]}': cast({b}.{c} as varchar)}}"
        for c in cols)
    return f"unnest([{items}])"


def _value_mismatch() -> str:
    cols = [c for c in LINE_VALUES if c != "l_shipdate"]
    return f"""
with w as ({W_LINE}),
rk as (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(distinct l_shipdate) > 1),
lo as (select l.* from lineitem l join rk using (l_orderkey, l_linenumber)),
p as (select lo.l_orderkey, lo.l_linenumber, lo.l_shipdate as losing_capture,
             {_pairs('lo', 'w', cols, ('column_name', 'losing_value', 'winning_value'))} as s
      from lo join w on lo.l_orderkey = w.l_orderkey and lo.l_linenumber = w.l_linenumber
      where lo.l_shipdate is distinct from w.l_shipdate or lo.l_partkey is distinct from w.l_partkey
         or lo.l_suppkey is distinct from w.l_suppkey)
select l_orderkey, l_linenumber, losing_capture, struct_extract(s, 'column_name') as column_name,
       struct_extract(s, 'losing_value') as losing_value, struct_extract(s, 'winning_value') as winning_value
from p where struct_extract(s, 'losing_value') is distinct from struct_extract(s, 'winning_value')"""


def _capture_diff() -> str:
    k = "partition by l_orderkey, l_linenumber"
    return f"""
with r as (select *,
             row_number() over ({k} order by l_shipdate, l_partkey, l_suppkey) as a,
             row_number() over ({k} order by l_shipdate desc, l_partkey desc, l_suppkey desc) as d,
             count(*) over ({k}) as n
           from lineitem),
o as (select * from r where a = 1 and n > 1),
nw as (select * from r where d = 1 and n > 1),
p as (select o.l_orderkey, o.l_linenumber,
             {_pairs('o', 'nw', LINE_VALUES, ('column_name', 'value_before', 'value_after'))} as s
      from o join nw on o.l_orderkey = nw.l_orderkey and o.l_linenumber = nw.l_linenumber)
select l_orderkey, l_linenumber, struct_extract(s, 'column_name') as column_name,
       struct_extract(s, 'value_before') as value_before, struct_extract(s, 'value_after') as value_after
from p where struct_extract(s, 'value_before') is distinct from struct_extract(s, 'value_after')"""


def _reconcile_long() -> str:
    ms = ["l_quantity", "l_extendedprice", "l_tax"]
    s1 = ", ".join(f"cast(sum(cast({m} as {MONEY})) as {MONEY}) as {m}" for m in ms)
    s2 = ", ".join(f"cast(sum({m}) as {MONEY}) as {m}" for m in ms)
    pj = ", ".join(f"p.{m} as p_{m}, c.{m} as c_{m}" for m in ms)
    branches = "\nunion all ".join(
        f"select l_orderkey, '{m}' as measure, p_{m} as parent_value, c_{m} as child_value, "
        f"p_{m} is distinct from c_{m} as violates from j" for m in ms)
    return f"""
with p as (select l_orderkey, {s1} from lineitem group by 1),
c0 as (select l_orderkey, l_suppkey, {s1} from lineitem group by 1, 2),
c as (select l_orderkey, {s2} from c0 group by 1),
j as (select coalesce(p.l_orderkey, c.l_orderkey) as l_orderkey, {pj}
      from p full outer join c on p.l_orderkey = c.l_orderkey)
{branches}"""


LINE_SUM = f"""select l_orderkey, cast(sum(cast(l_extendedprice as {MONEY})) as {MONEY}) as line_total
               from lineitem group by 1"""


def _null_profile() -> str:
    spec = {
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    }
    parts = [f"select '{t}' as table_name, '{c}' as column_name, count(*) as row_count, "
             f"count(*) - count({c}) as null_count from {t}" for t, cols in spec.items() for c in cols]
    return "\nunion all ".join(parts)


def _fk_orphans() -> str:
    rels = [
        ("lineitem.l_partkey->part.p_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem.l_suppkey->supplier.s_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("supplier.s_nationkey->nation.n_nationkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ]
    parts = [f"""select '{name}' as relationship, count(*) as child_rows,
                 cast(count_if(ch.{fk} is not null and pa.{pk} is null) as bigint) as orphan_rows
                 from {child} ch left join (select distinct {pk} from {parent}) pa on ch.{fk} = pa.{pk}"""
             for name, child, fk, parent, pk in rels]
    return ("select *, (orphan_rows > 0 or child_rows = 0) as violates from (\n"
            + "\nunion all ".join(parts) + ")")


ORACLE = {
    "envelope_roundtrip": f"""
select {', '.join(LINE_COLS)}, max(l_shipdate) over (partition by l_orderkey) as captured_at from lineitem""",
    "manifest_check": """
with o as (select strftime(o_orderdate, '%Y') as season, strftime(o_orderdate, '%Y%m%dT000000Z') as capture, o_orderkey % 23 = 0 as longer,
                  o_orderkey % 16 = 0 as other, exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity = 50) as fewer
           from orders),
v as (select distinct season, capture, unnest(['sha256_mismatch', 'bytes_mismatch', 'row_count_mismatch']) as violation,
             unnest([longer or other, longer, fewer]) as found from o)
select season, 'order' as grain, 'regular' as season_type, capture, violation from v where found""",
    "header_drift": """
select 'lineitem/order=' || l_orderkey as source_file, strftime(max(l_shipdate), '%Y%m%dT%H%M%SZ') as capture, cast(0 as bigint) as n_missing,
       cast(0 as bigint) as n_extra, cast(11 as bigint) as width, false as same_order
from lineitem group by l_orderkey having dayofweek(max(l_shipdate)) <> 0""",
    "bronze_model": f"""
with cap as (select l_orderkey, max(l_shipdate) as captured_at from lineitem group by 1),
r as (select l.*, cap.captured_at,
             row_number() over (partition by l.l_orderkey, l.l_linenumber
                                order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) as rn
      from lineitem l join cap on l.l_orderkey = cap.l_orderkey)
select {', '.join(LINE_COLS)}, captured_at from r where rn = 1""",
    "dup_key_in_capture": """
with cap as (select l_orderkey, strftime(max(l_shipdate), '%Y%m%dT%H%M%SZ') as capture from lineitem group by 1)
select 'lineitem/order=' || l.l_orderkey as source_file, cap.capture, l.l_orderkey, l.l_linenumber,
       count(*) as n_rows
from lineitem l join cap on l.l_orderkey = cap.l_orderkey
group by l.l_orderkey, cap.capture, l.l_linenumber having count(*) > 1""",
    "json_unwrap": "select event_id, user_id, cast(props ->> '$.k' as bigint) as k from events",
    "latest_wins": W_LINE,
    "latest_tie": """
select * exclude (rn) from (
  select *, row_number() over (partition by o_custkey
                               order by o_orderpriority desc nulls last, o_orderkey desc nulls last,
                                        o_orderstatus desc nulls last, o_totalprice desc nulls last,
                                        o_orderdate desc nulls last) as rn
  from orders) where rn = 1""",
    "landed_vs_built": f"""
with w as ({W_LINE}),
l as (select l_returnflag, count(*) as landed_rows from w group by 1),
b as (select l_returnflag, count(*) as built_rows from w group by 1)
select coalesce(l.l_returnflag, b.l_returnflag) as l_returnflag, landed_rows, built_rows,
       landed_rows is distinct from built_rows as violates, false as floor
from l full outer join b on l.l_returnflag is not distinct from b.l_returnflag
union all
select null, null, null, true, true from (select count(*) as n from lineitem) where n = 0""",
    "recaptured_keys": """
select l_orderkey, l_linenumber, count(distinct l_shipdate) as n_captures, max(l_shipdate) as latest_capture
from lineitem group by 1, 2 having count(distinct l_shipdate) > 1""",
    "value_mismatch": _value_mismatch(),
    "as_of_latest": """
select user_id, ts as latest_ts, event_type as latest_event_type, value as latest_value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1""",
    "observed_span": """
select c_custkey, c_name, s.first_observed, s.last_observed, coalesce(s.n, 0) as n_observations
from customer left join (
  select o_custkey, min(cast(o_orderdate as date)) as first_observed, max(cast(o_orderdate as date)) as last_observed,
         count(*) as n
  from orders group by 1) s on c_custkey = s.o_custkey""",
    "two_sided_collapse": f"""
with {SIDES}
select o.l_orderkey, coalesce(len(o.rs), 0) as r_rows, coalesce(len(o.ns), 0) as n_rows,
       z.l_orderkey is not null as is_neutral, p.r_id, p.n_id
from o left join pair p using (l_orderkey) left join neutral z using (l_orderkey)""",
    "prefix_decode": """
select o_orderkey, o_orderpriority,
       case substr(o_orderpriority, 1, 1) when '1' then 'URGENT' when '2' then 'HIGH' end as priority_label
from orders""",
    "fact_projection": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as quantity, l_extendedprice as extended_price,
       l_discount as discount, l_tax as tax from ({W_LINE})""",
    "stints": STINTS,
    "asof_join": f"""
with obs as ({OBS}), st as ({STINTS}),
span as (select user_id, min(day) as lo, max(day) as hi from obs group by 1),
cal as (select user_id, cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day))
                             as date) as day from span)
select cal.user_id, cal.day, st.event_type, st.season, st.valid_from
from cal left join st on cal.user_id = st.user_id and cal.day between st.valid_from and st.valid_to""",
    "containment": f"""
with obs as ({OBS}), st as ({STINTS})
select o.user_id, o.day, o.event_type, count(st.valid_from) as containing,
       cast(count_if(st.event_type = o.event_type) as bigint) as agreeing,
       not (count(st.valid_from) = 1 and count_if(st.event_type = o.event_type) = 1) as violates
from obs o left join st on o.user_id = st.user_id and o.day between st.valid_from and st.valid_to
group by o.user_id, o.day, o.event_type""",
    "pinned_dates": f"""
with obs as ({OBS}), st as ({STINTS}),
b as (select user_id, day, event_type,
             lag(day) over (partition by user_id, season order by day) as prev_at,
             lag(event_type) over (partition by user_id, season order by day) as prev_value
      from obs),
ch as (select * from b where prev_value is not null and event_type is distinct from prev_value),
pins as (select user_id, prev_at as as_of_date, prev_value as expected_value, 'observed_before' as kind from ch
         union all select user_id, day, event_type, 'observed_after' from ch
         union all select user_id, cast(day - interval 1 day as date), prev_value, 'interpolated' from ch
                   where day - prev_at > 1),
res as (select p.user_id, p.as_of_date, p.expected_value, p.kind, count(st.valid_from) as n_containing,
               cast(count_if(st.event_type = p.expected_value) as bigint) as n_agreeing
        from pins p left join st on p.user_id = st.user_id and p.as_of_date between st.valid_from and st.valid_to
        group by p.user_id, p.as_of_date, p.expected_value, p.kind)
select *, not (n_containing = 1 and n_agreeing = 1) as violates from res
union all select null, null, null, 'floor_no_pins', null, null, true
          from (select count(*) as n from pins) where n = 0
union all select null, null, null, 'floor_no_interpolated_pin', null, null, true
          from (select count(*) as n from pins where kind = 'interpolated') where n = 0""",
    "reconcile_long": _reconcile_long(),
    "reconcile_violations": f"""
with s as ({LINE_SUM})
select coalesce(o.o_orderkey, s.l_orderkey) as o_orderkey, cast(o.o_totalprice as {MONEY}) as order_total,
       s.line_total
from orders o full outer join s on o.o_orderkey = s.l_orderkey
where cast(o.o_totalprice as {MONEY}) is distinct from s.line_total""",
    "inequality": f"""
with s as ({LINE_SUM})
select o_orderkey, cast(o_totalprice as {MONEY}) as order_total, s.line_total
from orders join s on o_orderkey = s.l_orderkey where cast(o_totalprice as {MONEY}) < s.line_total""",
    "grain_sentry": """
with pk as (select o_orderkey as k from orders), ck as (select distinct l_orderkey as k from lineitem)
select 'missing_in_lines' as violation, pk.k as o_orderkey from pk anti join ck on pk.k = ck.k
union all select 'missing_in_orders', ck.k from ck anti join pk on ck.k = pk.k
union all select 'row_count_mismatch', null
          from (select (select count(*) from pk) as np, (select count(*) from ck) as nc) where np <> nc
union all select 'floor_empty_orders', null from (select count(*) as n from pk) where n = 0
union all select 'floor_empty_lines', null from (select count(*) as n from ck) where n = 0""",
    "fk_orphans": _fk_orphans(),
    "uniqueness": """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1""",
    "not_null_profile": _null_profile(),
    "ranges_exclusive": f"""
with st as ({STINTS}),
x as (select user_id, valid_from, valid_to,
             lead(valid_from) over (partition by user_id order by valid_from, valid_to) as next_valid_from
      from st)
select 'inverted' as kind, user_id, valid_from, valid_to, next_valid_from, cast(1 as bigint) as n
from x where valid_from > valid_to
union all select 'overlap', user_id, valid_from, valid_to, next_valid_from, 1 from x where valid_to >= next_valid_from
union all select 'ranges_checked', null, null, null, null, count(*) from st""",
    "degeneracy": f"""
with st as ({STINTS})
select user_id, season, count(*) as n_intervals from st group by 1, 2 having count(*) > 1""",
    "id_shape": """
with e as (select * from (values ('customer', 'c_name'), ('supplier', 's_name')) t(model_name, column_name)),
s as (select 'customer' as model_name, count(*) as rows_checked, cast(count_if(c_name is null) as bigint) as null_ids,
             cast(count_if(not regexp_matches(c_name, '^Customer#[0-9]{9}$')) as bigint) as bad_shape from customer
      union all
      select 'supplier', count(*), cast(count_if(s_name is null) as bigint),
             cast(count_if(not regexp_matches(s_name, '^Supplier#[0-9]{9}$')) as bigint) from supplier)
select e.model_name, e.column_name, coalesce(rows_checked, 0) as rows_checked, coalesce(null_ids, 0) as null_ids,
       coalesce(bad_shape, 0) as bad_shape,
       (coalesce(rows_checked, 0) = 0 or coalesce(null_ids, 0) > 0 or coalesce(bad_shape, 0) > 0) as violates
from e left join s on e.model_name = s.model_name""",
    "residue": """
select l_returnflag, count(*) as n_rows,
       cast(count_if(l_quantity is null or l_quantity < 0 or (l_quantity - 0) % 5 <> 0) as bigint) as n_violations
from lineitem group by 1""",
    "pair_bound": """
select l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate
from lineitem l left join orders o on l.l_orderkey = o.o_orderkey
where l.l_shipdate < o.o_orderdate or (l.l_shipdate is not null and o.o_orderdate is null)""",
    "out_of_window": """
select cast(year(o_orderdate) as bigint) as year, count(*) as n_rows,
       cast(count_if(month(o_orderdate) not in (10, 11, 12, 1, 2, 3, 4)) as bigint) as n_out_of_window,
       count_if(month(o_orderdate) not in (10, 11, 12, 1, 2, 3, 4)) < 3 as violates
from orders group by 1""",
    "two_sided_check": f"""
with {SIDES}
select l_orderkey, 'group_rows_not_two' as violation from lineitem group by l_orderkey having count(*) <> 2
union all select l_orderkey, unnest(['sided_not_one_and_one', 'ids_null_iff_neutral'])
          from o anti join pair using (l_orderkey) anti join neutral using (l_orderkey)
union all select l_orderkey, 'same_id_both_sides' from pair where r_id = n_id
union all select null, 'floor_nothing_compared' where not exists (from lineitem)""",
    "whole_group_sample": """
select * from lineitem where l_orderkey in (
  select l_orderkey from lineitem group by l_orderkey order by min(l_shipdate), l_orderkey limit 100)""",
    "groups_where": """
select * from lineitem where l_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""",
    "cell_override": """
select o_orderkey, o_custkey, case when o_orderkey = 1 then 'X' else o_orderstatus end as o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority from orders""",
    "capture_diff": _capture_diff(),
    "completeness": """
with e as (select n_nationkey, cast(unnest(range(1993, 2003)) as bigint) as year from nation),
l as (select distinct c.c_nationkey as n_nationkey, cast(year(o.o_orderdate) as bigint) as year
      from orders o join customer c on o.o_custkey = c.c_custkey)
select e.n_nationkey, e.year, case when l.n_nationkey is not null then 'landed' else 'to_issue' end as status
from e left join l on e.n_nationkey = l.n_nationkey and e.year = l.year""",
    "run_metrics": """
select cast(ts as date) as day, count(*) as n_rows, min(ts) as first_ts, max(ts) as last_ts, max(gap) as max_gap_us
from (select ts, epoch_us(ts) - lag(epoch_us(ts)) over (partition by cast(ts as date) order by ts) as gap
      from events) group by 1""",
    "existing_captures": """
select substr(cap, 1, 4) as season, 'line' as grain, 'regular' as season_type, count(distinct cap) as n_captures,
       max(cap) as latest_capture
from (select strftime(max(l_shipdate), '%Y%m%dT%H%M%SZ') as cap from lineitem group by l_orderkey) group by 1""",
    "superseded_captures": f"""
select distinct l_shipdate, l_suppkey from lineitem except select l_shipdate, l_suppkey from ({W_LINE})""",
    "ordered_captures": """
select substr(cap, 1, 4) as season, 'line' as grain, 'regular' as season_type, string_agg(distinct cap, ',' order by cap) as captures
from (select strftime(max(l_shipdate), '%Y%m%dT%H%M%SZ') as cap from lineitem group by l_orderkey) group by 1""",
    "merge_vs_refresh": W_LINE,
    "version_diff": _capture_diff(),
    "segmented_stints": STINTS,
    "asof_open_ended": """
with iv as (select o_orderkey, o_custkey, o_orderdate as valid_from,
                   coalesce(lead(o_orderdate) over (partition by o_custkey order by o_orderdate) - interval 1 day, date '9999-12-31') as valid_to
            from (select o_custkey, o_orderdate, min(o_orderkey) as o_orderkey from (select o_custkey, o_orderkey, cast(o_orderdate as date) as o_orderdate from orders)
                  group by all))
select l.l_orderkey, l.l_linenumber, cast(l.l_shipdate as date) as day, iv.o_orderkey as latest_order, cast(iv.valid_from as date) as since
from lineitem l join orders o on o.o_orderkey = l.l_orderkey
left join iv on iv.o_custkey = o.o_custkey and cast(l.l_shipdate as date) between iv.valid_from and iv.valid_to""",
    "distributed_rank": f"""
with x as (select o_orderkey, cast(year(o_orderdate) as bigint) as year, cast(o_totalprice as {MONEY}) as price from orders)
select o_orderkey, year, price, cast(rank() over w as bigint) as price_rank, round(percent_rank() over w, 9) as price_pct_rank,
       round(avg(cast(price as double)) over y, 2) as year_avg,
       round((cast(price as double) - avg(cast(price as double)) over y) / stddev_pop(cast(price as double)) over y, 6) as z_score
from x window w as (partition by year order by price desc), y as (partition by year)""",
    "upsert": """
with u as (select *, 1 as version from orders
           union all
           select o_orderkey, o_custkey, 'F', o_totalprice, o_orderdate, o_orderpriority, 2 from orders
           where o_orderstatus = 'O')
select * exclude (rn) from (select *, row_number() over (partition by o_orderkey order by version desc) as rn from u)
where rn = 1""",
    "league_context": f"""
with pc as (select o_custkey, cast(year(o_orderdate) as bigint) as year, sum(cast(o_totalprice as {MONEY})) as rev,
                   count(*) as n from orders group by 1, 2),
pn as (select c.c_nationkey as n_nationkey, year, cast(sum(rev) as {MONEY}) as revenue,
              cast(sum(n) as bigint) as n_orders
       from pc join customer c on pc.o_custkey = c.c_custkey group by 1, 2)
select n_nationkey, year, revenue, n_orders,
       cast(rank() over (partition by year order by revenue desc) as bigint) as revenue_rank,
       percent_rank() over (partition by year order by revenue desc) as revenue_pct_rank,
       round(avg(cast(revenue as double)) over (partition by year), 2) as league_avg,
       round((cast(revenue as double) - avg(cast(revenue as double)) over (partition by year))
             / stddev_pop(cast(revenue as double)) over (partition by year), 6) as z_score
from pn""",
}
