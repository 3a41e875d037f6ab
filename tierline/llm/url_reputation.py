"""URL filter by empirical-Bayes host reputation (operator 11), in DataFrame
operations only.

A list of rules judges the pages it fits.  A host that lies under the host of
some rule is covered by the list: its pages that a rule blocks are bad
outcomes, its other pages good ones.  Hosts no rule speaks of have no
outcomes.  Bad rates are shrunk down the levels global, suffix, registered
domain and host: at each level the prior is a beta distribution around the
mean of the level above, whose weight is fitted to the spread of the groups
(beta-binomial moments).  A page that no rule fits is blocked when the host's
bad rate exceeds ``limit`` with posterior probability ``confidence``.

Host counts are combined before the shuffle.  Lookups by host, domain and
suffix meet keys that hold a large share of all rows: those (at most
``1 / HEAVY`` of them, by their counts) are joined from a broadcast, the
others by an ordinary join.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import staged

#: The rules of the contract, (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]

#: Second-level labels under which country suffixes register names.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "ne", "net", "or", "org"]

#: A key with more than this share of the rows is heavy, so at most 100 keys are.
HEAVY = 0.01

#: Weights of a prior, in pages, that the moments may give.
LEAST, MOST = 2.0, 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://`` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _under(host: Column, name: str) -> Column:
    return (host == name) | host.endswith("." + name)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column, Column]:
    """The longest rule that fits, its verdict (both null without one), and
    whether the host is covered.  The list of rules is part of the plan: it is
    given by the caller and does not grow with the pages."""
    rule, verdict, covered = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(False)
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = _under(host, h) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    for h in sorted({h for _, h, _ in rules}):
        covered = covered | _under(host, h)
    return rule, verdict, covered


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, whatever its user part, port
    and final dot.  An address is its own domain, under an empty suffix."""
    name = F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"\.?(:[0-9]*)?$", "")
    suffix = F.regexp_extract(name, rf"(?s)((?:^|(?<=\.))(?:(?:{'|'.join(SECOND_LEVEL)})\.[^.]{{2}}|[^.]*))$", 1)
    own = F.regexp_extract(name, rf"(?s)((?:[^.]+\.)?(?:(?<=\.)(?:{'|'.join(SECOND_LEVEL)})\.[^.]{{2}}|[^.]*))$", 1)
    numeric = name.rlike(r"^[0-9.]*$") | host.contains("[")
    return F.when(numeric, name).otherwise(own), F.when(numeric, "").otherwise(suffix)


def parsed(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    host, path = split_url(F.col("url").cast("string"))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict, covered = rule_columns(F.col("host"), F.col("path"), rules)
    return p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"), covered.alias("covered"))


def lookup(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """``left`` with the columns of ``right`` (one row per ``key``, with the
    number of ``left`` rows it has in ``rows``), null where there is none."""
    big = F.col("rows") > HEAVY * total
    heavy, light = right.where(big).drop("rows"), right.where(~big).drop("rows")
    # at most 1 / HEAVY keys hold more than that share of the rows each
    few = F.broadcast(heavy)
    return (left.join(few, key, "inner")
            .unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, "left")))


def _weight(groups: DataFrame, mean: str) -> float:
    """Weight of the beta prior from the spread of ``bad`` of ``n`` around
    ``n * mean``: its variance is n p q (1 + (n - 1) / (weight + 1))."""
    p = F.col(mean)
    even = p * (1 - p)
    row = groups.where("n > 0").agg(
        F.sum((F.col("bad") - F.col("n") * p) ** 2).alias("s"), F.sum(F.col("n") * even).alias("a"),
        F.sum(F.col("n") * (F.col("n") - 1) * even).alias("b")).first()
    return clamp(row.s, row.a, row.b)


def clamp(s: float | None, a: float | None, b: float | None) -> float:
    """The weight within bounds and in six digits, so that the order in which
    partial sums meet cannot move a verdict."""
    if not b or s <= a:
        return MOST
    return float(f"{min(MOST, max(LEAST, b / (s - a) - 1)):.6g}")


def bad_with(a: Column, b: Column, limit: float, confidence: float) -> Column:
    """Whether a beta(a, b) variable exceeds ``limit`` with at least this
    probability, by the cube-root normal approximation of the incomplete beta
    function."""
    third = 1 / 3
    x, y = (b * limit) ** third, (a * (1 - limit)) ** third
    z = 3 * (x * (1 - 1 / (9 * b)) - y * (1 - 1 / (9 * a))) / F.sqrt(x * x / b + y * y / a)
    return z <= NormalDist().inv_cdf(1 - confidence)


def reputations(p: DataFrame, limit: float = 0.5, confidence: float = 0.95) -> DataFrame:
    """Per host of ``p(host, by_rule, covered)``: ``host, rows, n, bad,
    bad_rate, blocked``, where ``bad_rate`` is the posterior mean."""
    hosts = staged(p.groupBy("host").agg(
        F.count("*").alias("rows"), F.sum(F.col("covered").cast("long")).alias("n"),
        F.sum((F.col("covered") & F.coalesce(F.col("by_rule") == "block", F.lit(False))).cast("long")).alias("bad")), "hosts")
    domain, suffix = levels(F.col("host"))
    hosts = hosts.select("host", "rows", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("rows")]
    domains = staged(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = staged(domains.groupBy("suffix").agg(*sums), "suffixes")
    all_hosts, all_domains = domains.agg(F.sum("rows")).first()[0] or 0, suffixes.agg(F.sum("rows")).first()[0] or 0
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    # one bad and one good page more, so that a list without outcomes gives a rate too
    top = ((bad or 0) + 1) / ((n or 0) + 2)
    suffixes = suffixes.withColumn("top", F.lit(top))
    w = _weight(suffixes, "top")
    suffixes = suffixes.select("suffix", "rows", ((F.col("bad") + w * top) / (F.col("n") + w)).alias("suffix_rate"))
    domains = lookup(domains.withColumnRenamed("rows", "hosts"), suffixes, "suffix", all_domains)
    w = _weight(domains, "suffix_rate")
    domains = domains.select("domain", F.col("hosts").alias("rows"),
                             ((F.col("bad") + w * F.col("suffix_rate")) / (F.col("n") + w)).alias("domain_rate"))
    hosts = lookup(hosts.withColumnRenamed("rows", "pages"), domains, "domain", all_hosts)
    w = _weight(hosts, "domain_rate")
    a, b = F.col("bad") + w * F.col("domain_rate"), F.col("n") - F.col("bad") + w * (1 - F.col("domain_rate"))
    return hosts.select("host", F.col("pages").alias("rows"), "n", "bad", (a / (a + b)).alias("bad_rate"),
                        bad_with(a, b, limit, confidence).alias("blocked"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float = 0.5, confidence: float = 0.95) -> DataFrame:
    """Per row of ``pages(page_id, url)``: ``page_id, host, path, rule,
    verdict``.  A rule fits its host and that host's subdomains when the path
    starts with the rule's; the longest decides.  Without one the verdict is
    that of the host's reputation, ``allow`` where nothing speaks against it.

    A null url and one without ``://`` have an empty host and path.  Repeated
    rows count as often as they stand there, ids may repeat or be null; an
    empty table gives no rows; other columns are ignored."""
    p = parsed(pages, rules)
    hosts = reputations(p, limit, confidence)
    hosts = staged(hosts.where("blocked").select("host", "rows", F.lit("block").alias("by_host")), "blocked-hosts")
    total = p.count()
    ruled, rest = p.where("by_rule is not null"), p.where("by_rule is null")
    columns = ["page_id", "host", "path", "rule"]
    return (ruled.select(*columns, F.col("by_rule").alias("verdict"))
            .unionByName(lookup(rest, hosts, "host", total).select(*columns, F.coalesce("by_host", F.lit("allow")).alias("verdict"))))


def oracle_sql(rules: list[tuple[str, str, str]] = RULES, limit: float = 0.5, confidence: float = 0.95) -> str:
    """The same judgement as one DuckDB statement over ``pages``."""
    under = lambda h: f"(host = '{h}' or ends_with(host, '.{h}'))"
    fits = [(f"{under(h)} and starts_with(path, '{p}')", h + p, v) for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    second, z = "|".join(SECOND_LEVEL), NormalDist().inv_cdf(1 - confidence)

    def weight(table: str, mean: str) -> str:
        return (f"(select case when coalesce(b, 0) = 0 or s <= a then {MOST} else least({MOST}, greatest({LEAST}, b / (s - a) - 1)) end as w from "
                f"(select sum((bad - n * {mean}) ** 2) as s, sum(n * {mean} * (1 - {mean})) as a, "
                f"sum(n * (n - 1) * {mean} * (1 - {mean})) as b from {table} where n > 0))")

    return f"""
with r as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
s as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
p as (select *, case {' '.join(f"when {c} then '{r}'" for c, r, _ in fits)} end as rule,
             case {' '.join(f"when {c} then '{v}'" for c, _, v in fits)} end as by_rule,
             {' or '.join(under(h) for h in sorted({h for _, h, _ in rules}))} as covered from s),
h0 as (select host, count(*) filter (where covered) as n, count(*) filter (where covered and by_rule = 'block') as bad from p group by host),
h1 as (select *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '\\.?(:[0-9]*)?$', '') as name from h0),
h as (select host, n, bad, regexp_matches(name, '^[0-9.]*$') or contains(host, '[') as numeric, name,
             regexp_extract(name, '(?:^|\\.)((?:{second})\\.[^.][^.]|[^.]*)$', 1) as suffix from h1),
hd as (select host, n, bad, case when numeric then '' else suffix end as suffix, case when numeric or name = suffix then name
              else regexp_extract(left(name, length(name) - length(suffix) - 1), '[^.]*$') || '.' || suffix end as domain from h),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from hd group by all),
u as (select suffix, sum(n) as n, sum(bad) as bad from d group by all),
g as (select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) as top from u),
u1 as (select u.*, top from u, g), u2 as (select suffix, (bad + w * top) / (n + w) as rate from u1, {weight('u1', 'top')}),
d1 as (select d.*, u2.rate as sr from d join u2 using (suffix)), d2 as (select domain, (bad + w * sr) / (n + w) as rate from d1, {weight('d1', 'sr')}),
h2 as (select hd.*, d2.rate as dr from hd join d2 using (domain)),
ab as (select host, bad + w * dr as a, n - bad + w * (1 - dr) as b from h2, {weight('h2', 'dr')}),
xy as (select *, (b * {limit}) ** (1.0 / 3) as x, (a * (1 - {limit})) ** (1.0 / 3) as y from ab),
v as (select host, 3 * (x * (1 - 1 / (9 * b)) - y * (1 - 1 / (9 * a))) / sqrt(x * x / b + y * y / a) <= {z!r} as blocked from xy)
select p.page_id, p.host, p.path, p.rule, coalesce(p.by_rule, case when v.blocked then 'block' else 'allow' end) as verdict
from p join v using (host)"""
