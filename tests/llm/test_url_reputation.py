"""Host reputations against plain Python and a numeric beta integral."""

import math
import random
import re

import numpy as np
import pytest

from tests import parity
from tierline.llm import url_reputation as U

URLS = ["http://A.Example.COM/en/1?x#y", "https://www.example.com/en/2", "http://example.com", "http://example.com/en", "http://com/", "http://notcom/x",
        "http://a.net/es/1", "http://a.net/fr/", "http://a.net/en/1", "http://b.a.net/de/1", "http://x.org/es/1", "x://y://z/es/", "//a.net/es/", "", None,
        "http://a.net?/es/", "http://a.net#/es/", "http://a.net:80/es/1", "http://u:p@a.net/es/1", "http://10.0.0.1/es/1", "http://[::1]:8/x",
        "http://a.co.uk/1", "http://co.uk/1", "http://.net/es/q", "http://é.NET/es/é", "http://a.net\n/es/1", "http://a.net/es/\n?x", "://", "http:///es/"]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3:]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, None)


def test_rules_and_parts(spark):
    rows = [(i, u, "h", "clash") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows + [rows[6], (None, URLS[7], "h", "")], "page_id long, url string, host string, verdict string")
    got = U.judge(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = plain(URLS[7 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert U.judge(pages.limit(0)).count() == 0


def test_levels(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.y.co.uk", "co.uk", "y.co.uk", "10.0.0.1", "u@a.net:8080", "a.net.", "", "[::1]:8", "a.com.br", "com.br"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select("host", *U.levels(df.host)).collect()]
    want = [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("y.co.uk", "co.uk"), ("co.uk", "co.uk"), ("y.co.uk", "co.uk"), ("10.0.0.1", ""),
            ("a.net", "net"), ("a.net", "net"), ("", ""), ("[::1]", ""), ("a.com.br", "com.br"), ("com.br", "com.br")]
    assert [g[1:] for g in got] == want


@pytest.mark.parametrize("a,b", [(0.7, 3.0), (1.5, 1.5), (8, 2), (30, 25), (200, 180), (3, 0.9), (900, 1000)])
def test_beta_bound(spark, a, b):
    """The approximation decides as the integral does, but for a narrow band."""
    t = np.linspace(0, 1, 2_000_001)[1:-1]
    log = (a - 1) * np.log(t) + (b - 1) * np.log1p(-t)
    f = np.exp(log - log.max())
    above = f[t > 0.5].sum() / f.sum()
    df = spark.range(1)
    from pyspark.sql import functions as F
    for c in (0.05, 0.3, 0.5, 0.8, 0.95):
        if abs(above - c) > 0.02:
            assert df.select(U.bad_with(F.lit(float(a)), F.lit(float(b)), 0.5, c)).first()[0] == (above >= c)


def brute(rows, limit=0.5, confidence=0.95):
    """Verdicts by the docstring, over lists."""
    from statistics import NormalDist

    parts = [plain(u) for u in rows]
    hosts = {}
    for host, _, _, verdict in parts:
        h = hosts.setdefault(host, [0, 0])
        if any(host == c or host.endswith("." + c) for c in ("com", "net", "example.com", "www.example.com")):
            h[0] += 1
            h[1] += verdict == "block"
    dom = lambda h: ".".join(h.split(".")[-2:])
    suf = lambda h: h.split(".")[-1]

    def fold(key):
        out = {}
        for h, (n, bad) in hosts.items():
            g = out.setdefault(key(h), [0, 0])
            g[0], g[1] = g[0] + n, g[1] + bad
        return out

    def weight(groups, mean):
        s = a = b = 0.0
        for g, (n, bad) in groups.items():
            p = mean(g)
            if n:
                s, a, b = s + (bad - n * p) ** 2, a + n * p * (1 - p), b + n * (n - 1) * p * (1 - p)
        return 1000.0 if not b or s <= a else min(1000.0, max(2.0, b / (s - a) - 1))

    suffixes, domains = fold(suf), fold(dom)
    top = (sum(b for _, b in hosts.values()) + 1) / (sum(n for n, _ in hosts.values()) + 2)
    w = weight(suffixes, lambda g: top)
    rate_s = {g: (b + w * top) / (n + w) for g, (n, b) in suffixes.items()}
    w = weight(domains, lambda g: rate_s[suf(g)])
    rate_d = {g: (b + w * rate_s[suf(g)]) / (n + w) for g, (n, b) in domains.items()}
    w = weight(hosts, lambda h: rate_d[dom(h)])
    blocked = {}
    for h, (n, bad) in hosts.items():
        a, b = bad + w * rate_d[dom(h)], n - bad + w * (1 - rate_d[dom(h)])
        x, y = (b * limit) ** (1 / 3), (a * (1 - limit)) ** (1 / 3)
        blocked[h] = 3 * (x * (1 - 1 / (9 * b)) - y * (1 - 1 / (9 * a))) / math.sqrt(x * x / b + y * y / a) <= NormalDist().inv_cdf(1 - confidence)
    return [(h, p, r, v or ("block" if blocked[h] else "allow")) for h, p, r, v in parts]


@pytest.fixture(scope="module")
def crawl():
    """One host holds a third of the pages; some hosts are blocked nearly everywhere."""
    rng, urls = random.Random(5), []
    for i in range(3000):
        host = "big.site.net" if i % 3 == 0 else f"h{rng.randrange(8)}.d{rng.randrange(3)}.{rng.choice(['net', 'org', 'com'])}"
        bad = host.startswith(("h1", "h2")) and rng.random() < 0.95
        urls.append(f"http://{host}/{rng.choice(['es', 'fr']) if bad else rng.choice(['en', 'de', 'es'])}/{i}")
    return urls


def test_reputations_against_lists(spark, crawl):
    pages = spark.createDataFrame(list(enumerate(crawl)), "page_id long, url string").repartition(7)
    got = {r.page_id: tuple(r)[1:] for r in U.judge(pages).collect()}
    want = brute(crawl)
    assert len(got) == len(crawl) and [got[i] for i in range(len(crawl))] == want
    verdicts = [(v, r) for _, _, r, v in want]
    assert ("block", None) in verdicts and ("allow", None) in verdicts


def test_oracle(spark, crawl, tmp_path):
    import duckdb

    pages = spark.createDataFrame(list(enumerate(crawl + URLS)), "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/pages")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages/*.parquet'")
    res = con.execute(U.oracle_sql())
    cols = [d[0] for d in res.description]
    got = U.judge(pages)
    assert parity.rows_of(cols, res.fetchall()) == parity.rows_of(got.columns, [tuple(r) for r in got.collect()])


def test_native_plan(spark, crawl):
    plan = U.judge(spark.createDataFrame(list(enumerate(crawl)), "page_id long, url string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))
