"""Property tests: stint invariants on generated observations."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.operators.stints import stints
from tierline.quality import checks as qc

BASE = dt.date(2024, 1, 1)

observations = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 40), st.sampled_from(["A", "B", "C"])),
    min_size=1, max_size=40,
).map(lambda rows: list({(e, d): (e, d, v) for e, d, v in rows}.values()))  # one observation per (entity, day)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(observations)
def test_stint_invariants(spark, rows):
    data = [(e, BASE + dt.timedelta(days=d), v, (BASE + dt.timedelta(days=d)).isocalendar()[1]) for e, d, v in rows]
    obs = spark.createDataFrame(data, "e long, day date, v string, p long")
    st_df = stints(obs, "e", "v", "p", "day").cache()
    got = st_df.collect()
    # never inverted, never overlapping, one current interval per entity
    assert all(r.valid_from <= r.valid_to for r in got)
    assert qc.mutually_exclusive_ranges(st_df, ["e"], "valid_from", "valid_to").count() == 0
    assert sorted(r.e for r in got if r.is_current) == sorted({e for e, _, _ in rows})
    # every observation lies in exactly one interval, and it names the observed value
    iv = st_df.select("e", F.col("v").alias("iv"), "valid_from", "valid_to")
    c = qc.containment(obs.select("e", "day", "v"), iv, "e", "day", "v", "iv", bucket="week")
    assert c.where("violates").count() == 0
    # a day between two observations of different values in one period belongs to the old value
    by = {}
    for e, day, v, p in sorted(data):
        by.setdefault((e, p), []).append((day, v))
    for (e, _p), seq in by.items():
        for (d0, v0), (d1, v1) in zip(seq, seq[1:]):
            if v0 != v1 and (d1 - d0).days > 1:
                gap = d1 - dt.timedelta(days=1)
                owners = [r.v for r in got if r.e == e and r.valid_from <= gap <= r.valid_to]
                assert owners == [v0]
    st_df.unpersist()
