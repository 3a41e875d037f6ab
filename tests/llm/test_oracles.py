"""The DuckDB statements against the operators, on tables with links,
copies, nulls and repeats that the driver's small tables lack."""

import duckdb
import numpy as np
import pytest

from tests.parity import rows_of
from tierline.llm.queries import ORACLE, QUERIES


def _same(spark, tmp_path, name, table, frame):
    frame.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    res = con.execute(ORACLE[name])
    names, want = [c[0] for c in res.description], res.fetchall()
    got = QUERIES[name](spark, str(tmp_path))
    assert sorted(names) == sorted(got.columns)
    assert rows_of(names, want) == rows_of(got.columns, [tuple(r) for r in got.collect()])
    return [dict(zip(names, r)) for r in want]


def test_vectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    x = [*base, *(base[:30] + rng.normal(size=(30, 16)) * 0.1), *base[:5]]
    # a chain whose ends are linked through others only
    turn = np.arange(8) * 0.4
    x += [np.concatenate([[np.cos(t), np.sin(t)], np.zeros(14)]) for t in turn]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0])]
    got = _same(spark, tmp_path, "op2_collision_counting", "embeddings", spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert max(r["n_links"] for r in got) >= 2 and sum(not r["kept"] for r in got) >= 35


def test_archive(spark, tmp_path):
    rows = [(1, "u", "é" * 49), (2, "u", "é" * 49), (3, "u", "é" * 50), (4, "u", "é" * 50), (5, None, None), (6, "u", ""), (7, "u", "é" * 50), (8, "u", "x" * 99 + "\n")]
    got = _same(spark, tmp_path, "op3_warc_chunks", "pages", spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r["refers_to"] for r in sorted(got, key=lambda r: r["page_id"])] == [None] * 3 + [3] + [None] * 2 + [3, None]


@pytest.mark.parametrize("edits", [1, 3])
def test_shingles(spark, tmp_path, edits):
    rng = np.random.default_rng(edits)
    words = np.array([f"w{i}" for i in range(400)])
    texts = [None, "", " \t\n", "One", "one", "a b c", "A\x0bB  c", "a b c d", "é É"]
    for _ in range(12):
        t = rng.choice(words, 80)
        for _ in range(4):
            texts.append(" ".join(t))
            t = t.copy()
            t[rng.integers(0, 80, edits)] = "new"
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    got = _same(spark, tmp_path, "op7_ngram_join", "documents", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert sum(r["component_id"] != r["doc_id"] for r in got) >= 2
