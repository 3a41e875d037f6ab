"""The training-data operators against brute force, with nulls, empty and
repeated rows, empty tables and extra columns."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tierline.llm import (bpe_chunks, embed_dedup, gbt, html_extract, license_scan, ngram_join, packing, quality_rules, site_bayes,
                          token_files, warc)
from tierline.llm.components import connected_components

TEXTS = ["", None, "a  b \n c", "Hello world, hello   world.\n\nHello world.", " lead", "tail ", "x" * 300, "don't  stop'll \t é ü 漢字 ok",
         "one two three four five six seven eight nine ten " * 30, "one two three four five six seven eight nine ten " * 30]
DOCS = "doc_id long, text string, source string, lang string, n_tokens string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["a", "b", None][i % 3], "en", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[3], (None, "no id", "a", None, "")], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_bit_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == (1003 * width + 7) // 8
    assert (token_files.unpack(data, 1003, width) == ids).all()


def test_token_files_leave_no_cache_with_the_worker(spark, docs):
    path = P.path("byte_bpe_50k.json")
    token_files.write_token_files(docs, path, token_files.work_dir(spark, "cache"))

    def held(batches):
        import pyarrow as pa

        from tierline.llm.units import _LOADED

        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(len(e.cache) + len(e.older) for (p, _), e in _LOADED.items() if p == path)], pa.int64())})

    assert {r.n for r in spark.range(0, 32, 1, 32).mapInArrow(held, "n long").collect()} == {0}


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = token_files.token_files(docs, P.path("byte_bpe_50k.json")).orderBy("start").collect()
    assert len(got) == docs.count() and got[0].doc_id is None
    at, text = 0, dict(enumerate(TEXTS)) | {None: "no id"}
    for r in got:
        ids = tok.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_files.token_files(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_token_file_random_access(tmp_path):
    from tierline.llm.shared import open_input, open_output

    uri, ids = f"file://{tmp_path}/x.tkid", np.arange(10_000, dtype=np.uint32) % 5000
    w = token_files.TokenFileWriter(open_output(uri), 5000, 256)
    w.add(np.array([1, 2]), np.array([0, 0]), np.array([4000, 6000]), ids)
    w.close()
    with open_input(uri) as f:
        t = token_files.TokenFile(f)
        assert t.width == 13 and (t.ids(777, 1234) == ids[777:2011]).all() and len(t.ids(5, 0)) == 0
        assert [(d, s, len(x)) for d, s, x in t.documents()] == [(1, 0, 4000), (2, 4000, 6000)]


def test_collision_counting(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 32))
    near = base[:40] + rng.normal(size=(40, 32)) * 0.05
    x = np.concatenate([base, near, base[:3], base[:1]])
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, ""), (n + 1, [0.0] * 32, ""), (n + 2, [float("nan")] * 32, ""), (n + 3, [1.0], ""), (n + 4, [], "")]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    got = {r.vec_id: r for r in embed_dedup.near_vectors(t).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    for i in range(n):
        assert got[i].n_links == link[i].sum() - 1
    label = list(range(n))
    for _ in range(n):
        label = [min(label[j] for j in np.flatnonzero(link[i])) for i in range(n)]
    assert all(got[i].component_id == label[i] and got[i].kept == (label[i] == i) for i in range(n))
    assert all(got[n + k].n_links == 0 and got[n + k].kept for k in range(5))
    assert embed_dedup.near_vectors(t.limit(0)).count() == 0


def test_collision_counting_takes_any_norm(spark):
    rows = [(0, [1e-200, 1e-200]), (1, [1e200, 1e200]), (2, [1.0, 1.0]), (3, [1e200, 0.0]), (4, [5e-324, 0.0]), (5, [1e308, -1e308])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


def test_collision_counting_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    cos = rng.uniform(0.9001, 0.91, 1500)[:, None]
    x = np.concatenate([a, cos * a + np.sqrt(1 - cos * cos) * b])
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in embed_dedup.near_vectors(t).collect()}
    assert np.mean([got[i + 1500] == i for i in range(1500)]) >= 0.99


def test_warc(spark):
    rows = [(3, "http://a/\r\nx", "p" * 500, 1), (1, None, "p" * 500, 2), (2, "u", "q" * 50, 3), (4, "u", "q" * 50, 4), (5, "u", None, 5),
            (6, "u", "WARC/1.1\r\n\r\né" * 90_000, 6), (1, None, "p" * 500, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(2)
    got = warc.archive(pages, chunk=1000).collect()
    assert len(got) == len(rows)
    for r in got:
        b = (dict((p, h) for p, _, h, _ in rows)[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(b), hashlib.sha256(b).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 1) if r.page_id == 3 else ("response", None))
    assert warc.archive(pages.limit(0)).count() == 0


def test_bpe_chunks(spark, docs, empty):
    c = bpe_chunks.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = bpe_chunks.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk=40, overlap=12).collect()
    assert len(got) == docs.count()
    text = dict(enumerate(TEXTS)) | {None: "no id"}
    for r in got:
        t = text[r.doc_id] or ""
        ids = c.encode(t)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe_chunks.encode_decode(empty, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_bpe_chunks_stitch_at_true_boundaries_only(spark):
    rng = random.Random(5)
    parts = ["a", "b ", "'", "ll", "'re", " ", "  ", "\n", "12", "345", "!", "é", "漢", "😀 ", "word ", " the"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 120))) for _ in range(400)] + ["x" * 700 + " y" * 200, "7" * 500 + " 1234567 " * 40 + "end", "漢字。" * 300]
    grouped = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)] + [(1, texts[1]), (1, texts[2])], "doc_id long, text string").repartition(4)
    # a chunk of 24 keeps the phase of digits in threes, so false boundaries agree
    for pattern, chunk, overlap in ((P.PATTERN, 20, 8), (grouped, 24, 9)):
        c = bpe_chunks.codec(P.path("byte_bpe_50k.tiktoken"), pattern)
        want = sorted((i, len(ids := c.encode(x)), hashlib.sha256(c.decimal(ids)).hexdigest(), hashlib.sha256(x.encode()).hexdigest())
                      for i, x in [*enumerate(texts), (1, texts[1]), (1, texts[2])])
        got = bpe_chunks.encode_decode(t, P.path("byte_bpe_50k.tiktoken"), pattern, chunk, overlap).collect()
        assert sorted(map(tuple, got)) == want
    with pytest.raises(ValueError):
        bpe_chunks.encode_decode(t, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, 40, 3)


def test_main_text_of_held_out_layouts(spark):
    trees, rng, right = html_extract.fit(), random.Random(77), []
    for _ in range(80):
        nodes, y = html_extract.labelled(html_extract.sample_page(rng))
        seen = [i for i, d in enumerate(nodes) if d.tag not in html_extract._SILENT]
        right.append((html_extract.decode(nodes, trees.score(html_extract.features(nodes)))[seen] == y[seen]).mean())
    assert np.mean(right) > 0.97
    page = ("<html><body><nav><ul><li><a href='/'>Menu</a></li></ul></nav><article><h1>Title &amp; more</h1><p>First  one,\n of the text.</p>"
            "<p>Second one, here. And more of it.</p></article><div class='comments'><p>Nice!</p></div><footer>&copy; us</footer></body></html>")
    rows = [(1, "u", page), (2, "u", None), (3, None, "")]
    got = {r.page_id: r for r in html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), trees).collect()}
    assert got[1].text == "Title & more First one, of the text. Second one, here. And more of it." and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0


def test_main_text_outside_blocks():
    trees, rng, right = html_extract.fit(), random.Random(78), []
    for _ in range(80):
        nodes, y = html_extract.labelled(html_extract.sample_page(rng, loose=True))
        seen = [i for i, d in enumerate(nodes) if d.tag not in html_extract._SILENT]
        right.append((html_extract.decode(nodes, trees.score(html_extract.features(nodes)))[seen] == y[seen]).mean())
    assert np.mean(right) > 0.93
    one, two = "The first paragraph tells of the river, and of the old mill.", "The second one goes on, with more of the story."
    page = f"<html><head><title>t</title></head><body><nav><ul><li><a href='/'>Menu</a></li></ul></nav><article><h1>A title</h1><p>{one}</p>"
    pages = [f"{one}<br><br>{two}<script>x()</script>", f"<html><head><title>t</title>{one}<br>{two}", f"{page}</body></html><p>{two}</p>",
             f"{page}<p>Take <math><mi>x</mi><mo>+</mo><mn>1</mn></math>, then <video src='v'>see the film</video>.</p></article></body></html>",
             f"\ufeff\n{page}</article></body></html>\n"]
    assert html_extract.extract(pages, trees) == [f"{one} {two}", f"{one} {two}", f"A title {one} {two}",
                                                  f"A title {one} Take x+1, then see the film.", f"A title {one}"]


def test_main_text_of_deep_pages_and_stray_end_tags():
    deep = "<div>" * 100_000 + "text" + "</section></p>" * 100_000
    started = time.monotonic()
    nodes = html_extract.parse(deep)
    assert len(nodes) == 100_001 and nodes[-1].kids == [("text", False)] and time.monotonic() - started < 20
    one = html_extract.parse("<p>fo<img src=a>o bar<br>baz</div></p><p>next</section> end")
    assert html_extract.blocks(one, np.ones(len(one), int)) == ["foo bar baz", "next end"]


def test_decoding_is_consistent():
    nodes = html_extract.parse("<div><p>a</p><div class='ad'><p>b</p></div></div>")
    kept = html_extract.decode(nodes, np.array([-9.0, 9, 9, -9, 1]))
    assert kept.tolist() == [0, 1, 1, 0, 0]


def test_license_scan(spark, empty):
    rows = [(1, "x MIT License mit license\ncc by\nApache  License"), (2, None), (3, ""), (4, "Licensed under CC BY-NC 4.0.\nrest"), (5, "the mitK license")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (9, 4, 1, 7, "apache,cc-by,mit")
    assert got[2].n_words == got[3].n_words == 0 and got[2].labels == "" and got[2].first_word is None
    assert got[4].labels == "cc-by,cc-by-nc-4.0" and got[4].score == 1.0
    assert got[5].n_base == 0
    assert license_scan.scan(empty).count() == 0


def _labels(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return {r.doc_id: r.labels for r in license_scan.scan(d).collect()}


def test_license_notices_wrapped_over_lines_and_scattered_words(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.")
    bsd = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:")
    mpl = ("# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed")
    fill = " ".join(f"word{i}" for i in range(40))
    got = _labels(spark, [mit, bsd, mpl, f"{fill} {mit} {fill}".replace("\n", " "), f"{fill}\n{bsd}\n{fill}\n{mpl}",
                          f" {fill} ".join("licensed under cc by 4 0".split()), "permitted account", "licensed\nunder\ncc\nby\n4.0"])
    assert [got[i] for i in range(8)] == ["mit-notice", "bsd", "mpl-2.0", "mit-notice", "bsd,mpl-2.0", "", "", "cc-by,cc-by-4.0"]


def test_license_scan_keeps_every_template_met(spark):
    texts = ["Licensed under the MIT License, and licensed under the Apache License, Version 2.0",
             "Licensed under the GNU Lesser General Public License version 3",
             "Licensed under the GNU General Public License version 3",
             "Licensed under the GNU Affero General Public License, version 3.",
             "Licensed under CC BY-NC 4.0", "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.",
             "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0, text licensed under CC BY 4.0",
             "Code is released under the MIT License. This is free and unencumbered software released into the public domain."]
    want = ["apache,apache-2.0,mit,mit-notice", "lgpl-3.0", "gpl,gpl-3.0", "agpl-3.0", "cc-by,cc-by-nc-4.0", "cc-by,cc-by-nc-4.0",
            "cc-by,cc-by-4.0,cc-by-nc-4.0", "cc-by,cc-by-4.0,cc-by-nc-4.0", "mit,mit-notice,unlicense"]
    got = _labels(spark, texts)
    assert [got[i] for i in range(len(texts))] == want


def _shingle_components(texts, k, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return label, [len(s) for s in sets]


def test_ngram_join(spark, empty):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 30, 80]))) for _ in range(40)]
    for t in texts[:15]:
        w = t.split()
        for _ in range(rng.choice([1, 4])):
            w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    texts += [texts[0], texts[0], "", None, "   ", "one two", "one two"]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n string").repartition(4)
    for k, percent in ((4, 85), (5, 80)):
        label, size = _shingle_components(texts, k, percent)
        got = {r.doc_id: r for r in ngram_join.near_duplicates(d, k, percent).collect()}
        assert [got[i].component_id for i in range(len(texts))] == label
        assert [got[i].n_shingles for i in range(len(texts))] == size
    assert ngram_join.near_duplicates(empty).count() == 0


def test_dedup_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    def text(c):
        return " ".join(f"{c}{i}" for i in range(60))

    rows = [(1, text("a"), "x"), (1, text("a"), "x"), (1, text("a"), "y"),  # repeated rows
            (None, text("b"), "x"), (None, text("b"), "x"), (None, text("b") + " more", "x"),  # copies without an id
            (2, text("c"), "x"), (3, text("c"), "x"), (3, text("d"), "x"),  # one id, a copy and a text of its own
            (None, text("c"), "x"), (4, text("e"), "x"), (4, text("e") + " more", "x"),
            (5, "", "x"), (6, None, "x"), (None, "", "x"), (None, " ", "x"), (None, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = corpus_pipeline.dedup_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = [(r.doc_id, (r.text or "")[:1].strip()) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (None, "b"), (2, "c"), (3, "d"), (4, "e"), (5, ""), (6, ""), (None, ""), (None, ""), (None, "")], key=str)
    assert corpus_pipeline.dedup_stage(spark, docs.limit(0), "").count() == 0


def test_parity_bitmaps_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 2, 63, 64, 65, 700, 5000):
        x = np.unique(rng.integers(0, 1 << 62, size))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.8], rng.integers(0, 1 << 62, max(1, size // 5))]))
        apart = len(np.setxor1d(x, y))
        for a, b in ((x, y), (y, x)):
            assert ngram_join.differing(ngram_join.parity_bits(a), ngram_join.parity_bits(b)) <= apart
        assert ngram_join.differing(ngram_join.parity_bits(x), ngram_join.parity_bits(x)) == 0
    x, y = rng.integers(0, 1 << 62, (2, 3000))
    assert ngram_join.differing(ngram_join.parity_bits(x), ngram_join.parity_bits(y)) > 1000


def test_trees_keep_monotone_signs():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(600, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + rng.normal(0, 0.2, 600) < 0.5).astype(float)
    t = gbt.train(x, y, {0: -1})
    grid = np.full((200, 3), 0.5)
    grid[:, 0] = np.linspace(0, 1, 200)
    s = t.score(grid)
    assert (np.diff(s) <= 1e-9).all() and s[0] > s[-1]


def test_quality_rules_counts(spark, docs, empty):
    got = {r.doc_id: r for r in quality_rules.apply_rules(docs, None).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        g = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        cover = {j + k for j, x in enumerate(g) if g.count(x) > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if x.strip()]
        assert (got[i].n_words, got[i].word_chars, got[i].n_dup_lines, got[i].n_repeat_words) == (
            len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert got[i].base_failed == (len(w) < 50 or 100 * len(cover) > 50 * len(w)) and got[i].kept == (not got[i].base_failed)
    assert quality_rules.apply_rules(empty, None).count() == 0


def test_lines_of_newline_terminated_texts(spark):
    texts = ["foo\nbar\nfoo\n", "foo\nbar\nfoo\n\n\n", "foo\nfoo", "\n", "foo\n", "a b\n\na b\n", "", "x\nx \n"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    got = {r.doc_id: r.n_dup_lines for r in quality_rules.apply_rules(d, None).collect()}
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip()]
        assert got[i] == len(lines) - len(set(lines)), repr(t)


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for weights in (None, {"a": 3.0, "b": 1.0}):
        got = packing.pack(docs, path, 1, length=64, window_sequences=2, weights=weights).orderBy("sequence_id", "offset").collect()
        at = 0
        for r in got:
            assert r.sequence_id * 64 + r.offset == at and 0 < r.length <= 64 - r.offset
            at += r.length
            ids = np.array(tok.encode(([*TEXTS, "no id"][-1 if r.doc_id is None else r.doc_id]) or "", add_special_tokens=False).ids + [1], "<u4")
            assert bytes(r.ids) == ids[r.start:r.start + r.length].tobytes() and zlib.crc32(r.ids) == r.ids_crc32 and r.doc_tokens == len(ids)
        once = [r for r in got if r.doc_id != 3]
        assert len({(r.doc_id, r.start) for r in once}) == len(once)
    assert packing.pack(empty, path, 1).count() == 0


def test_packing_schedule_serves_all():
    totals = {"a": 1000, "b": 10, "c": 3000}
    for weights in (None, {"a": 1.0, "c": 1.0}, {"a": 0.0}):
        phases = packing.schedule(totals, 128, weights)
        assert {q: sum(s.get(q, 0) for _, s in phases) for q in totals} == totals
        for parts in packing.timetable(phases, totals).values():
            assert parts[0][0] == 0 and parts[-1][1] == 1 and all(x[1] == y[0] and x[2] + x[3] <= y[2] for x, y in zip(parts, parts[1:]))


def _served(spark, totals, window, weights=None):
    """``(place, queue, tokens)`` of all runs, in order."""
    from pyspark.sql import functions as F

    groups = {}
    for q, n in totals.items():
        groups[q if q in (weights or {}) else packing.REST] = groups.get(q if q in (weights or {}) else packing.REST, 0) + n
    times = packing.timetable(packing.schedule(groups, window, weights), groups)
    rows = [(q, n, times[q if q in (weights or {}) else packing.REST]) for q, n in totals.items()]
    df = spark.createDataFrame(rows, "queue string, total long, times array<struct<start: double, stop: double, first: long, rounds: long>>")
    runs = df.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(total - 1) div {packing.RUN}"))))
    runs = runs.select("queue", "run", packing.round_of(runs.run, runs.total, runs.queue, runs.times).alias("round"),
                       F.least(F.lit(packing.RUN), runs.total - runs.run * packing.RUN).alias("size"))
    sizes = {(r.queue, r.run): (r["size"], r.round) for r in runs.collect()}
    placed = sorted((r.place, r.queue, r.run) for r in packing.placed_runs(runs).collect())
    at, last = 0, {}
    for place, q, run in placed:
        assert place == at and run == last.get(q, -1) + 1
        at, last[q] = at + sizes[q, run][0], run
    assert at == sum(totals.values())
    return [(p, q, sizes[q, r][0]) for p, q, r in placed]


def test_packing_weights_share_one_unit(spark):
    totals = {"a": 40_000, "b": 40_000, **{f"t{i:03}": 900 for i in range(400)}}
    runs = _served(spark, totals, 2048, {"a": 3.0, "b": 1.0})
    at = sum(totals.values())
    # a fifth of the tokens: a and b in the ratio 3:1, the others at their own share
    part = {k: sum(n for p, q, n in runs if p < at // 5 and q[0] == k) for k in "abt"}
    assert 2.5 < part["a"] / part["b"] < 3.5 and 0.75 < part["t"] * 5 / (400 * 900) < 1.25


def test_packing_keeps_the_proportions_of_5000_sources(spark):
    """At every tenth of the stream each source has been served its share, a
    run more or less, and small sources are spread over all rounds."""
    rng = random.Random(1)
    totals = {f"s{i}": rng.choice([3, 40, 700, 5000]) for i in range(5000)} | {"hot": 4_000_000}
    runs, whole = _served(spark, totals, 131_072), sum(totals.values())
    served, at, k = dict.fromkeys(totals, 0), 0, 0
    for place, q, n in runs:
        if place >= (k + 1) * whole / 10:
            k += 1
            # a round's window may be served in part
            late = 131_072 / whole
            assert all(abs(served[x] - t * place / whole) <= packing.RUN + t * late + 1 for x, t in totals.items())
            small = [x for x, t in totals.items() if t == 3]
            assert abs(sum(served[x] > 0 for x in small) / len(small) - place / whole) < 0.1
        served[q] += n
    assert k >= 9


def test_packing_weight_zero_is_served_last(spark):
    rows = [(i, " ".join(["word"] * 300), f"big{i % 3}") for i in range(12)] + [(100, "one small text", "small")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(d, P.path("word_bpe_49k.json"), 1, length=64, window_sequences=2, weights={"small": 0.0, "nowhere": 2.0}).collect()
    assert max(got, key=lambda r: (r.sequence_id, r.offset)).doc_id == 100


def test_packing_32_bit_ids(spark, docs, monkeypatch):
    path = P.path("word_bpe_49k.json")
    narrow = packing.pack(docs, path, 1).collect()
    assert sorted(packing.pack(docs, path, 1, with_ids=False).collect(), key=str) == sorted((r[:-1] for r in narrow), key=str)
    monkeypatch.setattr(packing, "SLICE", 100)
    assert sorted(packing.pack(docs, path, 1).collect(), key=str) == sorted(narrow, key=str)
    monkeypatch.setattr(packing, "id_type", lambda vocab: np.dtype("<u4"))
    assert sorted(packing.pack(docs, path, 1).collect(), key=str) == sorted(narrow, key=str)


def test_packing_tasks_hold_little_at_once(monkeypatch):
    """Arrays of a task's encoding and cutting, over 6 MB of texts and 12 MB of ids in one batch."""
    import tracemalloc

    import pyarrow as pa
    from pyspark import TaskContext

    def most(batches):
        tracemalloc.start()
        rows = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), b.column(names[1]).to_pylist())]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return rows, peak / 1e6

    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(TaskContext, "get", Task)
    text = "so many plain words that stand in a row " * 50
    texts = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(3000), pa.int64()), "text": pa.array([text] * 3000), "queue": pa.array(["s"] * 3000)})
    names = ["doc_id", "n"]
    rows, mb = most(packing._encode(P.path("word_bpe_49k.json"), 1)([texts]))
    assert [r[0] for r in rows] == list(range(3000)) and len({r[1] for r in rows}) == 1
    assert mb < 30
    ids = bytes(4000)
    cut = pa.array([[{"start": 0, "size": 2000, "place": 2000 * i}] for i in range(3000)], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "size", "place")])))
    packed = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(3000), pa.int64()), "n": pa.array([2000] * 3000, pa.int64()), "ids": pa.array([ids] * 3000), "cuts": cut})
    names = ["doc_id", "length"]
    rows, mb = most(packing._cut(2048, True)([packed]))
    assert sum(n for _, n in rows) == 3000 * 2000
    assert mb < 28


def test_native_operators_have_no_python_in_their_plans(spark):
    from tierline.llm.queries import QUERIES

    for name in ("op6_license_scan", "op11_host_reputation"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Python|Pandas|InArrow|CartesianProduct|NestedLoopJoin", plan), name


WORDS = ["Plain", "word.", "don't", "it's", "'s", "(a)", "x1y22", "naïve", "ÀÉÎ", "straße", "İstanbul", "cafe\u0301", "ﬁn", "µm", "\u00a0a", "a\u2009b", "1,000.50",
         "<|endoftext|>", "a<|endoftext|>b", "</w>", "</w></w>", "漢字", "🙂🙂", "\u0301", "Ω", "ǅ", "\x7f", "a\x00b", "×÷", "E=mc²", "…", "'", "''", "I'LL", "we'Ll", "Word,", "WORD!", "end.'s", "a.b", "É!", "ÿ;", "ß?", "ªb.", "º,", "x..", ".,", "!", "don't.", "'s.", "a.'ll", "w$$$", "w,%%%", "w\"", "w)'s", "w\\", "w^]", "w-", "a-b-", "_x_", "x__", "w<", "w|", "w.\n\nW.\n", "\nw", "w~`"]


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_units_as_the_library_encodes(name, spaces):
    """Joined units and their parting, against whole texts encoded at once."""
    from tokenizers import Tokenizer

    from tierline.llm.units import UnitEncoder

    rng, tok = random.Random(2), Tokenizer.from_file(P.path(name))
    enc = UnitEncoder(P.path(name), spaces, cache_units=50)
    texts = WORDS + [rng.choice([" ", "  ", "\n", " \t"]).join(rng.choice(WORDS) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    for _ in range(2):
        ids, counts = enc.encode(texts)
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends):
            assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_site_posteriors_shrink(spark):
    rows = [("h1", "p", 4.0)] * 200 + [("h2", "p", -4.0)] * 200 + [("h3", None, -4.0)]
    got = {r.h_: r for r in site_bayes.site_posteriors(spark.createDataFrame(rows, "host string, path string, doc_logit double")).collect()}
    assert got["h1"].path_posterior > 0.8 and got["h2"].path_posterior < 0.2
    assert got["h2"].path_posterior < got["h3"].path_posterior < 0.5


def test_classifier(spark, docs, empty):
    good = " ".join(["The quiet river runs past the old mill and on to the sea."] * 3)
    rows = [(i, (good + f" {i}") if i % 3 else "BUY!! NOW!! ### $$$ " * (5 + i % 4), "s", "en", "") for i in range(120)]
    d = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(200, 1), (91, None)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in site_bayes.classify(d, site_bayes.fit(d, labels)).collect()}
    assert all(got[i] == (i % 3 > 0) for i in range(90, 120))
    assert site_bayes.classify(docs, None).where("kept").count() == docs.count()
    assert site_bayes.classify(empty, None).count() == 0


CLASH = "kept n_words n_docs text_ id_ hash_ order_ nth_ own0 host path h_ p_ doc_logit score base_failed queue component_id first".split()


def test_pipeline_stages_leave_columns_of_any_name_as_they_are(spark, tmp_path):
    import corpus_pipeline as C

    good = "The quiet river runs past the old mill and on to the sea. "
    rows = [(i, good * 3 + f"{i} " + " ".join(f"w{i}x{j}" for j in range(60)) if i % 4 else "BUY!! ### $$$ " * 9, f"s{i % 3}", "en", 0) for i in range(60)]
    rows += [rows[5], (90, rows[6][1], "s0", "en", 0), (None, None, None, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    from pyspark.sql import functions as F

    docs = plain.select("*", *[F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASH])
    for name, stage in C.STAGES[:-1]:
        a = stage(spark, plain, str(tmp_path))
        docs_out = stage(spark, docs, str(tmp_path))
        assert docs_out.columns == docs.columns and a.columns == plain.columns
        got = docs_out.collect()
        assert sorted((str(tuple(r[:5])) for r in got)) == sorted(str(tuple(r)) for r in a.collect()), name
        assert all(r[c] == f"{c} {'-' if r.doc_id is None else r.doc_id}" for r in got for c in CLASH), name
        plain, docs = spark.createDataFrame(a.collect(), a.schema), spark.createDataFrame(got, docs.schema)
    assert 30 < docs.count() < 60
    assert C.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


def test_a_repeated_labelled_id_counts_once(spark):
    good = "The quiet river runs past the old mill and on to the sea. " * 2
    docs = spark.createDataFrame([(0, "BUY!! ### $$$ " * 9)] * 60 + [(i, good + str(i)) for i in range(1, 7)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i > 0)) for i in range(7)], "doc_id long, quality int")
    assert quality_rules.labelled_sample(docs, labels, 8).count() == 7
    assert quality_rules.fit(docs, labels, rows=8) is not None and site_bayes.fit(docs, labels, rows=8) is not None


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7), (None, 3), (2, 1)], "a long, b long")
    got = {r.node: r.component for r in connected_components(e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.rules_stage(spark, docs, sf)
    assert kept.columns == docs.columns and kept.count() < docs.count()
    once = corpus_pipeline.dedup_stage(spark, docs, sf)
    assert once.count() == ngram_join.near_duplicates(docs).select("component_id").distinct().count()
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.count() and pieces.where("length > 2048").count() == 0


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_units_encode_as_the_library_does(name, spaces):
    from tierline.llm.units import UnitEncoder

    rng = random.Random(6)
    bits = ["a", "Word", "don't", "é", "漢字", "123", " ", " ", " ", "\n", "\t", " ", "\u0085", "!?", "<|endoftext|>", "\x00", "🙂", "ſ", "‍"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", " ", "  a", "a  "]
    enc = UnitEncoder(P.path(name), spaces, cache_units=50)  # the caches turn over many times
    for _ in range(2):
        ids, counts = enc.encode(texts)
        at = 0
        for t, n in zip(texts, counts.tolist()):
            assert ids[at:at + n].tolist() == enc.tok.encode(t, add_special_tokens=False).ids, repr(t)
            at += n
        assert at == len(ids)


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_word_is_encoded_once_over_slices_and_line_ends(name, spaces):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tierline.llm.units import UnitEncoder

    rng, tok, enc = random.Random(9), Tokenizer.from_file(P.path(name)), UnitEncoder(P.path(name), spaces)
    model, seen = enc.model, []

    class Counted:
        def tokenize(self, word):
            seen.append(word)
            return model.tokenize(word)

    enc.model = Counted()
    words = ["plain", "Word", "straße", "Élan", "end.", "so!!", "x1", "漢字", "don't", "<|endoftext|>"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "\n", "\n\n", " \n", "\x1c\n", "\u2003\n"]) for _ in range(30)) for _ in range(200)]
    for at, n, ids, counts in enc.encode_rows(pa.array([*texts, None, "plain", "\n", "a\n"], pa.string()), 2000):
        ends = np.cumsum(counts)
        for t, a, b in zip([*texts, "", "plain", "\n", "a\n"][at:at + n], ends - counts, ends):
            assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    assert len(seen) == len(set(seen)) and {"plain", enc.as_bytes.normalize_str(" straße" if spaces else "straße")} <= set(seen)


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_tokens_in_texts_as_the_untouched_library(name, spaces):
    from tokenizers import Tokenizer

    from tierline.llm.units import UnitEncoder

    tok, enc, rng = Tokenizer.from_file(P.path(name)), UnitEncoder(P.path(name), spaces), random.Random(8)
    bits = ["one", " ", " ", "  ", "\n", "é", "don't", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof"]
    texts = ["one <|endoftext|> two", "<|endoftext|>", "x<|endoftext|>y <|startoftext|> z"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 20))) for _ in range(800)]
    ids, counts = enc.encode(texts)
    at = 0
    for t, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
        at += n
    assert at == len(ids)
