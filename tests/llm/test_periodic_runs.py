"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tierline.llm import periodic_runs as R


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            part = words[s:s + length]
            if length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((s, length, q))
    return out


def brute(doc_id, text, rewrite=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if rewrite and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def texts(seed):
    rng = random.Random(seed)
    out = ["", None, " \n\t ", "a", "a a a a a", "a a a a a a", "a\u00a0b a\u00a0b", "x y " * 3, "x y " * 4, "x y x y x y x y x", " a  b\nc " * 40, "é ü " * 9,
           "a b a b a b a b c c c c c c a b a b a b a b", "a a b " * 30 + "a a a a a a a", "w " * 700]
    for _ in range(60):
        n, k = rng.randrange(1, 160), rng.choice([1, 2, 3, 30])
        words = [f"w{rng.randrange(k)}" for _ in range(n)]
        for _ in range(rng.randrange(3)):
            block = [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, 24))]
            at = rng.randrange(n)
            words[at:at] = (block * 9)[:rng.randrange(len(block), 9 * len(block) + 1)]
        out.append(" ".join(words))
    thue = [0]
    while len(thue) < 1024:
        thue += [1 - b for b in thue]
    return out + [" ".join("ab"[b] for b in thue) + " a b c d" * 20, " ".join("ab"[b] for b in thue[:300]) * 5]


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, period string, n int").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[-1], r[-2])
    got = sorted((tuple(r) for r in R.collapse(df, **options).collect()), key=key)
    assert got == sorted((brute(i, t, options.get("rewrite", True)) for i, t in rows), key=key)


@pytest.mark.parametrize("options", [{}, {"long_words": 20, "size": 16}, {"rewrite": False, "size": 8}, {"rewrite": False, "long_words": 0, "size": 64}])
def test_against_brute_force(spark, options):
    some = texts(1)
    # ids whose rewriting is on and off, repeated rows, one id with two texts, null ids
    on = [i for i in range(-50, 2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = list(enumerate(some)) + list(zip(on, some)) + [(7, some[20]), (7, some[20]), (7, some[21]), (None, some[14]), (None, "a b"), (None, None)]
    check(spark, rows, **options)


def test_empty_table(spark):
    assert R.collapse(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [8, 64, 4096])
def test_tiles_stitch(seed, size):
    """Tiles solved one by one give whole intervals, whatever their size."""
    rng = random.Random(seed)
    words = [rng.randrange(2) for _ in range(rng.randrange(100, 900))]
    for _ in range(4):
        block, at = [rng.randrange(3) for _ in range(rng.randrange(1, 60))], rng.randrange(len(words))
        words[at:at] = block * rng.randrange(3, 8) + block[:len(block) // 2]
    codes, n, got = np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15), len(words), {}
    for p in R.octaves(n):
        for first, last, lo, hi in R.tile_edges(n, p, size):
            for q, s, t in R.solve_tile(codes[lo:hi], p, first - lo, last - lo, lo > 0, hi < n):
                got.setdefault(q, []).append((s + lo, t + lo))
    runs = []
    for q, parts in got.items():
        merged = []
        for s, t in sorted(parts):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], t)
            else:
                merged.append([s, t])
        runs += [(s, t - s + q, q) for s, t in merged if t - s + q >= max(6, 4 * q)]
    assert sorted(runs) == sorted(brute_runs(words))


def test_long_text_in_pieces():
    text = "lorem ipsum dolor  sit\n" * 200_000
    codes, start, end, data = R.word_codes(text)
    assert len(codes) == 800_000 and len(set(codes[:4].tolist())) == 4 and (codes[4:] == codes[:-4]).all()
    assert R.digest(data, start, end) == hashlib.sha256(" ".join(text.split()).encode()).hexdigest()
