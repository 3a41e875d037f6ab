"""Periodic runs of words, found in scale-tiled pieces (operator 12).

A run of period q repeats a block of q words at least four times, so words q
apart are equal over at least 3q places.  Periods are taken by octaves
P <= q < 2P, with boundaries at the multiples of P.  The places where words q
apart are equal hold a boundary c with 3q equal-period words after it: the
Z-function of the text from that boundary reaches 2q at q.  A tile is a block
of neighbouring boundaries with the words around them, P + 1 before and
7P + 2 after, and is solved on its own: a prefix hash tells for all its
boundaries and periods at once where the Z-function may reach 2q, and there
its forward and backward reach are measured on the words themselves.  Each
tile gives fragments (period, first place, place after the last), cut off at
the tile's edges.

Fragments are shuffled by document and period and stitched where they touch;
neighbouring tiles overlap by more than a fragment's edge, so what they give
together is the whole interval.

Documents of more than ``long_words`` words send their tiles through a
shuffle, so that one document's tiles are solved by many tasks; those of
shorter ones are solved where they are made.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import ship, staged
from tierline.llm.textstats import Spans

#: Least words of a run, and least words per word of its period.
LEAST, TIMES = 6, 4
#: Odd multiplier of the prefix hashes.
_BASE = 0x9E3779B97F4A7C15
#: Bytes of text whose words are hashed at once.
PIECE = 1 << 20

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
FOUND = ("doc_id long, key long, n long, plain string, text string, octave int, lo long, own long, words binary, "
         "period long, start long, stop long")

_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    """The multiplier's powers 0 to n - 1."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, (n - 1).bit_length())
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE, np.uint64)]), dtype=np.uint64)
    return _powers


def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def octaves(n: int) -> Iterator[int]:
    """The least periods P of the octaves that a text of n words has runs for."""
    p = 1
    while max(LEAST, TIMES * p) <= n:
        yield p
        p *= 2


def tile_edges(n: int, p: int, size: int) -> Iterator[tuple[int, int, int, int]]:
    """``(first, last)`` boundary places of each tile of an octave, the last
    one excluded, and ``(lo, hi)``, the words it holds."""
    own = max(size // p, 8) * p
    for first in range(0, max(n - 3 * p, 0) + 1, own):
        last = min(first + own, n)
        yield first, last, max(0, first - p - 1), min(n, last + 7 * p + 2)


def solve_tile(words: np.ndarray, p: int, first: int, last: int, open_left: bool, open_right: bool) -> list[tuple[int, int, int]]:
    """Fragments ``(period, start, stop)`` of periods p to 2p - 1 in the words
    of a tile: the places i in [start, stop) whose words i and i + period are
    equal.  Its own boundaries are the multiples of p in [first, last), all
    counted from the tile's first word; open edges are not the text's."""
    n = len(words)
    c = np.arange(first, min(last, n - 3 * p + 1), p)
    if not len(c):
        return []
    power = _power_table(2 * n + 1)
    head = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=head[1:], dtype=np.uint64)
    hits: dict[int, list[int]] = {}
    step = max(1, (1 << 18) // p)
    for k in range(0, len(c), step):
        at = c[k:k + step, None]
        q = np.arange(p, 2 * p)[None, :]
        end = np.minimum(at + 3 * q, n)
        near = (head[np.minimum(at + 2 * q, n)] - head[at]) * power[q] == head[end] - head[np.minimum(at + q, n)]
        near &= at + 3 * q <= n
        # four or more periods of one octave are multiples of a shorter one
        row, col = np.nonzero(near & (near.sum(1, keepdims=True) < 4))
        for r, j in zip(row.tolist(), col.tolist()):
            hits.setdefault(p + j, []).append(int(at[r, 0]))
    out = []
    for q, places in hits.items():
        same = words[:-q] == words[q:]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        starts, stops = edge[::2], edge[1::2]
        here = np.array(places)
        which = np.searchsorted(starts, here, "right") - 1
        held = (which >= 0) & (here + 2 * q <= stops[which])
        for i in np.unique(which[held]).tolist():
            s, t = int(starts[i]), int(stops[i])
            if any((words[s:s + 3 * q - q // r] == words[s + q // r:s + 3 * q]).all() for r in _prime_factors(q)):
                continue
            cut = (open_left and s == 0) or (open_right and t == n - q)
            if cut or t - s + q >= max(LEAST, TIMES * q):
                out.append((q, s, t))
    return out


def word_codes(text: pa.LargeStringScalar | str) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """64-bit codes, first and last byte of the words, and the bytes of the
    text; hashed in pieces that end at white space."""
    data = text.encode() if isinstance(text, str) else text.as_buffer().to_pybytes()
    if len(data) <= PIECE:
        s = Spans(pa.array([data], pa.large_binary()).view(pa.large_string()))
        return s.words(), s.start, s.end, data
    parts, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        s = Spans(pa.array([data[at:end]], pa.large_binary()).view(pa.large_string()))
        parts.append((s.words(), s.start + at, s.end + at))
        at = end
    return (*(np.concatenate(x) for x in zip(*parts)), data)


def _span(n: int, doc_id: int | None) -> tuple[int, int] | None:
    """The contract's first word a and period p of a rewritten document."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def order_of(n: int, doc_id: int | None) -> np.ndarray | None:
    """Which word of the text stands at each place of the rewritten document;
    None where it stays as it is."""
    span = _span(n, doc_id)
    if span is None:
        return None
    a, p = span
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def digest(data: bytes, start: np.ndarray, end: np.ndarray) -> str:
    """sha256 of the given words joined by one space, in pieces."""
    h = hashlib.sha256()
    for k in range(0, len(start), 50_000):
        part = b" ".join([data[a:b] for a, b in zip(start[k:k + 50_000].tolist(), end[k:k + 50_000].tolist())])
        h.update(b" " + part if k else part)
    return h.hexdigest()


def _find(rewrite: bool, long_words: int, size: int):
    def find(batches):
        for b in batches:
            ids, keys = b.column("doc_id").to_pylist(), b.column("key").to_pylist()
            texts = pc.fill_null(b.column("text").cast(pa.large_string()), "")
            rows: list[tuple] = []
            held = 0
            for i, (doc_id, key) in enumerate(zip(ids, keys)):
                codes, start, end, data = word_codes(texts[i])
                n = len(codes)
                order = order_of(n, doc_id) if rewrite else None
                if order is not None:
                    codes, start, end = codes[order], start[order], end[order]
                found, tiles = [], n > long_words
                for p in octaves(n):
                    for first, last, lo, hi in tile_edges(n, p, size):
                        if tiles:
                            rows.append((doc_id, key, n, None, None, p, lo, last - first, codes[lo:hi].tobytes(), None, first, None))
                            held += 8 * (hi - lo)
                            if held > 8 << 20:
                                yield _batch(rows)
                                rows, held = [], 0
                        else:
                            found += [(q, s + lo, t + lo) for q, s, t in solve_tile(codes[lo:hi], p, first - lo, last - lo, lo > 0, hi < n)]
                if tiles or found:
                    rows.append((doc_id, key, n, None, data.decode(), None, None, None, None, None, None, None))
                    held += len(data)
                    rows += [(doc_id, key, None, None, None, None, None, None, None, q, s, t) for q, s, t in found]
                else:
                    rows.append((doc_id, key, n, digest(data, start, end), None, None, None, None, None, None, None, None))
                if held > 8 << 20 or len(rows) >= 5000:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return find


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in FOUND.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(list(c), _KINDS[k]) for c, k in zip(zip(*rows), kinds)], list(names))


def _solve(batches):
    """Tiles that came through the shuffle; ``start`` holds the first boundary."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            words = np.frombuffer(r["words"], np.uint64)
            lo, first = r["lo"], r["start"] - r["lo"]
            got = solve_tile(words, r["octave"], first, first + r["own"], lo > 0, lo + len(words) < r["n"])
            out += [(r["doc_id"], r["key"], q, s + lo, t + lo) for q, s, t in got]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], ["doc_id", "key", "period", "start", "stop"])


def stitch(fragments: DataFrame) -> DataFrame:
    """``doc_id, key, period, start, length`` of the runs, from fragments that
    overlap or touch where an interval was cut.  A (document, period) group
    holds at most as many fragments as the document has words."""
    group = ["doc_id", "key", "period"]
    w = Window.partitionBy(*group).orderBy("start", "stop")
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = (fragments.select(*group, "start", "stop").distinct()
               .withColumn("new", F.when(before >= F.col("start"), 0).otherwise(1)).withColumn("island", F.sum("new").over(w)))
    runs = islands.groupBy(*group, "island").agg(F.min("start").alias("start"), (F.max("stop") - F.min("start") + F.col("period")).alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).select(*group, "start", "length")


def _finish(rewrite: bool):
    def finish(batches):
        for b in batches:
            out = []
            for doc_id, text, lists in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("runs").to_pylist()):
                codes, start, end, data = word_codes(pa.scalar(text.as_py(), pa.large_string()))
                n = len(codes)
                del codes
                order = order_of(n, doc_id) if rewrite else None
                if order is not None:
                    start, end = start[order], end[order]
                runs = sorted((r["start"], r["length"], r["period"]) for r in lists or ())
                keep = np.ones(n, bool)
                for s, length, q in runs:
                    keep[s + q:s + length] = False
                best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                milli = None if best[0] is None else 1000 * best[1] // best[2]
                listed = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
                out.append((doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), digest(data, start[keep], end[keep])))
            if out:
                kinds = [pa.int64()] * 6 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in RESULT.split(", ")])

    return finish


RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def _found(docs: DataFrame, rewrite: bool, long_words: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The first pass's table, and the runs."""
    ship(docs.sparkSession)
    keyed = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))))
    found = staged(keyed.mapInArrow(_find(rewrite, long_words, size), FOUND), "period-tiles")
    tiles = found.where("octave is not null").select("doc_id", "key", "n", "octave", "lo", "own", "words", "start")
    solved = tiles.repartition("doc_id", "key", "octave", "lo").mapInArrow(_solve, "doc_id long, key long, period long, start long, stop long")
    fragments = found.where("period is not null").select("doc_id", "key", "period", "start", "stop").unionByName(solved)
    return found, stitch(fragments)


def runs(docs: DataFrame, long_words: int = 1 << 14, size: int = 1 << 15) -> DataFrame:
    """``doc_id, period, start, length`` of the periodic runs of the texts as
    they are, words from 0; equal rows are listed once."""
    return _found(docs, False, long_words, size)[1].select("doc_id", "period", "start", "length")


def collapse(docs: DataFrame, rewrite: bool = True, long_words: int = 1 << 14, size: int = 1 << 15) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_runs``, ``start, length,
    period, exponent_milli`` of its longest run (ties: first, then shortest
    period; null without one), ``runs_sha256`` and ``collapsed_sha256``.

    A run is a stretch of consecutive words of smallest period q and at least
    ``max(6, 4 * q)`` words that no neighbouring word extends; all but its
    first q words are dropped.  ``rewrite`` first repeats a stretch of every
    tenth document, as the contract asks; a null doc_id is never rewritten.
    Null and empty texts have no words and no runs.  Equal rows are judged
    alike, rows with one doc_id each by their own text; an empty table gives
    no rows; other columns are ignored.  Words count as equal by 64-bit
    hashes.  A document's list of runs is gathered in one row: it holds fewer
    runs than the document has words."""
    found, all_runs = _found(docs, rewrite, long_words, size)
    rows = found.where("octave is null and period is null")
    lists = all_runs.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs")).withColumnsRenamed({"doc_id": "d", "key": "k"})
    open_ = rows.where("plain is null").select("doc_id", "key", "text")
    joined = open_.join(lists, open_.doc_id.eqNullSafe(lists.d) & (open_.key == lists.k), "left").select("doc_id", "text", "runs")
    null = F.lit(None).cast("long")
    plain = rows.where("plain is not null").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), null.alias("start"), null.alias("length"), null.alias("period"),
        null.alias("exponent_milli"), F.lit(EMPTY_SHA).alias("runs_sha256"), F.col("plain").alias("collapsed_sha256"))
    return plain.unionByName(joined.mapInArrow(_finish(rewrite), RESULT))
