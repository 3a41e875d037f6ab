"""N-gram Jaccard join by vertical partitioning (operator 7).

Distinct word shingles are ordered globally, rare before frequent: the order
key of a shingle is the logarithm of how often its counter of a bounded
counting table was hit by all documents, then the shingle's hash.  Pivots cut
that order into fragments of equal mass.  Only the head of a document's
ordered set can hold the first shingle it shares with a near duplicate, so
heads give the candidate pairs (prefix, length and position filters).  A
parity bitmap of each set, as long as the set is large, bounds the overlap of
a candidate from above; most candidates fail that bound.  For each of the
others the overlap is counted in every fragment by itself and summed per pair,
which decides the link exactly.

Documents with equal sets are one class.  Within a head shingle's documents
the pairs with the one of earliest position are tried first; once those links
have joined components, only pairs across components remain to be tried, so a
large group of copies never becomes all its pairs and no link between
components is missed.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm import textstats
from tierline.llm.components import connected_components
from tierline.llm.shared import ship, staged, veiled

ORDER_BITS, SLICE = 22, 16384
_LOW = (1 << 56) - 1


def _counting_table(texts: DataFrame, words: int) -> np.ndarray:
    """Hits of all shingles of all documents on 2**ORDER_BITS counters; that
    table (32 MB, sent packed) is what goes to the driver, whatever the input's size."""

    def count(batches):
        hits = np.zeros(1 << ORDER_BITS, np.int64)
        for b in batches:
            for at, n in textstats.slices(b.column(0)):
                s = textstats.Spans(b.column(0).slice(at, n), lower=True)
                w = s.words()
                for i in range(n):
                    g = textstats.shingles(w[s.first[i]:s.first[i + 1]], words)
                    np.add.at(hits, (g >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1)
        used = [k for k in range(len(hits) // SLICE) if hits[k * SLICE:(k + 1) * SLICE].any()]
        if used:
            data = [zlib.compress(hits[k * SLICE:(k + 1) * SLICE].astype("<i8").tobytes(), 1) for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(data, pa.binary())], ["slice", "hits"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(data), "<i8")
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in total.values()], pa.binary())], ["slice", "hits"])

    table = np.zeros(1 << ORDER_BITS, np.int64)
    for r in texts.mapInArrow(count, "slice int, hits binary").repartition("slice").mapInArrow(add, "slice int, hits binary").collect():
        table[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] += np.frombuffer(zlib.decompress(r.hits), "<i8")
    return table


def _ranks(table: np.ndarray) -> np.ndarray:
    return np.minimum(127, 4 * np.log2(1 + table.astype(np.float32))).astype(np.uint8)


def pivots(table: np.ndarray, fragments: int) -> list[int]:
    """Order keys that cut the mass of all shingles into equal fragments."""
    mass = np.bincount(_ranks(table).astype(np.int64), table, 128)
    total, seen, out = mass.sum(), 0.0, []
    for r in range(128):
        while mass[r] and len(out) < fragments - 1 and seen + mass[r] >= total * (len(out) + 1) / fragments:
            share = (total * (len(out) + 1) / fragments - seen) / mass[r]
            out.append((r << 56) + int(share * _LOW))
        seen += mass[r]
    return out


def parity_bits(keys: np.ndarray) -> bytes:
    """A bitmap of 64 bits or more, a power of two not below the number of
    keys; a bit is set where an odd number of keys falls."""
    size = max(64, 1 << (len(keys) - 1).bit_length())
    return np.packbits((np.bincount(keys & (size - 1), minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits by which two parity bitmaps differ, at most the number of keys that
    one of the sets has and the other has not.  The halves of the longer are
    laid over each other until the lengths agree."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def ordered_sets(docs: DataFrame, words: int, ranks, percent: int, wanted=None) -> DataFrame:
    """``doc_id, text_hash, sid, n, keys`` of each document.  ``sid`` is a 63-bit digest
    of the set (equal sets, equal sid) and ``n`` its size.  ``keys`` are the
    ascending order keys of the set's head, as long as ``percent`` asks for;
    with ``wanted``, a bitmap of sids, only those documents are given, with
    all keys.  A task gives the keys of a set once and null keys for most of
    its further copies.  ``parity`` comes with heads (see ``parity_bits``).
    ``ranks`` and ``wanted`` are broadcasts."""

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for at, n in textstats.slices(b.column("text")):
                s = textstats.Spans(b.column("text").slice(at, n), lower=True)
                w = s.words()
                ids, marks = (b.column(c).slice(at, n).to_pylist() for c in ("doc_id", "text_hash"))
                rows = []
                for i in range(n):
                    g = textstats.shingles(w[s.first[i]:s.first[i + 1]], words)
                    r = ranks.value[(g >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64)
                    k = np.unique((r << np.uint64(56)) | (g & np.uint64(_LOW))).astype(np.int64)
                    d = int.from_bytes(hashlib.blake2b(k.tobytes(), digest_size=8).digest(), "big") >> 1
                    if wanted is not None and not wanted.value[d % SLOTS >> 3] >> (d & 7) & 1:
                        continue
                    size, bits = len(k), None
                    if d in seen or not size:
                        k = None
                    elif wanted is None:
                        bits = parity_bits(k)
                        k = k[:size - -(-percent * size // 100) + 1]
                    rows.append((ids[i], marks[i], d, size, k, bits))
                    if len(seen) < 500_000:
                        seen.add(d)
                if rows:
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]),
                                                      pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                                                      pa.array([r[5] for r in rows], pa.binary())], ["doc_id", "text_hash", "sid", "n", "keys", "parity"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, sid long, n long, keys array<long>, parity binary")


SHARED = "gram long, sid long, n long, pos long, x1 long, n1 long, p1 long"


def _shared_heads(heads: DataFrame) -> DataFrame:
    """The rows of ``heads(gram, pos, sid, n)`` whose shingle several sets
    have in their heads, with the set of earliest position.  Rows come
    sorted by shingle, position and set; of a repeated (shingle, set) one row
    stays.  Only the first row of a shingle is held."""

    def run(batches):
        names = ["gram", "sid", "n", "pos"]
        key, first, shared = None, None, False
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in names]
            gram, sid = cols[0], cols[1]
            again = np.zeros(len(gram), bool)
            again[1:] = (gram[1:] == gram[:-1]) & (sid[1:] == sid[:-1])
            start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            end = np.append(start[1:], len(gram))
            # runs of one row inside the batch are dropped at once
            look = np.flatnonzero((end - start > 1) | (start == 0) | (end == len(gram)))
            rows: list[tuple] = []
            for lo, hi in zip(start[look].tolist(), end[look].tolist()):
                if gram[lo] != key:
                    key, first, shared = gram[lo], None, False
                for i in range(lo, hi):
                    if again[i]:
                        continue
                    r = tuple(int(c[i]) for c in cols)
                    if first is None:
                        first = r
                    elif r[1] != first[1]:
                        if not shared:
                            rows.append((*first, *first[1:]))
                            shared = True
                        rows.append((*r, *first[1:]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [x.split()[0] for x in SHARED.split(", ")])

    return heads.select("gram", "sid", "n", "pos").mapInArrow(run, SHARED)


def _oriented(pairs: DataFrame, percent: int) -> DataFrame:
    return (pairs.where("x <> y").where(f"100 * least(nx, ny) >= {percent} * greatest(nx, ny)")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                    F.when(F.col("x") < F.col("y"), F.col("nx")).otherwise(F.col("ny")).alias("na"),
                    F.when(F.col("x") < F.col("y"), F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct())


SLOTS = 1 << 24


def _bitmap(needed: DataFrame) -> np.ndarray:
    """Slots of the sids as a bitmap, 2 MB at any size."""
    parts = (needed.select(F.pmod("sid", F.lit(SLOTS)).alias("s")).groupBy(F.expr("s div 32768").alias("k"))
             .agg(F.expr("bitmap_construct_agg(s % 32768)").alias("bits")).collect())
    bits = np.zeros((SLOTS // 32768, 4096), np.uint8)
    for r in parts:
        bits[r.k, :len(r.bits)] = np.frombuffer(r.bits, np.uint8)
    return bits.ravel()


PAIRS = "a long, b long, na long, nb long"


def possible(pairs: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` that the bitmaps of ``parity(sid, parity)`` leave open.
    With d keys in one set only, the overlap is (na + nb - d) / 2 and the
    union (na + nb + d) / 2, so no link is lost."""

    def run(batches):
        for b in batches:
            na, nb = (b.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            d = np.fromiter((differing(x, y) for x, y in zip(b.column("pa").to_pylist(), b.column("pb").to_pylist())), np.int64, b.num_rows)
            yield b.select(["a", "b", "na", "nb"]).filter(pa.array(d * (100 + percent) <= (100 - percent) * (na + nb)))

    left, right = (parity.select(F.col("sid").alias(c), F.col("parity").alias(f"p{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(run, PAIRS)


def verified(pairs: DataFrame, sets_of, cuts: list[int], percent: int) -> DataFrame:
    """The pairs ``(a, b)`` with ``100 * overlap >= percent * union``; the
    overlap is the sum of the fragments' overlaps.  ``sets_of`` gives the
    sets of the sids in a bitmap (and some others, which the join drops);
    they are made anew from the texts, which costs less than to keep all."""
    pairs = staged(pairs, "pairs")
    needed = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    edge = [0, *cuts, (1 << 63) - 1]
    part = [F.struct(F.lit(i).alias("fragment"), F.expr(f"filter(keys, k -> k >= {lo} and k < {hi})").alias("keys"))
            for i, (lo, hi) in enumerate(zip(edge, edge[1:]))]
    own = staged(sets_of(_bitmap(needed)).where("keys is not null").select("sid", "keys").dropDuplicates(["sid"]), "needed-sets")
    seg = own.select("sid", F.explode(F.array(*part)).alias("s")).select("sid", "s.fragment", "s.keys").where("size(keys) > 0")
    left, right = (seg.select(F.col("sid").alias(c), "fragment", F.col("keys").alias(f"k{c}")) for c in "ab")
    counted = (pairs.join(left, "a").join(right, ["b", "fragment"])
               .groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("ka", "kb"))).alias("overlap")))
    return counted.where(f"100 * overlap >= {percent} * (na + nb - overlap)").select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, fragments: int = 4) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs(doc_id, text)``;
    see ``marked_rows``."""
    return marked_rows(docs, words, percent, fragments).select("doc_id", "n_shingles", "component_id")


def text_hash(col):
    """Identity of a text beside its row's doc_id."""
    return F.xxhash64(col.cast("string"))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with one row of each component of
    ``marked_rows``: that with the smallest doc_id (ids before nulls), then
    the smallest text hash.  Of rows that repeat both, one stays, whatever
    their other columns hold.  Rows without words and without an id are
    copies of nothing and all stay."""
    ident = lambda c: F.coalesce(F.col(c).cast("long").cast("string"), F.lit(""))
    gone = (marked_rows(docs, words, percent).where("not first").select(ident("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).distinct())
    lone = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    hidden, back = veiled(docs, docs.columns)
    d = docs.select(*hidden, F.when(lone, F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))).otherwise(ident("doc_id")).alias("id_"),
                    text_hash(F.col("text")).alias("hash_"), (F.xxhash64(*rest) if rest else F.lit(0)).alias("order_"))
    once = d.withColumn("nth_", F.row_number().over(Window.partitionBy("id_", "hash_").orderBy("order_"))).where("nth_ = 1")
    return once.join(gone, ["id_", "hash_"], "left_anti").select(*back)


def marked_rows(docs: DataFrame, words: int = 5, percent: int = 80, fragments: int = 4) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, first`` per row of
    ``docs(doc_id, text)``.

    Two documents link where the overlap of their sets is at least
    ``percent`` hundredths of the union.  A text with fewer than ``words``
    words is one shingle; null and empty texts have no set and stay alone.
    ``component_id`` is the smallest doc_id reachable; a row with a null
    doc_id has none (null) unless documents with ids are reachable.  Rows that
    repeat a doc_id are judged each by its own text.  ``first`` marks the row
    that stands for its component, by smallest doc_id (ids before nulls) and
    then text hash, with all rows that repeat both; a row without a set stands
    for itself.  An empty table gives no rows; extra columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash(F.col("text")).alias("text_hash"))
    table = _counting_table(d.select("text"), words)
    ranks = spark.sparkContext.broadcast(_ranks(table))
    rows = staged(ordered_sets(d, words, ranks, percent), "heads")
    heads = rows.where("keys is not null").select("sid", "n", F.posexplode("keys").alias("pos", "gram"))
    heads = staged(_shared_heads(heads.repartition("gram").sortWithinPartitions("gram", "pos", "sid")), "shared-heads")

    # one bitmap of each set, and only of those with a shared shingle
    parity = staged(rows.where("parity is not null").select("sid", "parity").join(heads.select("sid").distinct(), "sid", "left_semi")
                    .dropDuplicates(["sid"]), "parity")

    def sets_of(bits):
        return ordered_sets(d, words, ranks, percent, spark.sparkContext.broadcast(bits))

    # the first shared shingle leaves room for the overlap that the threshold asks for
    room = (F.least(F.col("nx") - F.col("posx"), F.col("ny") - F.col("posy")) * (100 + percent) >= percent * (F.col("nx") + F.col("ny")))
    tries = heads.select(F.col("sid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("posx"), F.col("x1").alias("y"),
                         F.col("n1").alias("ny"), F.col("p1").alias("posy")).where(room)
    cuts = pivots(table, fragments)
    links = staged(verified(possible(_oriented(tries, percent), parity, percent), sets_of, cuts, percent), "links")
    comp = connected_components(links)
    c = heads.join(comp, heads.sid == comp.node, "left").select("gram", "sid", "n", "pos", F.coalesce("component", "sid").alias("c"))
    mixed = c.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("gram")
    m = c.join(mixed, "gram", "left_semi")
    x, y = (m.select("gram", *[F.col(k).alias(f"{k}{s}") for k in ("sid", "n", "pos", "c")]) for s in "xy")
    rest = x.join(y, "gram").where((F.col("cx") < F.col("cy")) & room).select(F.col("sidx").alias("x"), F.col("sidy").alias("y"), "nx", "ny")
    more = staged(verified(possible(_oriented(rest, percent), parity, percent), sets_of, cuts, percent), "links")
    comp = connected_components(links.unionAll(more))
    least = rows.groupBy("sid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least"))
    named = (least.join(comp, least.sid == comp.node, "left").select("sid", F.coalesce("component", "sid").alias("c"), "least"))
    low = named.groupBy("c").agg(F.min("least").alias("least"))
    to = named.drop("least").join(low, "c").select("sid", "least")
    bare = F.col("n_shingles") == 0
    return (rows.select("doc_id", "text_hash", "sid", F.col("n").alias("n_shingles")).join(to, "sid")
            .select("doc_id", "text_hash", "n_shingles", F.when(bare, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                    (bare | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash")))).alias("first")))
