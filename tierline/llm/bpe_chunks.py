"""Byte-level BPE by overlapping chunks (operator 4).

A text of one chunk is encoded where it lies.  A longer one is cut into
chunk rows that overlap, spread over tasks.  Each task pre-tokenises its
chunk from the chunk's first character on and gives the boundaries in the
overlap with the next chunk, and in its own head.  A boundary that both sides
have, behind a non-space, is where the two resynchronise: from there on both
cut alike, since the pattern looks at nothing to the left and looks ahead only
from white space.  That holds if the left side is itself in step with the
text, so a chunk that did not resynchronise with its left neighbour stitches
to its right one only at a boundary before a space, which no alternative of
the usual patterns crosses.  Neighbours without a stitch are joined into one
run.  The runs are encoded one by one where their chunks lie, unless they
have several; only ids, in two bytes where the vocabulary allows, travel to
the task that puts a text's runs together and decodes them.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import ship

CHUNKS = "doc_id long, d long, h long, chunk_no int, own int, n long, body string"
CUTS = "d long, h long, chunk_no int, n long, head array<int>, tail array<int>"
RUNS = "doc_id long, d long, h long, run long, copies long, ids binary"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_LOADED: dict[tuple, object] = {}


class Codec:
    """Ranks of a vocabulary file; encoding and decoding of raw bytes."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.text = {i: b"%d" % i for i in ranks.values()}
        self.bytes = {i: t for t, i in ranks.items()}
        #: how ids travel between tasks
        self.wire = np.dtype("<u2" if max(self.bytes, default=0) < 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        return self.enc.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decimal(self, ids: list[int]) -> bytes:
        return b" ".join(map(self.text.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


#: Characters before a cut in which a boundary may be the cut's own doing.
MARGIN = 4


def boundaries(text: str, pattern: str, whole: bool = True) -> list[int]:
    """Ends of the pattern's matches that lie behind a non-space; in a body
    that is cut off (not ``whole``) without those next to the cut."""
    import regex

    most = len(text) if whole else len(text) - MARGIN
    return [e for m in regex.finditer(pattern, text) if (e := m.end()) <= most and not text[e - 1].isspace()]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), kinds[k]) for x, (_, k) in zip(zip(*rows), named)], [c for c, _ in named])


def chunked(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows ``CHUNKS`` of ``texts(doc_id, d, h, text)``: ``own`` characters
    of the chunk and up to ``overlap`` of the next one as ``body``; ``n``
    equal rows met in one Arrow batch are cut once."""

    def cut(batches):
        for b in batches:
            first: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_id", "d", "h")))):
                first.setdefault(key, [i, 0])[1] += 1
            rows, held = [], 0
            for key, (i, n) in first.items():
                t = b.column("text")[i].as_py()
                for k, lo in enumerate(range(0, len(t), chunk)):
                    rows.append((*key, k, min(chunk, len(t) - lo), n, t[lo:lo + chunk + overlap]))
                    held += len(rows[-1][-1])
                    if held > 4_000_000:
                        yield _batch(rows, CHUNKS)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, CHUNKS)

    # the condition that a join on them would add, put here so that all readers share one exchange
    return (texts.mapInArrow(cut, CHUNKS).where("d is not null and h is not null and chunk_no is not null")
            .repartition("d", "h", "chunk_no"))


def stitched(chunks: DataFrame, pattern: str, overlap: int) -> DataFrame:
    """Chunk rows with the runs they belong to and, in each, the characters
    that are its part: ``(doc_id, d, h, run, alone, copies, chunk_no, n, part)``.
    ``alone`` tells that a run has one chunk."""

    def cuts(batches):
        for b in batches:
            rows = []
            for d, h, k, own, n, t in zip(*(b.column(c).to_pylist() for c in ("d", "h", "chunk_no", "own", "n", "body"))):
                # a boundary before a space is given as a negative number
                every = [-x if t[x:x + 1] == " " else x for x in boundaries(t, pattern, len(t) < own + overlap)]
                rows.append((d, h, k, n, [x for x in every if abs(x) <= overlap], [x - own if x > 0 else x + own for x in every if abs(x) > own]))
            if rows:
                yield _batch(rows, CUTS)

    found = (chunks.mapInArrow(cuts, CUTS).repartition("d", "h").groupBy("d", "h", "chunk_no")
             .agg(F.sum("n").alias("copies"), F.any_value("head").alias("head"), F.any_value("tail").alias("tail")))
    order = Window.partitionBy("d", "h").orderBy("chunk_no")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    none = F.array().cast("array<int>")
    at = (found.withColumn("both", F.array_intersect("head", F.coalesce(F.lag("tail").over(order), none)))
          .withColumn("any", F.array_min(F.transform("both", F.abs)))
          .withColumn("sure", F.array_min(F.transform(F.filter("both", lambda x: x < 0), F.abs)))
          # in step: the last of the chunks so far with a sure boundary or none at all had a sure one
          .withColumn("step", F.last(F.when(F.col("sure").isNotNull() | (F.col("chunk_no") == 0), True).when(F.col("any").isNull(), False), True).over(upto))
          .withColumn("sync", F.when(F.lag("step").over(order), F.col("any")).otherwise(F.col("sure")))
          .withColumn("run", F.sum(F.col("sync").isNotNull().cast("long")).over(upto))
          .withColumn("next", F.lead("sync").over(order))
          .withColumn("alone", F.count("*").over(Window.partitionBy("d", "h", "run")) == 1)
          .select(F.col("d").alias("d_"), F.col("h").alias("h_"), F.col("chunk_no").alias("k_"), "run", "alone", "copies",
                  F.coalesce("sync", F.lit(0)).alias("lo"), F.coalesce("next", F.lit(0)).alias("hi")))
    same = (F.col("d") == F.col("d_")) & (F.col("h") == F.col("h_")) & (F.col("chunk_no") == F.col("k_"))
    return (chunks.join(at.hint("shuffle_hash"), same)
            .select("doc_id", "d", "h", "run", "alone", "copies", "chunk_no", "n", F.expr("substring(body, lo + 1, own + hi - lo)").alias("part")))


def encode_decode(docs: DataFrame, vocab_path: str, pattern: str, chunk: int = 4096, overlap: int = 256) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: number of ids, SHA-256 of their
    decimal text and of the decoded bytes.  A null text is empty.  Repeated
    rows give repeated results; a long text that occurs in several rows with
    one id is put together once for all of them.  Extra columns are ignored."""
    if not 2 * MARGIN <= overlap <= chunk:
        raise ValueError(f"overlap must lie between {2 * MARGIN} and the chunk's {chunk} characters")
    ship(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def short(batches):
        c = codec(vocab_path, pattern)
        for b in batches:
            n, ids_sha, raw_sha = [], [], []
            for t in b.column("text").to_pylist():
                ids = c.encode(t)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(c.decimal(ids)).hexdigest())
                raw_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def runs(batches):
        c = codec(vocab_path, pattern)
        key, no, parts = None, -1, []

        def done():
            return (*key, zstandard.compress(np.array(c.encode("".join(parts)), c.wire).tobytes(), 1))

        for b in batches:
            rows, held = [], 0
            for *k, chunk_no, part in zip(*(b.column(x).to_pylist() for x in ("doc_id", "d", "h", "run", "copies", "chunk_no", "part"))):
                if k != key:
                    if key is not None:
                        rows.append(done())
                        held += len(rows[-1][-1])
                    key, no, parts = k, -1, []
                if chunk_no != no:  # repeated rows cut in several batches give a chunk several times
                    parts.append(part)
                    no = chunk_no
                if held > 4_000_000:
                    yield _batch(rows, RUNS)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, RUNS)
        if key is not None:
            yield _batch([done()], RUNS)

    def joined(batches):
        c, key, rows = codec(vocab_path, pattern), None, []
        for b in batches:
            for doc, d, h, run, copies, raw in zip(*(b.column(x).to_pylist() for x in ("doc_id", "d", "h", "run", "copies", "ids"))):
                if (d, h) != key:
                    if key is not None:
                        rows += [(own, total, a.hexdigest(), z.hexdigest())] * many
                    key, own, many, no, total, a, z = (d, h), doc, copies, -1, 0, hashlib.sha256(), hashlib.sha256()
                if run == no:
                    continue
                no, ids = run, np.frombuffer(zstandard.decompress(raw), c.wire).tolist()
                if ids:
                    a.update((b" " if total else b"") + c.decimal(ids))
                    z.update(c.decode(ids))
                    total += len(ids)
            if rows:
                yield _batch(rows, DIGEST)
                rows = []
        if key is not None:
            yield _batch([(own, total, a.hexdigest(), z.hexdigest())] * many, DIGEST)

    is_long = F.length("text") > chunk
    small = d.where(~is_long).mapInArrow(short, DIGEST)
    big = d.where(is_long).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("d"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("h"), "text")
    parts = stitched(chunked(big, chunk, overlap), pattern, overlap)
    # n is not needed any more, but a reader without it would shuffle the chunks again
    cols = ["doc_id", "d", "h", "run", "copies", "chunk_no", "n", "part"]
    one = parts.where("alone").select(*cols).mapInArrow(runs, RUNS)
    many = (parts.where("not alone").select(*cols).repartition("d", "h", "run").sortWithinPartitions("d", "h", "run", "chunk_no").mapInArrow(runs, RUNS))
    whole = one.unionAll(many).repartition("d", "h").sortWithinPartitions("d", "h", "run").mapInArrow(joined, DIGEST)
    return small.unionAll(whole)
