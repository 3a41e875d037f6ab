"""Token-id files: fixed-width bit packing with block offsets (operator 1).

Layout of a file, all integers little-endian:

* header: magic ``TKID0001``, then 32-bit width in bits, ids per block and
  the vocabulary size;
* blocks: ``ids per block`` ids each (the last may be shorter), every id in
  the minimum number of bits the vocabulary needs, low bit first, a block
  padded to whole bytes;
* index: per document its id (64-bit), a flag for a null id (8-bit) and its
  number of ids (64-bit); per block its byte offset (64-bit);
* trailer: byte offset of the index, documents, blocks, ids (64-bit each) and
  the magic again.

``TokenFile.ids(start, n)`` reads only the blocks that hold the range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import attempt_file, open_input, open_output, ship, staged, work_dir
from tierline.llm.units import encoder

MAGIC = b"TKID0001"
_HEAD, _TAIL = struct.Struct("<8sIII"), struct.Struct("<qqqq8s")


def width_of(vocab: int) -> int:
    """Bits that hold every id below ``vocab``."""
    return max(1, int(vocab - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width).reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


class TokenFileWriter:
    """Streams ids into blocks; holds one open block and the index."""

    def __init__(self, out, vocab: int, block: int = 1 << 16):
        self.out, self.width, self.block = out, width_of(vocab), block
        self.out.write(_HEAD.pack(MAGIC, self.width, block, vocab))
        self.at = _HEAD.size
        self.open: list[np.ndarray] = []
        self.held = 0
        self.blocks: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_ids = self.n_docs = 0

    def _flush(self, ids: np.ndarray) -> None:
        data = pack(ids, self.width)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((doc_ids.astype("<i8"), nulls.astype(np.uint8), counts.astype("<i8")))
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            every = np.concatenate(self.open)
            full = len(every) // self.block * self.block
            for k in range(0, full, self.block):
                self._flush(every[k:k + self.block])
            self.open, self.held = [every[full:].copy()], len(every) - full

    def close(self) -> None:
        if self.held:
            self._flush(np.concatenate(self.open))
        for k in range(3):
            for part in self.docs:
                self.out.write(part[k].tobytes())
        self.out.write(np.array(self.blocks, "<i8").tobytes())
        self.out.write(_TAIL.pack(self.at, self.n_docs, len(self.blocks), self.n_ids, MAGIC))
        self.out.close()


class TokenFile:
    """Random access to a token file."""

    def __init__(self, f):
        self.f = f
        size = f.size()
        magic, self.width, self.block, self.vocab = _HEAD.unpack(f.read_at(_HEAD.size, 0))
        index, self.n_docs, n_blocks, self.n_ids, tail = _TAIL.unpack(f.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError("not a token file")
        at = index
        self.doc_ids = np.frombuffer(f.read_at(8 * self.n_docs, at), "<i8")
        at += 8 * self.n_docs
        self.nulls = np.frombuffer(f.read_at(self.n_docs, at), np.uint8)
        at += self.n_docs
        self.counts = np.frombuffer(f.read_at(8 * self.n_docs, at), "<i8")
        at += 8 * self.n_docs
        self.offsets = np.frombuffer(f.read_at(8 * n_blocks, at), "<i8")

    def read_block(self, k: int) -> np.ndarray:
        n = min(self.block, self.n_ids - k * self.block)
        return unpack(self.f.read_at((n * self.width + 7) // 8, int(self.offsets[k])), n, self.width)

    def ids(self, start: int, n: int) -> np.ndarray:
        if n <= 0:
            return np.zeros(0, np.uint32)
        lo, hi = start // self.block, (start + n - 1) // self.block
        got = np.concatenate([self.read_block(k) for k in range(lo, hi + 1)])
        return got[start - lo * self.block:][:n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc id, start in the file, ids)`` in file order; consecutive
        documents share the block that is in memory."""
        starts = np.cumsum(self.counts) - self.counts
        have, k0, k1 = np.zeros(0, np.uint32), 0, 0
        for d, null, s, n in zip(self.doc_ids.tolist(), self.nulls.tolist(), starts.tolist(), self.counts.tolist()):
            lo, hi = s // self.block, max(s, s + n - 1) // self.block
            if n and (lo < k0 or hi >= k1):
                keep = have[(lo - k0) * self.block:] if k0 <= lo < k1 else have[:0]
                new = [self.read_block(k) for k in range(max(lo, k1) if len(keep) else lo, hi + 1)]
                have, k0, k1 = np.concatenate([keep, *new]), lo, hi + 1
            yield None if null else d, s, have[s - k0 * self.block:][:n] if n else have[:0]


#: Bytes of text that a task encodes at once; the arrays made of them take some twenty times as much.
SLICE = 2_000_000
MANIFEST = "part int, path string, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, vocab_path: str, folder: str, end_id: int = 0, block: int = 1 << 16) -> DataFrame:
    """Write ``docs(doc_id, text)`` as token files in ascending doc_id order.

    One file per range of doc_ids; the returned manifest has a row per file
    (``part`` ascends with the ids).  A null text is empty and still gets the
    end id; null ids come first; rows with one doc_id are ordered by a hash
    of their text; an empty table gives no file.  A file counts only once its
    manifest row is committed, so a retried task leaves no half file."""
    spark = docs.sparkSession
    ship(spark)

    def write(batches):
        enc, out, writer, path = encoder(vocab_path, True), None, None, None
        for b in batches:
            ids_col, texts = b.column("doc_id"), b.column("text")
            for at, n, ids, counts in enc.encode_rows(texts, SLICE):
                if writer is None:
                    path = attempt_file(folder, ".tkid")
                    out = open_output(path)
                    writer = TokenFileWriter(out, enc.vocab, block)
                ends = np.cumsum(counts)
                col = ids_col.slice(at, n)
                writer.add(col.fill_null(0).to_numpy(zero_copy_only=False), col.is_null().to_numpy(zero_copy_only=False),
                           counts + 1, np.insert(ids, ends, end_id))
        # what the task met would stay with the worker, beside the JVM that needs the memory next
        enc.release()
        if writer is not None:
            writer.close()
            from pyspark import TaskContext

            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [path],
                "n_docs": pa.array([writer.n_docs], pa.int64()), "n_tokens": pa.array([writer.n_ids], pa.int64())})

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    return staged(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.
    ``start`` counts all ids before it over all files (a running sum over one
    manifest row per file)."""
    spark = manifest.sparkSession
    ship(spark)

    def read(batches):
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                with open_input(path) as f:
                    rows = []
                    for d, s, ids in TokenFile(f).documents():
                        rows.append((d, base + s, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        if len(rows) == 20_000:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    n = manifest.count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return files.select("path", "base").repartition(max(1, n)).mapInArrow(read, ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_files(docs: DataFrame, vocab_path: str, end_id: int = 0) -> DataFrame:
    """Write the files into a new shared folder and read them back."""
    return read_token_files(write_token_files(docs, vocab_path, work_dir(docs.sparkSession, "token-files"), end_id))
