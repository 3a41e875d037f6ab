"""WARC archives from a chunked record table (operator 3).

A payload travels as rows ``(record, chunk number, bytes)`` of at most
``chunk`` bytes; writer and reader hold one chunk at a time and carry a
running SHA-256.  The reader's rows give the digest of all chunks so far, so
the last chunk of a record has the digest of the payload.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import attempt_file, open_input, open_output, ship, staged, work_dir

CHUNK = 1 << 20
FILES = "path string, records long, bytes long"
READ = ("page_id long, record_type string, refers_to long, payload_bytes long, declared_digest string, "
        "chunk_no int, chunk binary, digest_so_far string, last boolean")


def record_types(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """``pages`` with payload, its bytes and SHA-256, ``record_type`` and
    ``refers_to``.  Among equal payloads of at least ``min_bytes`` the
    smallest page_id is the response (all rows that bear it, should it be
    repeated; null ids come last) and the others revisit it."""
    p = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                      F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
         .withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256)))
    # only payloads that occur under several ids need a look-up
    first = (p.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # the look-up runs on rows without payload, so its shuffle is small
    kind = (p.where(F.col("payload_bytes") >= min_bytes).select("page_id", "payload_digest").join(first, "payload_digest")
            .where(~F.col("page_id").eqNullSafe(F.col("first_id"))).select("page_id", "payload_digest", "first_id").distinct())
    k = kind.select(F.col("page_id").alias("k_id"), F.col("payload_digest").alias("k_digest"), F.col("first_id").alias("refers_to"))
    out = p.join(k, p.page_id.eqNullSafe(k.k_id) & (p.payload_digest == k.k_digest), "left")
    return (out.withColumn("record_type", F.when(F.col("k_digest").isNotNull(), "revisit").otherwise("response"))
            .drop("k_id", "k_digest"))


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per chunk, in order within its record; a revisit has one empty
    chunk.  Chunks are cut where the record is, and stay in its partition."""
    size = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    n = F.greatest(F.ceil(size / F.lit(chunk)), F.lit(1)).cast("int")
    return (records.withColumn("n_chunks", n).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
            .select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "n_chunks", "chunk_no",
                    F.when(F.col("record_type") == "response",
                           F.expr(f"substring(payload, chunk_no * {chunk} + 1, {chunk})")).otherwise(F.lit(b"")).alias("chunk")))


def _header(kind: str, page, url, refers, size: int, digest: str) -> bytes:
    uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>", f"WARC-Target-URI: {uri}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{'null' if refers is None else refers}>"]
    lines.append(f"Content-Length: {size if kind == 'response' else 0}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write_archives(chunks: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Stream a chunk table into gzip WARC files, one per partition and one
    gzip member per record; returns a row per file.  A payload that does not
    have its declared digest is an error.  No rows, no file."""
    ship(chunks.sparkSession)

    def run(batches):
        out, path, records, size, sha, gz = None, None, 0, 0, None, None
        for r in (r for b in batches for at in range(0, b.num_rows, 64) for r in b.slice(at, 64).to_pylist()):
            if out is None:
                path = attempt_file(folder, ".warc.gz")
                out = open_output(path)
            data = r["chunk"]
            if r["chunk_no"] == 0:
                gz, sha = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha256()
                data_out = gz.compress(_header(r["record_type"], r["page_id"], r["url"], r["refers_to"], r["payload_bytes"], r["payload_digest"]))
                out.write(data_out)
            sha.update(data)
            body = gz.compress(data)
            out.write(body)
            if r["chunk_no"] == r["n_chunks"] - 1:
                if r["record_type"] == "response" and sha.hexdigest() != r["payload_digest"]:
                    raise ValueError(f"payload of page {r['page_id']} does not have its digest")
                out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                records += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return staged(chunks.mapInArrow(run, FILES), "warc-files")


def _members(f, buffer: int = 1 << 15):
    """Decompressed bytes of a gzip file of many members, piece by piece."""
    z, data = zlib.decompressobj(31), f.read(buffer)
    while data:
        got = z.decompress(data)
        if got:
            yield got
        data = z.unused_data if z.eof else b""
        if z.eof:
            z = zlib.decompressobj(31)
        data = data or f.read(buffer)


def read_records(f, chunk: int = CHUNK):
    """Chunk rows of one archive, each with the digest of the record so far."""
    held, stream, done = bytearray(), _members(f), False

    def more() -> bool:
        nonlocal done
        part = next(stream, None)
        if part is None:
            done = True
            return False
        held.extend(part)
        return True

    while True:
        end = held.find(b"\r\n\r\n")
        while end < 0 and more():
            end = held.find(b"\r\n\r\n")
        if end < 0:
            if bytes(held).strip():
                raise ValueError("truncated archive")
            return
        lines = bytes(held[:end]).decode().split("\r\n")
        del held[:end + 4]
        h = dict(x.split(": ", 1) for x in lines[1:])
        ident = lambda v: None if "null" in v else int(v.rsplit(":", 1)[1][:-1])
        left, no, sha = int(h["Content-Length"]), 0, hashlib.sha256()
        fixed = (ident(h["WARC-Record-ID"]), h["WARC-Type"], ident(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None,
                 int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha256:"))
        while True:
            take = min(left, chunk)
            while len(held) < take:
                if not more():
                    raise ValueError("truncated record")
            data = bytes(held[:take])
            del held[:take]
            left -= take
            sha.update(data)
            yield (*fixed, no, data, sha.hexdigest(), left == 0)
            no += 1
            if not left:
                break
        while len(held) < 4:
            if not more():
                raise ValueError("truncated record")
        del held[:4]


def read_archives(files: DataFrame, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """Chunk rows of all archives; ``payload=False`` leaves the bytes out
    after they went into the digest."""
    ship(files.sparkSession)
    names = [x.split()[0] for x in READ.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[x.split()[1]] for x in READ.split(", ")]

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                with open_input(path) as f:
                    rows, held = [], 0
                    for r in read_records(f, chunk):
                        rows.append(r if payload else (*r[:6], None, *r[7:]))
                        held += len(r[6]) if payload else 0
                        if len(rows) >= 5000 or held >= 4 * chunk:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, READ)


def archive(pages: DataFrame, min_bytes: int = 100, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` as archives in a new shared folder and read them back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``.  The
    digest of a response is that of the bytes read; a revisit, which carries
    no payload, gives the one it declares.  Null html is an empty payload."""
    files = write_archives(chunk_table(record_types(pages, min_bytes), chunk), work_dir(pages.sparkSession, "warc"))
    last = read_archives(files, chunk, payload=False).where("last")
    return last.select("page_id", "payload_bytes",
                       F.when(F.col("record_type") == "response", F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
                       "record_type", "refers_to")
