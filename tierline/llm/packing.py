"""Mixture-controlled packing (operator 9).

Each source is a queue of documents, served in runs of ``RUN`` tokens.
Deficit round-robin credits every queue its share of a round's window of
tokens, serves a run once the queue's credit covers it, and carries the rest
to the next round.  With shares equal to the queues' own totals all queues run
dry together, and a run's round follows from its place in the queue alone: the
credit reaches token ``t`` of ``T`` after that share of all rounds.  (A queue
starts with credit for a part of a run that depends on its name, so that small
queues do not all wait for the same round.)  Other weights make the rounds
fall into phases, which end as a weighted queue runs dry; sources without a
weight then share one group's part of the phases, each in proportion to its
own total.

So every run gets its round by itself, in the task that holds its document,
whatever the number of sources.  Runs are ordered by round, source and place;
their places in the packed stream are prefix sums, taken over rounds, over
blocks of rounds and within a round, so no task sees them all, and the carried
deficits hold across windows and partitions.

The stream is cut every ``length`` tokens into sequences.  Only the last one
is short; it is padded to a power of two.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.shared import ship, staged
from tierline.llm.units import encoder

IDS = "part int, row long, queue string, doc_id long, n long, local_start long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
PHASE = [("start", "double"), ("stop", "double"), ("first", "long"), ("rounds", "long")]
#: All sources without a weight, as one queue of the schedule.
REST = ""
#: Fixed value: a queue is served whole runs of so many tokens, its last one excepted.
RUN = 256
#: Bytes of ids whose pieces are cut at once, and four times those of the texts encoded at once.  A task's arrays take
#: some twenty times the texts, twice per executor and beside a JVM that earlier stages have filled.
SLICE = 4 << 20
#: Rounds whose starts one task sums up.
BLOCK = 4096


def encode_documents(docs: DataFrame, vocab_path: str, end_id: int, source: str = "source") -> DataFrame:
    """Token ids of each document, kept in the shared folder in 16 bits where
    the vocabulary allows it and 32 else.  ``row`` numbers the rows of a part;
    ``local_start`` counts the tokens of the same source before it in the same
    part.  Null text is empty; a null source is a queue."""
    ship(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("queue"))
    return staged(d.mapInArrow(_encode(vocab_path, end_id), IDS), "packed-ids")


def _encode(vocab_path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        enc, part, seen, row = encoder(vocab_path, False), TaskContext.get().partitionId(), {}, 0
        kind = id_type(enc.vocab)
        for b in batches:
            texts, ids_col, src = b.column("text"), b.column("doc_id").to_pylist(), b.column("queue").to_pylist()
            for at, n, ids, counts in enc.encode_rows(texts, SLICE // 4):
                ends = np.cumsum(counts)
                raw = np.insert(ids, ends, end_id).astype(kind).tobytes()
                sizes = (counts + 1).tolist()
                stops = (np.cumsum(counts + 1) * kind.itemsize).tolist()
                starts, names, first = [], src[at:at + n], 0
                for q, k in zip(names, sizes):
                    starts.append(seen.get(q, 0))
                    seen[q] = starts[-1] + k
                cells = []
                for stop in stops:
                    cells.append(raw[first:stop])
                    first = stop
                yield _batch([[part] * n, list(range(row, row + n)), names, ids_col[at:at + n], sizes, starts, cells], IDS)
                row += n
        # workers stay for later stages, whose memory this one's caches would take
        enc.release()

    return run


def id_type(vocab: int) -> np.dtype:
    return np.dtype("<u2" if vocab <= 1 << 16 else "<u4")


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds)], list(names))


def schedule(totals: dict[str, int], window: int, weights: dict[str, float] | None = None) -> list[tuple[int, dict[str, int]]]:
    """Phases ``(rounds, tokens served per queue)`` of the round-robin.  A
    phase ends when a queue with a share is dry; queues without a weight have
    the share of their total.  The weighted queues share their totals among
    them by weight, so both kinds of shares are in tokens; a weight of 0 is
    served last."""
    left = {q: t for q, t in sorted(totals.items()) if t > 0}
    given = {q: float(w) for q, w in (weights or {}).items() if q in left}
    unit = sum(left[q] for q, w in given.items() if w > 0) / (sum(given.values()) or 1.0)
    share = {q: given[q] * unit if q in given else float(left[q]) for q in left}
    phases = []
    while left:
        live = {q: share[q] for q in left if share[q] > 0} or {q: float(left[q]) for q in left}
        total = sum(live.values())
        if not given or len(live) == 1:
            served = {q: left[q] for q in live}
            rounds = max(1, -(-sum(served.values()) // window))
        else:
            rounds = max(1, int(min(left[q] * total / (window * w) for q, w in live.items())))
            served = {q: min(left[q], int(rounds * window * w / total)) for q, w in live.items()}
            dry = min(live, key=lambda q: left[q] * total / (window * live[q]))
            served[dry] = left[dry]
        phases.append((rounds, {q: n for q, n in served.items() if n}))
        left = {q: left[q] - served.get(q, 0) for q in left if left[q] > served.get(q, 0)}
    return phases


def timetable(phases: list[tuple[int, dict[str, int]]], totals: dict[str, int]) -> dict[str, list[tuple[float, float, int, int]]]:
    """Per queue ``(share of its tokens served before, after, first round,
    rounds)`` of each phase that serves it."""
    out: dict[str, list[tuple[float, float, int, int]]] = {q: [] for q in totals}
    done, at = dict.fromkeys(totals, 0), 0
    for rounds, served in phases:
        for q, n in served.items():
            out[q].append((done[q] / totals[q], (done[q] + n) / totals[q], at, rounds))
            done[q] += n
        at += rounds
    return out


def round_of(run: Column, total: Column, queue: Column, times: Column) -> Column:
    """Round of a run of a queue: that in which the credit reaches the run's
    own part of its tokens.  Doubles are monotonous, so runs of one queue keep
    their order, and any rounding moves a run by one round at most."""
    size = F.least(F.lit(RUN), total - run * RUN)
    # the queue's lead, the same for all its runs
    lead = F.crc32(queue.cast("binary")) % RUN / F.lit(float(RUN))
    share = (run * RUN + size * lead) / total
    phase = F.get(F.filter(times, lambda p: (share < p["stop"]) | (p["stop"] >= 1)), F.lit(0))
    within = F.greatest(F.lit(0.0), (share - phase["start"]) / (phase["stop"] - phase["start"]))
    return phase["first"] + F.least(phase["rounds"] - 1, F.floor(within * phase["rounds"]))


def placed_runs(runs: DataFrame) -> DataFrame:
    """``queue, run, place`` of ``runs(queue, run, round, size)``: the tokens
    of all runs before it, by round, queue and run.  A round holds a window of
    tokens; a block ``BLOCK`` rounds; blocks are one row each."""
    runs = staged(runs, "packed-runs")
    rounds = staged(runs.groupBy("round").agg(F.sum("size").alias("tokens")).withColumn("block", F.expr(f"round div {BLOCK}")), "packed-rounds")
    up_to = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    blocks = rounds.groupBy("block").agg(F.sum("tokens").alias("tokens"))
    blocks = blocks.select("block", F.coalesce(F.sum("tokens").over(up_to(Window.orderBy("block"))), F.lit(0)).alias("block_start"))
    starts = (rounds.withColumn("before", F.coalesce(F.sum("tokens").over(up_to(Window.partitionBy("block").orderBy("round"))), F.lit(0)))
              .join(blocks, "block").select("round", (F.col("block_start") + F.col("before")).alias("round_start")))
    within = F.coalesce(F.sum("size").over(up_to(Window.partitionBy("round").orderBy("queue", "run"))), F.lit(0))
    return (runs.withColumn("within", within).join(starts, "round")
            .select("queue", "run", (F.col("round_start") + F.col("within")).alias("place")))


def pack(docs: DataFrame, vocab_path: str, end_id: int, length: int = 2048, window_sequences: int = 64,
         weights: dict[str, float] | None = None, with_ids: bool = True) -> DataFrame:
    """Pack ``docs(doc_id, text, source)`` into sequences of ``length`` ids.

    A row per piece, with its ids (unsigned 32-bit, little-endian) unless
    ``with_ids`` is off.  Every id
    of every row lies in exactly one piece; ``weights`` are target token
    shares by source, relative to each other (default: the sources' own).
    Every source has a queue of its own, however many there are.  Repeated
    rows are packed as often as they occur; an empty table gives none; other
    columns are ignored.  The driver gets the total, and those of the sources
    with weights; ids are shuffled once, by document."""
    spark = docs.sparkSession
    ids = encode_documents(docs, vocab_path, end_id)
    # a small row per part and source
    per = staged(ids.groupBy("part", "queue").agg(F.sum("n").alias("n")), "queue-totals")
    own = {f"s{q}": float(w) for q, w in (weights or {}).items()}
    named = F.col("queue").isin(list(own)) if own else F.lit(False)
    totals = {r.queue: int(r.n) for r in per.where(named).groupBy("queue").agg(F.sum("n").alias("n")).collect()} if own else {}
    rest = int(per.where(~named).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    totals |= {REST: rest} if rest else {}
    kept = {q: w for q, w in own.items() if q in totals}
    times = timetable(schedule(totals, length * window_sequences, kept or None), totals)
    # an entry per weight given, and one
    entries = {q: F.array(*[F.struct(*[F.lit(v).cast(t).alias(k) for v, (k, t) in zip(p, PHASE)]) for p in parts]) for q, parts in times.items()}
    phases = entries.get(REST, F.lit(None).cast("array<struct<start: double, stop: double, first: long, rounds: long>>"))
    for q in kept:
        phases = F.when(F.col("queue") == q, entries[q]).otherwise(phases)
    source = Window.partitionBy("queue")
    before = source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(source).alias("total"))
    first = F.col("base") + F.col("local_start")
    meta = (ids.select("part", "row", "queue", "n", "local_start").join(base, ["part", "queue"])
            .select("part", "row", "queue", "n", first.alias("first"), "total"))
    runs = meta.withColumn("run", F.explode(F.sequence(F.expr(f"first div {RUN}"), F.expr(f"(first + n - 1) div {RUN}"))))
    # a run belongs to the document with its first token
    own_runs = runs.where(F.col("run") * RUN >= F.col("first"))
    places = placed_runs(own_runs.select("queue", "run", round_of(F.col("run"), F.col("total"), F.col("queue"), phases).alias("round"),
                                         F.least(F.lit(RUN), F.col("total") - F.col("run") * RUN).alias("size")))
    lo, hi = F.greatest(F.col("run") * RUN, F.col("first")), F.least((F.col("run") + 1) * RUN, F.col("first") + F.col("n"))
    cuts = (runs.join(places, ["queue", "run"])
            .groupBy("part", "row").agg(F.collect_list(F.struct(
                (lo - F.col("first")).alias("start"), (hi - lo).alias("size"), (F.col("place") + lo - F.col("run") * RUN).alias("place"))).alias("cuts")))
    return ids.select("part", "row", "doc_id", "n", "ids").join(cuts, ["part", "row"]).select("doc_id", "n", "ids", "cuts").mapInArrow(
        _cut(length, with_ids), PIECES if with_ids else PIECES.removesuffix(", ids binary"))


def pieces(start: np.ndarray, size: np.ndarray, place: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``doc, start, length, place`` of the pieces of documents' cuts: cuts
    that follow each other in the stream are one, and pieces end where
    sequences do.  Pieces come by document and start."""
    order = np.lexsort((start, doc))
    start, size, place, doc = start[order], size[order], place[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + size[:-1])
    at = np.flatnonzero(new)
    start, place, doc, size = start[at], place[at], doc[at], np.add.reduceat(size, at) if len(at) else size
    first = place // length
    count = (place + size - 1) // length - first + 1
    of = np.repeat(np.arange(len(doc)), count)
    seq = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    lo, hi = np.maximum(place[of], seq * length), np.minimum(place[of] + size[of], (seq + 1) * length)
    return doc[of], start[of] + lo - place[of], hi - lo, lo


def _cut(length: int, with_ids: bool):
    def cut(batches):
        for b in batches:
            width = pc.binary_length(b.column("ids")).to_numpy(zero_copy_only=False).astype(np.int64)
            n = b.column("n").to_numpy(zero_copy_only=False)
            ends = np.cumsum(width)
            at = 0
            while at < b.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
                yield _piece_batch(b.slice(at, end - at), n[at:end], width[at:end], length, with_ids)
                at = end

    return cut


def _piece_batch(b: pa.RecordBatch, n: np.ndarray, width: np.ndarray, length: int, with_ids: bool) -> pa.RecordBatch:
    cuts = b.column("cuts")
    doc = np.repeat(np.arange(b.num_rows), pc.list_value_length(cuts).to_numpy(zero_copy_only=False))
    flat = cuts.flatten()
    doc, start, size, place = pieces(*(flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "size", "place")), doc, length)
    kind = np.dtype("<u2" if width.sum() == 2 * n.sum() else "<u4")
    ids = np.frombuffer(b"".join(b.column("ids").to_pylist()), kind).astype("<u4")
    # the pieces of a document cover it in order, so together they are all ids in order
    stops = 4 * np.cumsum(size)
    view, spans = memoryview(ids).cast("B"), zip((stops - 4 * size).tolist(), stops.tolist())
    sums = [zlib.crc32(view[i:j]) for i, j in spans]
    rows = pa.array(doc)
    columns = [b.column("doc_id").take(rows), pa.array(start), pa.array(size), pa.array(sums, pa.int64()), b.column("n").take(rows),
               pa.array(place // length), pa.array(place % length)]
    names = [c.split()[0] for c in PIECES.split(", ")]
    if with_ids:
        offsets = np.concatenate([[0], stops]).astype(np.int32)
        columns.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]))
    return pa.RecordBatch.from_arrays(columns, names[:len(columns)])
