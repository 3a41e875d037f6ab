"""Quality rules by gradient-boosted trees over document statistics
(operator 8)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import gbt, textstats
from tierline.llm.shared import ship, veiled

#: Shares the trees read; the sign says how the score may move with them.
FEATURES = [("symbols", -1), ("dup_lines", -1), ("repeats", -1), ("upper", -1), ("exclaims", -1), ("pipes", -1), ("digits", 0),
            ("distinct", 0), ("mean_word", 0), ("long_words", 0), ("ends", 0), ("log_words", 0), ("words_a_line", 0), ("top_word", -1)]


def features(c: np.ndarray) -> np.ndarray:
    col = {n: c[:, i].astype(float) for i, n in enumerate(textstats.BASE + textstats.MORE)}
    w, ch, ln = np.maximum(col["n_words"], 1), np.maximum(col["n_chars"], 1), np.maximum(col["n_lines"], 1)
    return np.stack([col["n_symbols"] / w, col["n_dup_lines"] / ln, col["n_repeat_words"] / w, col["n_upper"] / np.maximum(col["n_letters"], 1),
                     col["n_exclaim"] / w, col["n_pipe"] / w, col["n_digits"] / ch, col["n_distinct"] / np.sqrt(w), col["word_chars"] / w,
                     col["n_long"] / w, col["n_last_mark"] / w, np.log1p(col["n_words"]), np.log1p(w / ln), col["n_top"] / w], 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``(y, text)`` of at most ``rows`` labelled documents, those with the
    smallest hashes of their ids; a document without a 0/1 label is left out.
    An id counts once however many rows repeat it, with the text of the
    smallest hash."""
    few = (labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(few), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("y", "text")


def fit(docs: DataFrame, labels: DataFrame, rows: int = 6000) -> gbt.Trees | None:
    """Trees fitted on a bounded sample of ``rows`` labelled documents; None
    where the sample lacks one of the classes."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            for at, n in textstats.slices(b.column("text")):
                x = features(textstats.counts(b.column("text").slice(at, n)))
                yield pa.RecordBatch.from_arrays([b.column("y").slice(at, n).cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["y", "x"])

    got = labelled_sample(docs, labels, rows).mapInArrow(run, "y int, x array<double>").collect()
    got = sorted((r.y, tuple(r.x)) for r in got)
    y = np.array([r[0] for r in got], float)
    if len(set(y.tolist())) < 2:
        return None
    return gbt.train(np.array([r[1] for r in got]), y, {i: s for i, (_, s) in enumerate(FEATURES) if s})


ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_score"]


def apply_rules(docs: DataFrame, trees: gbt.Trees | None, least_words: int = 50, repeat_percent: int = 50, threshold: float = 0.5,
                extra: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and the ``extra`` columns of ``docs``) with the counts, the
    base verdict and ``kept``.  Null text has no words and fails.  Without a
    model the base rules decide.  Each row is judged by itself, so repeated
    rows get equal verdicts; an empty table gives none.  The result's own
    columns replace columns of those names."""
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(trees)
    extra = [c for c in (extra or []) if c not in ADDED and c != "doc_id"]

    def run(batches):
        model = held.value
        for b in batches:
            for at, n in textstats.slices(b.column("text_")):
                part = b.slice(at, n)
                c = textstats.counts(part.column("text_"))
                failed = (c[:, 0] < least_words) | (100 * c[:, 4] > repeat_percent * c[:, 0])
                p = 1 / (1 + np.exp(-model.score(features(c)))) if model is not None else np.ones(len(c))
                own = [*(pa.array(c[:, i]) for i in range(5)), pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)]
                names = [x for x in part.schema.names if x != "text_"]
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), *own], [*names, *ADDED])

    hidden, back = veiled(docs, extra)
    d = docs.select("doc_id", *hidden, F.col("text").cast("string").alias("text_"))
    kinds = {"base_failed": "boolean", "kept": "boolean", "quality_score": "double"}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name != "text_"] + [f"{x} {kinds.get(x, 'long')}" for x in ADDED])
    return d.mapInArrow(run, schema).select("doc_id", *back, *ADDED)
