"""Corpus pipeline: quality rules, quality classifier, near-duplicate removal
and packing over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``.  A stage judges all rows its predecessor kept and
its verdicts take effect.  An empty table passes through as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import ngram_join, packing, quality_rules, site_bayes
from tierline.llm.shared import staged, veiled

#: Every stage ends in trained models, text joins or token ids: no SQL form.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    trees = quality_rules.fit(docs, _labels(spark, sf_dir))
    hidden, back = veiled(docs, docs.columns)
    judged = quality_rules.apply_rules(docs.select("doc_id", "text", *hidden), trees, extra=[f"own{i}" for i in range(len(back))])
    return judged.where("kept").select(*back)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier rejects go."""
    model = site_bayes.fit(docs, _labels(spark, sf_dir))
    hidden, back = veiled(docs, docs.columns)
    return site_bayes.classify(docs.select(*hidden, "source", "lang", "text"), model).where("kept").select(*back)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest doc_id, of each group of near
    duplicates (five-word shingles, similarity 0.8) stays, also where rows
    repeat a doc_id or have none."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids; a row per piece with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 1)


STAGES = [("quality_rules", rules_stage), ("quality_classifier", classifier_stage),
          ("ngram_jaccard_join", dedup_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
