"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import (bpe_chunks, embed_dedup, html_extract, license_scan, ngram_join, oracles, packing, periodic_runs, quality_rules, site_bayes,
                          sphere_kmeans, token_files, url_reputation, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark, sf_dir):
    return token_files.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_collision_counting(spark, sf_dir):
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_warc_chunks(spark, sf_dir):
    return warc.archive(_table(spark, sf_dir, "pages"))


def op4_bpe_chunks(spark, sf_dir):
    return bpe_chunks.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                    public_tokenizers.PATTERN)


def op5_html_trees(spark, sf_dir):
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op7_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op8_quality_rules(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.apply_rules(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


def op9_mixture_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, with_ids=False)


def op10_site_bayes(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    model = site_bayes.fit(docs, _table(spark, sf_dir, "labels"))
    return site_bayes.classify(docs, model).drop("text")


def op11_host_reputation(spark, sf_dir):
    return url_reputation.judge(_table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.collapse(_table(spark, sf_dir, "documents"))


def op13_sphere_kmeans(spark, sf_dir):
    return sphere_kmeans.cluster(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_collision_counting, op3_warc_chunks, op4_bpe_chunks, op5_html_trees,
                                   op6_license_scan, op7_ngram_join, op8_quality_rules, op9_mixture_packing, op10_site_bayes,
                                   op11_host_reputation, op12_periodic_runs, op13_sphere_kmeans)}
ORACLE: dict[str, str] = {"op2_collision_counting": oracles.VECTORS, "op3_warc_chunks": oracles.WARC, "op7_ngram_join": oracles.shingles_sql(),
                          "op11_host_reputation": url_reputation.oracle_sql(), "op13_sphere_kmeans": sphere_kmeans.oracle_sql()}
