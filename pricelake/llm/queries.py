"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import (decontamination, hnsw, lexical_search, licenses,
                           mixing, ngram_join, pii, suffix_dedup,
                           token_alignment, topk_search, toxicity, url_filter,
                           warc)
from pricelake.llm.common import table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = topk_search.build_index(table(spark, sf_dir, "embeddings"))
    return topk_search.top_k(index, F.col("vec_id") % 100 == 0)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontamination.build_index(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return decontamination.contamination(index)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.url_filter(table(spark, sf_dir, "pages"), weights)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity_scores(docs, model)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(folder, manifest).drop("url")


def op11_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = hnsw.build_index(table(spark, sf_dir, "embeddings"), k=10)
    return hnsw.nearest(index, F.col("vec_id") % 100 == 0, k=10)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.token_alignment(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_topk_search, op2_decontamination, op3_suffix_dedup, op4_url_filter, op5_ngram_jaccard,
    op6_source_mix, op7_license_scan, op8_pii,
    op9_toxicity, op10_warc, op11_hnsw, op12_lexical_search,
    op13_token_alignment)}

OP1_SQL = """
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda c:
           CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(
           list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vecs q JOIN vecs x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (
           PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

ORACLE = {"op1_topk_search": OP1_SQL, "op2_decontamination": decontamination.SQL,
          "op5_ngram_jaccard": ngram_join.SQL, "op6_source_mix": mixing.sql(),
          "op12_lexical_search": lexical_search.SQL}
