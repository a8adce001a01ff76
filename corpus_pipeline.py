"""Corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``docs``; its result is written as Parquet and read again as the
next stage's input.  The last stage returns the mix.

1. toxicity: documents that the classifier (trained on the labelled ones)
   scores 0.7 or more go.
2. ngram_jaccard: of each group of near duplicates the document with the
   smallest id stays.  An id goes only if none of its rows is the smallest of
   its group, so rows that repeat an id stay together; null ids stay.
3. decontamination: documents that hold a benchmark window go, row by row.
4. pii: personal data is replaced by its kind in brackets; every row stays.
5. mixing: how many words of each document the mix takes.

Null and empty texts pass every stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import (decontamination, mixing, ngram_join, pii, toxicity)
from pricelake.llm.common import stored, table, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame,
                         sf_dir: str) -> DataFrame:
    groups = ngram_join.ngram_components(docs)
    first = F.col("doc_id") == F.col("component_id")
    gone = groups.where("doc_id is not null").groupBy("doc_id") \
        .agg(F.max(first).alias("first")).where(~F.col("first"))
    return without(docs, stored(gone.select("doc_id"), "pipeline-copies"),
                   {"doc_id": F.col("doc_id")})


def drop_contaminated(spark: SparkSession, docs: DataFrame,
                      sf_dir: str) -> DataFrame:
    row = F.xxhash64("doc_id", "text")
    index = decontamination.build_index(
        docs.select("doc_id", "text", row.alias("_row")),
        table(spark, sf_dir, "benchmark"), carry=("_row",))
    gone = decontamination.contamination(index).where("contaminated") \
        .select("_row").distinct()
    return without(docs, stored(gone, "pipeline-leaks"), {"_row": row})


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("pii", redact),
          ("mixing", mix)]

# The classifier's scores have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
