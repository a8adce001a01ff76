"""Registered queries of the subpackage against their DuckDB SQL, and the
pipeline against its stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pricelake.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import DOCS
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_registered():
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert got.get("exact"), got


@pytest.mark.parametrize("name", sorted(
    set(QUERIES) - set(ORACLE) - {"op11_hnsw"}))
def test_row_per_input(spark, name):
    table = "pages" if name.startswith(("op4", "op10")) else "documents"
    assert QUERIES[name](spark, SF).count() == \
        spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert kept.schema == docs.schema, name
        docs = corpus_pipeline.stored(kept, f"test-{name}")
    assert 0.5 * n < docs.count() < n
    mixed = corpus_pipeline.run(spark, SF)
    assert mixed.count() == docs.count()


def test_pipeline_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0),
            (2, "same text in here now and then", "en", "a", 30),
            (2, "same text in here now and then", "en", "a", 30),
            (3, "same text in here now and then", "en", "b", 30)]
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-odd")
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "2", "None"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
