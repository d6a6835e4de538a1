"""The pipeline on awkward rows, and the queries against their SQL."""

import os

import pytest
from llm_data import documents, empty, sentence

import __spark_entry__ as entry
import corpus_pipeline
from shelfdiff.llm import queries

duckdb = pytest.importorskip("duckdb")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, 0) for i in range(0, 60, 2)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, sentence(random.Random(1), 20))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns_and_clean_rows(spark, folder):
    docs = documents(spark)
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == documents(spark).columns and out.dtypes == docs.dtypes
            assert out.count() <= seen
            seen = out.count()
            docs = out
    ids = {x.doc_id for x in docs.collect()}
    assert {103, 104, 105, 106, 108, 110} <= ids and not {100, 101, 107, 109} & ids
    assert {x.doc_id for x in out.collect()} == ids


def test_stages_of_an_empty_table(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), folder).count() == 0


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet")
    packed = corpus_pipeline.run(spark, entry.SMOKE_DIR)
    ids = {x.doc_id for x in packed.select("doc_id").distinct().collect()}
    assert packed.count() > 0 and ids <= {x.doc_id for x in docs.select("doc_id").collect()}


def test_one_query_per_operator():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(entry.SMOKE_DIR):
        con.execute(f"create view {table.split('.')[0]} as select * from '{entry.SMOKE_DIR}/{table}'")
    got = queries.QUERIES[name](spark, entry.SMOKE_DIR).toPandas()
    expected = con.execute(queries.ORACLES[name]).df()[list(got.columns)]
    order = lambda f: f.sort_values(list(f.columns)).reset_index(drop=True).astype(str)
    assert order(got).equals(order(expected))


