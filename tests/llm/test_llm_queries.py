import importlib

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__
import corpus_pipeline
from sparkpipe.llm.oracle import LLM_ORACLE
from sparkpipe.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    connection = duck(SF)
    assert spark_rows(LLM_QUERIES[name](spark, SF)) == duck_rows(connection, LLM_ORACLE[name])
    connection.close()


def test_all_are_registered():
    names = importlib.reload(__spark_entry__).queries()
    assert {n.split("_")[0] for n in LLM_QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(names)


def test_pipeline(spark, folder):
    """Each stage drops, repeats or keeps what its operator says, and nothing else."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.dtypes, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        if name != "token_records":
            assert after.dtypes == columns
        if name not in ("mixing", "token_records"):
            assert after.join(docs, "doc_id", "left_anti").isEmpty()
        counts.append(after.count())
        docs = after
    assert counts[0] > counts[1] > counts[2] > counts[3]
    assert counts[4] == counts[5]


def test_pipeline_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert docs.isEmpty()
