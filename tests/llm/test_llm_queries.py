"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cardlake.llm import common
from cardlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    expected = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(expected.columns)
    assert Counter(tuple(r) for r in got.select(*expected.columns).collect()) == Counter(expected.fetchall())


def test_toxicity_query_on_held_out_documents(spark):
    got = QUERIES["op1_toxicity_mil"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 50 and right >= 0.9 * len(rows)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(3).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (5000, "", "en", None, 0), (5001, "word " * 60, None, "s", 1)], docs.schema))
    docs = docs.unionByName(extra)
    n = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, common.materialise(stage(spark, docs, SF), "test-stage")
        n.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 1:
            assert docs.select(F.regexp_replace("text", common.SPACES, " ")).distinct().count() == n[-1]
        if i in (1, 2):
            assert docs.exceptAll(before).isEmpty()
    assert n[0] > n[1] > n[2] >= n[3] > 0 and n[4] == n[5]
    assert docs.columns == [*columns, "token_ids", "n_tokens"]
    assert docs.select(*columns).exceptAll(before).isEmpty()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], before.schema), SF).isEmpty()


def test_pipeline_run_repeats_itself(spark):
    rows = [sorted(map(str, corpus_pipeline.run(spark, SF).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and rows[0]
