"""The corpus pipeline on a small table, and the registered queries."""

import os

import pytest

import __spark_entry__
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the tables")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[3] > counts[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}
    assert len(last) == corpus_pipeline.run(spark, SF_DIR).count()


def test_one_row_of_a_group_stays_whatever_its_ids(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    near, other, third, fourth = text + " end", *(" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    rows = [(1, text), (1, text), (1, near), (2, text), (None, text)]  # the same row twice, two near copies under one id
    rows += [(None, other), (None, other), (None, other + " end"), (1, third), (5, third), (None, fourth)]
    rows += [(None, ""), (None, ""), (7, None), (7, None)]
    docs = docs_of(rows).select(*corpus_pipeline.COLUMNS)
    found = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text or "") for r in found.collect()), key=str)
    words = [(i, t.removesuffix(" end")) for i, t in got if t]
    assert sorted(words) == [(0, other), (0, fourth), (1, text), (1, third)]
    assert [i for i, t in got if not t] == [0, 0, 7, 7]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the tables")
def test_texts_are_not_shuffled_to_drop_what_holds_a_benchmark_passage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = corpus_pipeline.without_benchmark(spark, docs, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
