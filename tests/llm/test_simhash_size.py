"""The join of the SimHash keys with the shared ones broadcasts neither, however small Spark takes them to be."""

import corpus_pipeline
from muster.llm import queries, simhash
from muster.llm.components import components
from test_near_stage import SCHEMA, groups, texts


def joins(links):
    """Joins in the plan of the links as it was run, after adaptive execution."""
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return {name for name in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin", "SortMergeJoin") if name in plan}


def watch(monkeypatch):
    seen = []
    monkeypatch.setattr(simhash, "components", lambda links: seen.append(joins(links)) or components(links))
    return seen


def test_near_stage_merges_keys(spark, monkeypatch):
    seen, found = watch(monkeypatch), texts()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1) for i, t in enumerate(found)], SCHEMA)
    kept = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(min(g) for g in groups(found))
    assert seen == [{"SortMergeJoin"}]


def test_op2_merges_keys(spark, monkeypatch, tmp_path):
    seen, found = watch(monkeypatch), texts()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1) for i, t in enumerate(found)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.component_id for r in queries.op2_simhash(spark, str(tmp_path)).collect()}
    assert got == {i: min(g) for g in groups(found) for i in g}
    assert seen == [{"SortMergeJoin"}]
