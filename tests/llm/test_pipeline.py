"""The pipeline's stages on their own inputs, and the contract's names."""

import __spark_entry__ as contract
import corpus_pipeline
from muster.llm import secrets

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert [s[0].split()[0] for s in corpus_pipeline.STAGES] == ["quality", "SimHash", "secret", "mixing", "packing"]


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = spark.createDataFrame([(9001, "password = hunter2hunter2 " + "word " * 60, "en", "src0", 1),
                                  (9002, None, None, None, None), (None, "x", None, None, None)], docs.schema)
    rows = docs.union(docs.limit(5)).union(more)
    sizes = [rows.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, rows, FOLDER).write.parquet(str(tmp_path / str(i)))
        rows = spark.read.parquet(str(tmp_path / str(i)))
        assert rows.columns == docs.columns
        sizes.append(rows.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    kept = [r.doc_id for r in spark.read.parquet(str(tmp_path / "1")).collect()]
    assert len(kept) == len(set(kept))
    assert not any(secrets.scan(r.text) for r in rows.collect())
    last = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER)
    assert {r[0] for r in last.select("doc_id").collect()} == {r.doc_id for r in rows.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
