"""Stages of the pipeline on a small folder of tables."""

import corpus_pipeline
import __spark_entry__
from tests.llm.conftest import sentence
import random


def test_stages_in_order(spark, frame, corpus, tmp_path):
    rnd = random.Random(11)
    item = sentence(rnd, 30)
    rows = [*corpus, (300, f"{sentence(rnd, 50)}\n{item}\n{sentence(rnd, 20)}")]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        sizes.append(docs.count())
    ids = {r.doc_id for r in docs.collect()}
    assert sizes == sorted(sizes, reverse=True) and 300 not in ids and not ids & {200, 201, 202, 203, 100, 102}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
