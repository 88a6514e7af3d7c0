"""The corpus pipeline, and the registration of all queries."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E
import corpus_pipeline
from oracle_check import compare, duck
from tidemark.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF), name, registry.QUERIES[name], registry.ORACLE[name], SF)
    assert r["ok"], r


def test_all_queries_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in E.queries()


def test_stages_in_order(spark, scratch):
    """Each stage works on all that its predecessor kept and does what it says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        kept.append(docs.collect())
        if k < 4:
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "mixing", "sharding"]
    ids = [{r["doc_id"] for r in rows} for rows in kept]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4]
    assert len(kept[3]) == len(kept[4]) and len(ids[0]) > 0.8 * 200
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(clean & ids[0]) >= 0.95 * len(clean) and len(toxic & ids[0]) <= 0.5 * len(toxic)
    text = [r["text"] for r in kept[1]]
    assert len(set(text)) == len(text)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not [t for t in (r["text"] for r in kept[2]) if any(i in t for i in items)]
    slots = {}
    for r in kept[4]:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_odd_documents_go_through_all_stages(spark, documents, folder):
    docs = documents([(None, None, None, None), (1, None), (2, ""), (3, "w " * 20_000), (4, "a b c d e"), (4, "a b c d e"), (5, "a b c d e")])
    labels = spark.createDataFrame([(4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, None)], "item_id long, text string")
    out = corpus_pipeline.run(spark, folder(documents=docs, labels=labels, benchmark=bench)).collect()
    assert {r["doc_id"] for r in out} >= {3, 4} and 5 not in {r["doc_id"] for r in out}
    empty = corpus_pipeline.run(spark, folder(documents=documents([]), labels=labels.limit(0), benchmark=bench.limit(0)))
    assert empty.collect() == [] and {"shard", "slot", "text"} <= set(empty.columns)
