"""How many toxic and clean labelled documents the classifier calls toxic, at each size."""

import pytest

import corpus_pipeline
from screenlake.llm import queries as llm


@pytest.mark.parametrize("sf, held_least", [("sf0.001", 0.6), ("sf0.01", 0.6), ("sf0.1", 0.85)])
def test_recall(spark, sf, held_least):
    folder = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet").dropna(subset=["doc_id", "toxic"]).select("doc_id", "toxic")
    rows = llm.queries()["op3_toxicity"](spark, folder).join(labels, "doc_id").select("held_out", "toxic", "predicted").collect()

    def share(toxic, held):
        found = [r["predicted"] for r in rows if r["toxic"] == toxic and (r["held_out"] or not held)]
        print(sf, "toxic" if toxic else "clean", "held out" if held else "all", sum(found), "of", len(found))
        return sum(found) / len(found)

    assert share(1, False) >= 0.8 and share(0, False) <= 0.04
    assert share(1, True) >= held_least and share(0, True) <= 0.05


def test_pipeline_drops_toxic(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in docs.select("doc_id").collect()} - kept
    assert sum(toxic.get(i) == 1 for i in gone) >= 0.7 * sum(v == 1 for v in toxic.values())
    assert sum(toxic.get(i) == 0 for i in gone) <= 0.02 * sum(v == 0 for v in toxic.values())
