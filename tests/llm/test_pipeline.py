import random

import __spark_entry__
import corpus_pipeline
from test_models import toxic_corpus


def test_stages_take_effect(spark, docs, sf_dir):
    frame, labels, texts = toxic_corpus(docs, spark)
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(60))
    more = [" ".join(f"u{i}x{k}" for k in range(30)) + " " + passage + f" end{i}" for i in range(5)]
    copies = [texts[1], texts[1], texts[2] + " extra"]
    extra = docs(more + copies, ids=range(1000, 1008), sources=[rng.choice("ab") for _ in range(8)])
    base = sf_dir(documents=frame.unionByName(extra), labels=labels)
    rows, at = spark.read.parquet(f"{base}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, base).cache()
        at[name] = {r["doc_id"]: r for r in rows.collect()}
        if name != "packing":
            assert rows.columns == frame.columns
    kept = at["toxicity"]
    assert sum(i in kept for i in range(0, 700, 4)) < 20 and sum(i in kept for i in range(700) if i % 4) > 500
    assert {1005, 1006, 1007} & set(at["near_dedup"]) == set() and 1 in at["near_dedup"]
    assert sum("p7 p8" in r["text"] for i, r in at["substring_dedup"].items() if 1000 <= i < 1005) == 1
    assert {r["bin_id"] for r in at["packing"].values()} and set(at["packing"]) == set(at["mixing"])


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {f"op{n}_" for n in range(1, 11)} == {n.split("_")[0] + "_" for n in names if n.startswith("op")}
    assert set(__spark_entry__.oracle_sql()) <= set(names) and len(corpus_pipeline.STAGES) == 5


def test_null_ids_empty_texts_and_an_empty_table(spark, docs, sf_dir):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    frame = docs(["a b c", None, "", "d e f", "d e f"], ids=[1, 2, 3, None, None], sources=["s", None, "s", None, "s"])
    rows = corpus_pipeline.run(spark, sf_dir(documents=frame, labels=none)).collect()
    assert {r["doc_id"] for r in rows} == {1, None} and all(r["piece_words"] == 3 for r in rows)
    assert corpus_pipeline.run(spark, sf_dir(documents=docs([]), labels=none)).count() == 0
