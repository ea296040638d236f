"""The corpus pipeline, stage by stage, against planted cases."""

import random

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
                    for _ in range(n))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("mine"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rng = random.Random(1)
    near = prose(rng, 300)
    shared = prose(rng, 80)
    planted = {
        90_000: near, 90_001: near, 90_002: near + " end", 90_003: prose(rng, 50) + " " + shared,
        90_004: prose(rng, 60) + " " + shared, 90_005: f"{prose(rng, 40)} {bench} {prose(rng, 40)}",
        90_006: None, 90_007: "", 90_008: prose(rng, 3000),
        90_009: " ".join(bench.split()[:12])}
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in planted.items()]
    rows += [(None, "a text without an id, " + prose(rng, 30), None, None, None, "x")]
    docs = docs.union(spark.createDataFrame(rows, docs.schema))
    seen = {}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = pipeline.written(spark, stage(spark, docs, SF), f"test-{name}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "bpe_encoding":
            assert docs.columns == before.columns
            assert [f.dataType for f in docs.schema] == [f.dataType for f in before.schema]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    ordinary = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    # Two labels in five there are noise: only the others have words to find.
    assert len(toxic & set(seen["toxicity"])) <= 0.5 * len(toxic)
    assert len(ordinary - set(seen["toxicity"])) <= 0.02 * len(ordinary)
    copies = seen["simhash_near_dedup"]
    assert {i for i in (90_000, 90_001, 90_002) if i in copies} <= {90_000}
    cut = seen["suffix_array_dedup"]
    for i in (90_003, 90_004):
        if i in cut:
            assert cut[i]["n_chars"] == len(cut[i]["text"])
    if 90_003 in cut and 90_004 in cut:
        assert shared not in cut[90_003]["text"] and shared not in cut[90_004]["text"]
    clean = seen["benchmark_decontamination"]
    assert all(bench not in (r["text"] or "") for r in clean.values())
    assert 90_009 not in clean
    last = seen["bpe_encoding"]
    assert set(last) == set(clean)
    assert all(len(r["ids"]) == r["n_tokens"] for r in last.values())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(spark, stage(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
