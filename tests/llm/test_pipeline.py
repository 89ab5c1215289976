"""The stages of the pipeline, each against plain Python on small tables."""

import re
from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_jaccard import brute as brute_groups
from tests.llm.test_native import brute as brute_leaks

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "private", "pack"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    steps = dict(corpus_pipeline.STAGES)
    seen = {}
    for name in ("quality", "near_copies", "benchmark", "private"):
        docs = corpus_pipeline.written(steps[name](spark, docs, SF), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    every = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    gone = every - seen["quality"].keys()
    assert gone and sum(labels.get(i) == 1 for i in gone) <= 3
    groups = brute_groups(list(seen["quality"].items()), 5, 80, 100)
    assert seen["near_copies"].keys() == {i for i, (_, c) in groups.items() if i == c}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert seen["benchmark"].keys() == seen["near_copies"].keys() - {i for i, _ in brute_leaks(list(seen["near_copies"].items()), items)}
    assert seen["private"].keys() == seen["benchmark"].keys()
    secret = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|\+1 \(\d{3}\) 555-\d{4}|@mail\d\.example\.com")
    found = [m for t in seen["benchmark"].values() for m in secret.findall(t)]
    assert found and not [m for t in seen["private"].values() for m in secret.findall(t) if m in found]
    packed = steps["pack"](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == seen["private"].keys()
    fill = defaultdict(int)
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024 and len(fill) <= sum(fill.values()) / 1024 * 1.01 + 2


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where(F.lit(t != "documents")).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
