"""Run records of several shapes, and nested differences."""

import json
from collections import Counter

from pyspark.sql import functions as F

from tilewright.operators import differences
from tilewright.sources import runs


def test_run_records(spark, tmp_path):
    good = {"task": "t", "sample": "a", "processingVersion": "2", "createdAt": "x", "seconds": 3, "outputs": {"m": {"mean": 0, "std": 1.5, "min": -1, "max": 1, "shape": [2, 2]}}, "more": {"new": [1, {"deep": None}]}}
    texts = {"a": json.dumps(good, indent=2), "b": json.dumps({**good, "sample": "b"})[:-4], "c": "[]", "d": "", "e": json.dumps({"task": "t", "sampleId": "e", "version": "1", "createdAt": "x", "timing": {"seconds": "4.5"}, "outputs": {}}),
             "f": json.dumps(good), "g": json.dumps({**good, "sample": "g", "outputs": {"m": {"mean": None, "std": 1, "min": 0, "max": 1}}})}
    for k, t in texts.items():
        (tmp_path / k).mkdir()
        (tmp_path / k / "run.json").write_text(t)
        (tmp_path / k / "other.json").write_text("{")
    table = runs.run_table(runs.read_runs(spark, str(tmp_path)))
    name = lambda p: p.rsplit("/", 2)[-2] if "/run.json" in p else p
    rows = {name(r["path"]): r for r in table.drop("record").collect()}
    assert rows.keys() == texts.keys() - {"d"}  # an empty file is as none
    assert (rows["a"]["seconds"], rows["a"]["outputs"]["m"]["shape"], rows["e"]["seconds"], rows["e"]["sample"], rows["e"]["version"]) == (3.0, [2, 2], 4.5, "e", "1")
    expected = spark.createDataFrame([("t", x) for x in "abegz"], "task string, sample string")
    got = sorted((r["rule_id"], name(r["object_id"]), r["message"]) for r in runs.run_problems(table, expected, "2").collect())
    assert got == sorted([("run-malformed", x, "") for x in "bc"] + [("run-version", "e", "1"), ("run-outputs", "e", ""), ("run-finite", "g", "m"), ("run-twice", "t/a", "2"), ("run-missing", "t/b", ""), ("run-missing", "t/e", ""), ("run-missing", "t/z", "")])


def test_run_texts_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def once(v):
        seen.add(1)
        return v

    rows = [(f"r/{i}", json.dumps({"task": None if i == 3 else "t", "sample": f"s{i % 20}", "processingVersion": "2" if i % 4 else "1", "createdAt": "x", "seconds": 1, "outputs": {"m": {"mean": 0, "std": 1, "min": 0, "max": 1}}})) for i in range(30)]
    texts = spark.createDataFrame(rows, "path string, value string").select("path", F.udf(once)("value").alias("value"))
    expected = spark.createDataFrame([("t", "s1"), ("t", "s1"), ("t", "s16"), ("t", "s12"), ("t", "zz"), (None, "s3")], "task string, sample string")
    got = Counter(tuple(r) for r in runs.run_problems(runs.run_table(texts), expected, "2").collect())
    want = {("run-version", f"r/{i}", "1") for i in range(0, 30, 4)} | {("run-field", "r/3", "task")} | {("run-twice", f"t/s{i}", "2") for i in range(10) if i != 3} | {("run-missing", x, "") for x in ("t/s16", "t/s12", "t/zz", "s3")}
    assert got == Counter(want) and seen.value == 30


def test_nested_differences(spark):
    ddl = "id int, s struct<a:int,l:array<struct<x:double>>>, m map<string,int>, u array<int>"
    a = [(1, (1, [(1.0,), (2.0,)]), {"k": 1}, [1, 2, 2]), (2, (None, None), None, None), (3, (1, [(1.0,)]), {"k": 1}, [1]), (4, None, {}, []), (5, None, None, None), (5, None, None, None), (None, None, None, [1])]
    b = [(1, (1, [(1.0,), (2.5,)]), {"k": 1, "j": 2}, [2, 1, 2]), (2, (None, None), None, None), (3, (2, [(1.0,), (1.0,)]), {"k": 1}, [2]), (4, (None, None), None, []), (5, None, None, None), (6, None, None, None), (None, None, None, [2])]
    x, y = spark.createDataFrame(a, ddl), spark.createDataFrame(b, ddl)
    got = sorted((r["id"] or 0, r["path"]) for r in differences.differences(x, y, "id", ("$.u",)).collect())
    assert got == sorted([(1, "$.s.l[1].x"), (1, "$.m.j"), (3, "$.s.a"), (3, "$.s.l.size"), (3, "$.u"), (4, "$.s"), (4, "$.m"), (5, "$"), (6, "$"), (0, "$.u")])
    assert (1, "$.u[0]") in {(r["id"], r["path"]) for r in differences.differences(x, y, "id").collect()}
    assert differences.differences(x, x, "id").count() == 0
