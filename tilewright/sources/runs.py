"""Run records: one JSON object a run, whose shape has drifted over the versions, as a typed table and a table of what is wrong."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.operators.contract import SCHEMA
from tilewright.sources.scratch import written

#: Fields of a run: (name, paths from the newest version's to the oldest's, type). The first path that has a value of the type counts.
FIELDS = (("task", ("$.task",), "string"), ("sample", ("$.sample", "$.sampleId"), "string"), ("version", ("$.processingVersion", "$.version"), "string"), ("created", ("$.createdAt",), "string"), ("seconds", ("$.seconds", "$.timing.seconds"), "double"))
OUTPUT = "map<string, struct<mean: double, std: double, min: double, max: double, shape: array<int>>>"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of every ``run.json`` below a folder; small files share tasks, and an empty file is as none."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "run.json").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def run_table(texts: DataFrame, fields=FIELDS) -> DataFrame:
    """(path, the fields, outputs, record) of run texts (path, value): each is parsed once, to a variant, whatever its shape; what a
    record lacks or has in another type is null, and ``record`` is null where the text is no JSON object."""
    parsed = texts.withColumn("record", F.try_parse_json("value"))
    parsed = parsed.withColumn("record", F.when(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")), F.col("record")))
    get = lambda paths, kind: F.coalesce(*[F.try_variant_get("record", p, kind) for p in paths])
    return parsed.select("path", *(get(paths, kind).alias(name) for name, paths, kind in fields), F.try_variant_get("record", "$.outputs", OUTPUT).alias("outputs"), "record")


def run_problems(runs: DataFrame, expected: DataFrame, version: str, fields=FIELDS) -> DataFrame:
    """(rule_id, object_id, message): texts that are no JSON objects, fields without a value, runs of another version, outputs that are
    missing or hold numbers that are not finite, runs (task, sample) that stand several times, and ``expected`` ones that no good record has."""
    lacks = F.filter(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name, _, _ in fields]), lambda x: x.isNotNull())
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    bad = F.map_keys(F.map_filter("outputs", lambda _, v: reduce(lambda a, b: a | b, [odd(v[c]) for c in ("mean", "std", "min", "max")])))
    fault = lambda rule, messages: F.transform(F.coalesce(messages, F.array().cast("array<string>")), lambda m: F.struct(F.lit(rule).alias("rule_id"), m.alias("message")))
    when = lambda test, what: F.when(test, F.array(what.cast("string")))
    none = F.coalesce(F.size("outputs"), F.lit(0)) < 1
    of_ok = F.concat(fault("run-field", lacks), fault("run-version", when(F.col("version") != version, F.col("version"))), fault("run-outputs", when(none, F.lit(""))), fault("run-finite", bad))
    ok = F.col("record").isNotNull()
    # texts are parsed in this one pass; the rules' results and the runs' names are what is read again
    told = written(runs.select(F.col("path").cast("string").alias("object_id"), "task", "sample", ok.alias("ok"), F.coalesce(ok & (F.col("version") == version) & (F.size("outputs") > 0), F.lit(False)).alias("good"),
                               F.when(ok, of_ok).otherwise(fault("run-malformed", F.array(F.lit("")))).alias("faults")), "runs")
    each = told.select("object_id", F.explode("faults").alias("f")).select("f.rule_id", "object_id", "f.message")
    seen = told.where("ok").select("task", "sample", F.lit(1).alias("n"), F.col("good").cast("int").alias("good"), F.lit(0).alias("wanted"))
    seen = seen.unionByName(expected.select("task", "sample", F.lit(0).alias("n"), F.lit(0).alias("good"), F.lit(1).alias("wanted")))
    whole = F.col("task").isNotNull() & F.col("sample").isNotNull()
    runs_ = seen.groupBy("task", "sample").agg(F.sum("n").alias("n"), F.max("good").alias("good"), F.max("wanted").alias("wanted"))
    twice = when(whole & (F.col("n") > 1), F.col("n"))
    missing = when((F.col("wanted") == 1) & (~whole | (F.col("good") == 0)), F.lit(""))
    named = runs_.select(F.concat_ws("/", "task", "sample").alias("object_id"), F.explode(F.concat(fault("run-twice", twice), fault("run-missing", missing))).alias("f")).select("f.rule_id", "object_id", "f.message")
    return runs.sparkSession.createDataFrame([], SCHEMA).unionByName(each).unionByName(named)
