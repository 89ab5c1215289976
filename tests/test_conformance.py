"""Schemas against nested rows, and what a whole build breaks."""

from tilewright.operators import conformance

SCHEMA = {"required": ["a", "z"], "properties": {"a": {"type": "string", "enum": ["x", "y"]}, "n": {"type": "number", "minimum": 0, "maximum": 1}, "s": {"required": ["t"], "properties": {"t": {"type": "array", "minItems": 1, "maxItems": 2, "uniqueItems": True, "items": {"properties": {"m": {"additionalProperties": {"maximum": 5}}}}}}}, "b": {"type": "integer"}}}


def test_faults_at_every_depth(spark):
    rows = [
        (1, "x", 0.5, ([({"k": 1.0},)],), 1.5), (2, "q", float("nan"), None, 1.5), (3, None, 1.5, (None,), None), (4, "y", None, ([],), None),
        (5, "y", 1.0, ([({"k": 9.0, "l": 2.0},), ({"k": 9.0, "l": 2.0},), (None,)],), None),
    ]
    df = spark.createDataFrame(rows, "id int, a string, n double, s struct<t:array<struct<m:map<string,double>>>>, b double")
    got = sorted((r["object_id"], r["rule_id"], r["message"]) for r in conformance.conformance(df, SCHEMA, "id").collect())
    every = [(str(i), "schema-required", "$.z") for i in range(1, 6)]
    assert got == sorted(every + [
        ("1", "schema-type", "$.b"), ("2", "schema-type", "$.b"), ("2", "schema-enum", "$.a"), ("2", "schema-minimum", "$.n"), ("2", "schema-maximum", "$.n"),
        ("3", "schema-required", "$.a"), ("3", "schema-maximum", "$.n"), ("3", "schema-required", "$.s.t"), ("4", "schema-minItems", "$.s.t"),
        ("5", "schema-maxItems", "$.s.t"), ("5", "schema-uniqueItems", "$.s.t"), ("5", "schema-maximum", "$.s.t[0].m.k"), ("5", "schema-maximum", "$.s.t[1].m.k")])
    assert conformance.conformance(df.where("false"), SCHEMA, "id").count() == 0


def test_builds(spark):
    one = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    objects = one([("wac-1", "{}"), ("wac-1", "{}"), ("mock-2", "{}"), ("wac-3", '{"origin": "synthetic"}'), ("wac-4", "{}")], "id string, text string")
    good = one([("real", "2")], "data_mode string, schema_version string")
    sources = one([("s",)], "id string")
    got = lambda *a: sorted((r["rule_id"], r["object_id"]) for r in conformance.build_rules(*a, "2", ("synthetic",)).collect())
    assert got(good, sources, objects) == [("id-mock", "mock-2"), ("id-twice", "wac-1"), ("synthetic", "wac-3")]
    assert got(one([("mock", "1")], good.schema), sources.where("false"), objects.where("id = 'wac-4'")) == [("manifest-mode", "manifest"), ("manifest-schema", "manifest"), ("sources-missing", "sources")]
    assert got(good.where("false"), sources, objects.where("false")) == [("manifest-mode", "manifest"), ("manifest-schema", "manifest")]
