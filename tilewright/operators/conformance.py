"""Schemas of nested records compiled into one column that lists what breaks them, by rule and path.

A schema is a dictionary of the usual JSON keywords: ``type`` (object, array, string, number, integer, boolean), ``properties``,
``required``, ``items``, ``additionalProperties`` (a map's values), ``enum``, ``const``, ``pattern``, ``minimum``, ``maximum``,
``minItems``, ``maxItems``, ``uniqueItems`` and ``oneOf`` as a list of properties of which exactly one has a value. It is matched with
the type of a column when it is compiled, so records of any depth are checked in one pass, by expressions alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tilewright.operators.contract import duplicates, violations

_FOUND = "array<struct<rule:string,path:string>>"
_KINDS = {"object": (T.StructType, T.MapType), "array": (T.ArrayType,), "string": (T.StringType,), "boolean": (T.BooleanType,), "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
          "number": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)}


def _none() -> Column:
    return F.expr(f"cast(array() as {_FOUND})")


def broken(schema: dict, value: Column, kind: T.DataType, path: Column) -> Column:
    """array of (rule, path) for what in ``value`` breaks ``schema``. Null breaks nothing: ``required`` asks for values."""
    out: list[Column] = []

    def rule(name: str, fails: Column, at: Column = path) -> None:
        one = F.array(F.struct(F.lit(name).alias("rule"), at.cast("string").alias("path")))
        out.append(F.when(value.isNotNull() & F.coalesce(fails, F.lit(True)), one).otherwise(_none()))

    if "type" in schema and not isinstance(kind, _KINDS[schema["type"]]):
        rule("type", F.lit(True))
        return out[0]
    if "enum" in schema:
        rule("enum", ~value.isin(*schema["enum"]))
    if "const" in schema:
        rule("const", value != F.lit(schema["const"]))
    if "pattern" in schema:
        rule("pattern", ~F.regexp_like(value, F.lit(schema["pattern"])))
    if "minimum" in schema or "maximum" in schema:
        number = F.isnan(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.lit(False)
        if "minimum" in schema:
            rule("minimum", (value < schema["minimum"]) | number)
        if "maximum" in schema:
            rule("maximum", (value > schema["maximum"]) | number)
    if isinstance(kind, T.StructType):
        fields = {f.name: f.dataType for f in kind}
        inner = lambda c: F.concat(path, F.lit("." + c))
        for c in schema.get("required", []):
            rule("required", value[c].isNull() if c in fields else F.lit(True), inner(c))
        if "oneOf" in schema:
            has = reduce(Column.__add__, [value[c].isNotNull().cast("int") if c in fields else F.lit(0) for c in schema["oneOf"]])
            rule("oneOf", has != 1)
        out += [broken(s, value[c], fields[c], inner(c)) for c, s in schema.get("properties", {}).items() if c in fields]
    if isinstance(kind, T.ArrayType):
        if "minItems" in schema:
            rule("minItems", F.size(value) < schema["minItems"])
        if "maxItems" in schema:
            rule("maxItems", F.size(value) > schema["maxItems"])
        if schema.get("uniqueItems"):
            as_text = F.transform(value, lambda x: F.to_json(F.struct(x.alias("x"))))  # maps have no order to compare by
            rule("uniqueItems", F.size(F.array_distinct(as_text)) < F.size(value))
        if "items" in schema:
            each = F.transform(value, lambda x, i: broken(schema["items"], x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            out.append(F.coalesce(F.flatten(each), _none()))
    if isinstance(kind, T.MapType) and "additionalProperties" in schema:
        each = F.transform(F.map_entries(value), lambda e: broken(schema["additionalProperties"], e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"].cast("string"))))
        out.append(F.coalesce(F.flatten(each), _none()))
    return F.concat(*out) if out else _none()


def conformance(rows: DataFrame, schema: dict, object_: str, name: str = "schema") -> DataFrame:
    """(rule_id, object_id, message): what breaks the schema in each row; the message is the path, ``$`` the row itself. A row that
    breaks it at several places is several violations; an empty table has none."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    found = rows.select(F.col(object_).cast("string").alias("object_id"), F.explode(broken(schema, whole, rows.schema, F.lit("$"))).alias("b"))
    return found.select(F.concat(F.lit(name + "-"), "b.rule").alias("rule_id"), "object_id", F.col("b.path").alias("message"))


#: The modes of a build of science data.
MODES = ("real", "real-smoke", "batch-preview", "complete-preview")


def build_rules(manifest: DataFrame, sources: DataFrame, objects: DataFrame, version: str, markers: tuple[str, ...], modes: tuple[str, ...] = MODES) -> DataFrame:
    """What a whole build breaks: the mode and schema version of its manifest (data_mode, schema_version) of one row, no sources, and of
    its objects (id, text: the whole record as JSON) ids that stand twice, ids of mock objects, and records with a synthetic marker."""
    n = manifest.agg(F.count("*").alias("n"), F.first("data_mode").alias("data_mode"), F.first("schema_version").alias("schema_version")).withColumn("object", F.lit("manifest"))
    none = sources.limit(1).agg(F.count("*").alias("n")).withColumn("object", F.lit("sources"))
    marked = reduce(Column.__or__, [F.contains("text", F.lit(m)) for m in markers], F.lit(False))
    return reduce(DataFrame.unionByName, [
        violations(n, "manifest-mode", (F.col("n") != 1) | ~F.col("data_mode").isin(*modes), "object", F.col("data_mode")), violations(n, "manifest-schema", (F.col("n") != 1) | (F.col("schema_version") != version), "object", F.col("schema_version")),
        violations(none, "sources-missing", F.col("n") == 0, "object"), duplicates(objects, "id-twice", "id"), violations(objects, "id-mock", F.startswith("id", F.lit("mock-")), "id"), violations(objects, "synthetic", marked, "id"),
    ])
