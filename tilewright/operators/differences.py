"""Nested records of two tables compared by key, with the path of each difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window


def paths(a: Column, b: Column, kind: T.DataType, path: Column, unordered: tuple[str, ...] = (), name: str = "$") -> Column:
    """array of the paths at which two values of one type differ; arrays whose path is in ``unordered`` (without indexes) count as
    multisets, and differ as a whole."""
    here = lambda differ: F.when(differ, F.array(path)).otherwise(F.expr("cast(array() as array<string>)"))
    inner = lambda c: F.concat(path, F.lit("." + c))
    one_null = a.isNull() != b.isNull()
    if isinstance(kind, T.StructType):
        each = [paths(a[f.name], b[f.name], f.dataType, inner(f.name), unordered, f"{name}.{f.name}") for f in kind]
        return F.when(one_null, F.array(path)).otherwise(F.concat(F.expr("cast(array() as array<string>)"), *each))
    if isinstance(kind, T.ArrayType):
        if name in unordered:
            digests = lambda v: F.array_sort(F.transform(v, lambda x: F.sha2(F.to_json(F.struct(x.alias("x"))), 256)))
            return here(one_null | ~digests(a).eqNullSafe(digests(b)))
        pairs = F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        found = F.flatten(F.transform(pairs, lambda p, i: paths(p["x"], p["y"], kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), unordered, name)))
        size = F.when(F.size(a) != F.size(b), F.array(F.concat(path, F.lit(".size")))).otherwise(F.coalesce(found, F.expr("cast(array() as array<string>)")))
        return F.when(one_null, F.array(path)).otherwise(size)
    if isinstance(kind, T.MapType):
        keys = F.array_sort(F.array_union(F.map_keys(a), F.map_keys(b)))
        found = F.flatten(F.transform(keys, lambda k: paths(F.element_at(a, k), F.element_at(b, k), kind.valueType, F.concat(path, F.lit("."), k.cast("string")), unordered, name)))
        return F.when(one_null, F.array(path)).otherwise(F.coalesce(found, F.expr("cast(array() as array<string>)")))
    return here(~a.eqNullSafe(b))


def differences(a: DataFrame, b: DataFrame, key: str, unordered: tuple[str, ...] = ()) -> DataFrame:
    """(key, path): where the records of two tables of the same columns differ. A key that one side lacks, or has more often, differs
    at ``$``; records of a repeated key are compared in the order of their digests. Equal tables give no rows.
    """
    columns = [c for c in a.columns if c != key]

    def numbered(df: DataFrame, as_: str) -> DataFrame:
        row = F.struct(*[F.col(c) for c in columns])
        turn = F.row_number().over(Window.partitionBy(key).orderBy(F.sha2(F.to_json(row), 256)))
        return df.select(key, turn.alias("n"), row.alias(as_))

    kind = T.StructType([f for f in a.schema if f.name != key])
    x, y = numbered(a, "a").withColumn("has_a", F.lit(True)), numbered(b, "b").withColumn("has_b", F.lit(True))
    both = x.alias("x").join(y.alias("y"), F.col(f"x.{key}").eqNullSafe(F.col(f"y.{key}")) & (F.col("x.n") == F.col("y.n")), "full_outer")
    found = F.when(F.col("has_a") & F.col("has_b"), paths(F.col("a"), F.col("b"), kind, F.lit("$"), unordered)).otherwise(F.array(F.lit("$")))
    own = F.when(F.col("has_a"), F.col(f"x.{key}")).otherwise(F.col(f"y.{key}"))
    return both.select(own.alias(key), F.explode(found).alias("path"))
