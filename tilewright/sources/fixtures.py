"""Views of the star-schema tables in the shapes of this library, from expressions that Spark SQL and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TILE = {
    "tile_id": "p_partkey",
    "kind": "CASE WHEN p_partkey % 8 = 0 THEN 'ps' ELSE 'tm' END",
    "lat0": "CASE WHEN p_partkey % 8 <> 0 THEN 0e0 WHEN p_size % 2 = 1 THEN -90e0 ELSE 90e0 END",
    "lon0": "CASE WHEN p_partkey % 8 = 0 THEN 0e0 ELSE -176e0 + 8 * (p_partkey % 45) END",
    "k0": "CASE WHEN p_partkey % 8 = 0 THEN 0.994e0 ELSE 0.999e0 END",
    "fe": "CASE WHEN p_partkey % 8 = 0 THEN 500000e0 ELSE 250000e0 END",
    "fn": "CASE WHEN p_partkey % 8 = 0 THEN 500000e0 WHEN p_size % 2 = 1 THEN 2500000e0 ELSE 0e0 END",
    "x_min": "CASE WHEN p_partkey % 8 = 0 THEN 500000e0 + 51200 * ((p_partkey % 17) - 8) ELSE 96400e0 + 25600 * (p_partkey % 11) END",
    "y_max": "CASE WHEN p_partkey % 8 = 0 THEN 500000e0 + 51200 * ((p_size % 13) - 6) WHEN p_size % 2 = 1 THEN 2500000e0 - 51200 * (p_size % 40) ELSE 51200e0 * (1 + p_size % 40) END",
    "px": "100e0",
    "width": "512",
    "split": "CASE WHEN p_size % 10 < 7 THEN 'train' WHEN p_size % 10 = 7 THEN 'validation' ELSE 'test' END",
}
DETECTION = {
    "tile_id": "l_partkey", "d1": "l_orderkey", "d2": "l_linenumber", "d3": "l_suppkey",
    "x": "CAST((l_orderkey * 37 + l_linenumber * 61) % 448 AS DOUBLE)",
    "y": "CAST((l_suppkey * 53 + l_orderkey * 11) % 448 AS DOUBLE)",
    "w": "4e0 + CAST(l_quantity AS DOUBLE)",
    "h": "4e0 + CAST(l_quantity AS DOUBLE) + l_linenumber % 3",
    "score": "CAST(50 + (l_orderkey * 13 + l_suppkey * 7 + l_linenumber * 29) % 951 AS DOUBLE) / 1000e0",
}
REFERENCE = {
    "tile_id": "l_partkey", "d1": "l_orderkey", "d2": "l_linenumber", "d3": "l_suppkey",
    "x": DETECTION["x"] + " + l_suppkey % 5 - 2", "y": DETECTION["y"] + " + l_orderkey % 3 - 1",
    "w": DETECTION["w"] + " + l_linenumber % 4 - 1", "h": DETECTION["h"] + " + 1",
}
PIXEL = {
    "patch_id": "v", "prow": "CAST((p - p % 8) / 8 AS INT)", "pcol": "CAST(p % 8 AS INT)",
    "mosaic_id": "CAST((v - v % 512) / 512 AS INT)", "pole": "CASE WHEN v % 512 < 256 THEN 'south' ELSE 'north' END",
    "cell_row": "CAST((v % 256 - v % 16) / 16 AS INT)", "cell_col": "CAST(v % 16 AS INT)",
    "value": "0.5e0 + 2e0 * e", "ref_value": "0.5e0 + 1.9e0 * e + 0.01e0 * ((p % 3) - 1)",
    "covered": "(5 * v + 3 * p) % 17 <> 0", "ref_covered": "(7 * v + p) % 19 <> 0",
    "predicted": "e > 0", "reference": "e + 0.04e0 * ((p % 3) - 1) > 0", "annotated": "(v + p) % 23 <> 0",
    "logit0": "0e0", "logit1": "10e0 * e", "target": "CAST((v - v % 4) / 4 AS INT)",
    "split": "CASE WHEN v % 10 < 7 THEN 'train' WHEN v % 10 = 7 THEN 'validation' ELSE 'test' END",
}


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


#: DuckDB views of the same, as common table expressions.
SQL = {
    "tile": f"tile AS (SELECT {_list(TILE)} FROM part)",
    "det": f"det AS (SELECT {_list(DETECTION)}, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) - 1 AS idx FROM lineitem)",
    "ref": f"ref AS (SELECT {_list(REFERENCE)}, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) - 1 AS idx FROM lineitem WHERE l_returnflag = 'R')",
    "pixel": f"pixel AS (SELECT {_list(PIXEL)} FROM (SELECT vec_id AS v, unnest(range(64)) AS p, CAST(unnest(embedding) AS DOUBLE) AS e FROM embeddings))",
}


def with_sql(*names: str) -> str:
    return "WITH RECURSIVE " + ", ".join(SQL[n] for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exprs(columns: dict[str, str]) -> list[str]:
    return [f"{v} AS {k}" for k, v in columns.items()]


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_exprs(TILE))


def _indexed(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("*", "row_number() OVER (PARTITION BY tile_id ORDER BY d1, d2, d3) - 1 AS idx")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted boxes with their index in the tile."""
    return _indexed(table(spark, sf_dir, "lineitem").selectExpr(*_exprs(DETECTION)))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference boxes with their index in the tile."""
    return _indexed(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr(*_exprs(REFERENCE)))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 rasters as a pixel table."""
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS v", "posexplode(embedding) AS (p, f)").selectExpr("v", "p", "CAST(f AS DOUBLE) AS e")
    return rows.selectExpr(*_exprs(PIXEL))
