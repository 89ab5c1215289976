"""Queries of the constraint rules that compare published records with their grids, pixels and counts. Published records are
recomputed ones with some values changed, so that the rules have something to find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tilewright.functions import geo
from tilewright.operators import catalogue, conformance, contract, proximity, raster
from tilewright.operators.boxes import with_center
from tilewright.plans import sphere_sql as q
from tilewright.plans.catalogue import CRATERS
from tilewright.plans.rasters import EXTENT, MASKED, PATCHES, PIX, _deep, _located_pixels, _patches
from tilewright.plans.registry import query
from tilewright.plans.spatial import _published
from tilewright.sources import fixtures as fx
from tilewright.sources.scratch import written


def _every(n: int, changed, column: str, key: str = "tile_id") -> Column:
    return F.when(F.col(key) % n == 0, changed).otherwise(F.col(column)).alias(column)


_AT = ((0, 0), (1, 0), (1, 1), (0, 1))
_CORNERS = [q.inverse(f"x_min + {c} * width * px", f"y_max - {r} * width * px") for c, r in _AT]
LISTS = f"[{', '.join(lat for lat, _ in _CORNERS)}] AS lats, [{', '.join(lon for _, lon in _CORNERS)}] AS lons"


@query(f"""{fx.with_sql('tile')}, {q.CENTER}, c AS (SELECT *, {LISTS} FROM (SELECT * EXCLUDE (lat, lon), lat AS t_lat, lon AS t_lon FROM center)),
p AS (SELECT *, round(t_lat, 6) + CASE WHEN tile_id % 31 = 0 THEN 0.001e0 ELSE 0e0 END AS p_lat, round(t_lon, 6) AS p_lon, unnest([0, 1, 2, 3]) AS k FROM c),
e AS (SELECT *, round(lats[k + 1], 6) AS c_lat, round(lons[k + 1], 6) + CASE WHEN tile_id % 37 = 0 AND k = 2 THEN 0.001e0 ELSE 0e0 END AS c_lon FROM p)
SELECT 'geolocation-center' AS rule_id, CAST(tile_id AS VARCHAR) AS object_id, '' AS message FROM p WHERE k = 0 AND (abs(p_lat - t_lat) > 1e-5 OR abs(((p_lon - t_lon + 180) % 360 + 360) % 360 - 180) > 1e-5)
UNION ALL SELECT 'geolocation-corner', CAST(tile_id AS VARCHAR), CAST(k AS VARCHAR) FROM e WHERE abs(c_lat - lats[k + 1]) > 1e-5 OR abs(((c_lon - lons[k + 1] + 180) % 360 + 360) % 360 - 180) > 1e-5""")
def geolocation_contract(spark: SparkSession, d: str) -> DataFrame:
    t = proximity.with_corners(with_center(fx.tiles(spark, d)))
    shown = t.withColumns({"lat": geo.published(F.col("lat")) + F.when(F.col("tile_id") % 31 == 0, 0.001).otherwise(0.0), "lon": geo.published_longitude(F.col("lon")), "lats": F.transform("lats", lambda x: geo.published(x)),
                           "lons": F.transform("lons", lambda x, k: geo.published_longitude(x) + F.when((F.col("tile_id") % 37 == 0) & (k == 2), 0.001).otherwise(0.0))})
    return contract.geolocation_rules(shown)


@query(CRATERS + f""", corner AS (SELECT tile_id, {LISTS} FROM tile), s AS (SELECT p.tile_id, p.idx, p.lat + CASE WHEN p.tile_id % 41 = 0 THEN 3 ELSE 0 END AS lat, p.lon, c.lats, c.lons FROM pub p JOIN corner c ON c.tile_id = p.tile_id),
n AS (SELECT *, list_transform(lons, lambda x: ((x - lon + 180) % 360 + 360) % 360 - 180) AS near FROM s)
SELECT 'crater-outside' AS rule_id, CAST(tile_id AS VARCHAR) AS object_id, CAST(idx AS VARCHAR) AS message FROM n WHERE NOT (lat BETWEEN list_min(lats) - 0.2e0 AND list_max(lats) + 0.2e0 AND list_min(near) <= 0.2e0 AND list_max(near) >= -0.2e0)""")
def crater_containment(spark: SparkSession, d: str) -> DataFrame:
    c = _published(spark, d).select("tile_id", "idx", _every(41, F.col("lat") + 3, "lat"), "lon")
    return contract.containment_rules(c, fx.tiles(spark, d))


@query(CRATERS + """, real AS (SELECT tile_id, count(*) AS detections, count_if(matched = 1) AS matched FROM pub GROUP BY tile_id)
SELECT 'detail-count' AS rule_id, CAST(tile_id AS VARCHAR) AS object_id, 'detections' AS message FROM real WHERE tile_id % 29 = 0 AND tile_id % 43 <> 0 UNION ALL SELECT 'detail-count', CAST(tile_id AS VARCHAR), 'matched' FROM real WHERE tile_id % 31 = 0 AND tile_id % 43 <> 0
UNION ALL SELECT 'detail-unpublished', CAST(tile_id AS VARCHAR), '' FROM real WHERE tile_id % 43 = 0 UNION ALL SELECT 'detail-unknown', CAST(-1 - tile_id AS VARCHAR), '' FROM real WHERE tile_id % 47 = 0""")
def detail_counts(spark: SparkSession, d: str) -> DataFrame:
    """Some counts are off by one, some tiles have no details, and some details no tile."""
    real = written(_published(spark, d).groupBy("tile_id").agg(F.count("*").alias("detections"), F.count_if(F.col("matched") == 1).alias("matched")), "counted")  # read three times
    shown = real.where("tile_id % 43 <> 0").select("tile_id", _every(29, F.col("detections") + 1, "detections"), _every(31, F.col("matched") + 1, "matched"))
    return contract.count_rules(shown.unionByName(real.where("tile_id % 47 = 0").withColumn("tile_id", -1 - F.col("tile_id"))), real, "detail", "tile_id")


SECTOR = f"""{PIX}, {_deep(1)}, best AS (SELECT patch_id, prow, pcol, value, covered AND deep AS deep, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, prow, pcol) AS k,
  row_number() OVER (PARTITION BY patch_id, deep ORDER BY value DESC, prow, pcol) AS kd FROM deep WHERE covered),
sector AS (SELECT p.patch_id, count_if(covered) AS covered_pixels, count_if(covered AND (value < 0 OR value > 1)) AS clipped_pixels, min(CASE WHEN covered THEN value END) AS min, max(CASE WHEN covered THEN value END) AS max, avg(CASE WHEN covered THEN value END) AS mean,
  quantile_cont(CASE WHEN covered THEN value END, 0.9) AS p90, sqrt(avg(CASE WHEN covered AND ref_covered THEN pow(value - ref_value, 2) END)) AS rmse, avg(CASE WHEN covered AND ref_covered THEN abs(value - ref_value) END) AS mae FROM pixel p GROUP BY p.patch_id HAVING count_if(covered) > 0),
rec AS (SELECT s.*, a.prow AS peak_row, a.pcol AS peak_col, b.prow AS anchor_row, b.pcol AS anchor_col, b.value AS anchor_value FROM sector s LEFT JOIN best a ON a.patch_id = s.patch_id AND a.k = 1 LEFT JOIN best b ON b.patch_id = s.patch_id AND b.deep AND b.kd = 1)"""


@query(SECTOR + " SELECT patch_id, covered_pixels, clipped_pixels, round(min, 6) AS min, round(max, 6) AS max, round(mean, 6) AS mean, round(p90, 6) AS p90, round(rmse, 6) AS rmse, round(mae, 6) AS mae, peak_row, peak_col, anchor_row, anchor_col, round(anchor_value, 6) AS anchor_value FROM rec")
def sector_records(spark: SparkSession, d: str) -> DataFrame:
    r = raster.sector_records(fx.pixels(spark, d), 1)
    return r.select("patch_id", "covered_pixels", "clipped_pixels", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "p90", "rmse", "mae")), F.col("peak.prow").alias("peak_row"), F.col("peak.pcol").alias("peak_col"),
                    F.col("anchor.prow").alias("anchor_row"), F.col("anchor.pcol").alias("anchor_col"), F.round("anchor.value", 6).alias("anchor_value"))


_ICE = [("ice-statistics", 31), ("ice-pole", 37), ("ice-name", 37), ("ice-clipped", 41), ("ice-peak", 43), ("ice-errors", 59), ("ice-formula", 61), ("ice-covered", 67)]


@query(SECTOR + " " + " UNION ALL ".join([f"SELECT '{rule}' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, '' AS message FROM rec WHERE patch_id % {n} = 0" for rule, n in _ICE])
       + """ UNION ALL SELECT 'ice-anchor-presence', CAST(patch_id AS VARCHAR), '' FROM rec WHERE patch_id % 47 = 0 AND anchor_row IS NOT NULL
UNION ALL SELECT 'ice-anchor', CAST(patch_id AS VARCHAR), '' FROM rec WHERE patch_id % 53 = 0 AND patch_id % 47 <> 0 AND anchor_row IS NOT NULL""")
def ice_contract(spark: SparkSession, d: str) -> DataFrame:
    p = fx.pixels(spark, d)
    of = ("patch_id", "pole", "cell_row", "cell_col")
    south = F.col("pole") == "south"
    cell = lambda c: F.lpad(F.col(c).cast("string"), 4, "0")
    s = raster.sector_records(p, 1, of).withColumns({"lat": F.when(south, -1).otherwise(1) * (80 + 0.5 * F.col("cell_row")), "name": F.concat(F.lit("patch_"), cell("cell_row"), F.lit("_"), cell("cell_col"), F.when(south, "_S_80S").otherwise("_80N"))})
    every = lambda n, changed, column: _every(n, changed, column, "patch_id")
    shown = s.withColumn("formula", F.lit("ice-p90-bounded-v2")).select(
        "patch_id", "lat", "name", every(37, F.when(south, "north").otherwise("south"), "pole"), every(61, "old", "formula"), "min", every(31, F.col("max") + 0.01, "max"), every(67, F.col("covered_pixels") - 1, "covered_pixels"),
        every(41, F.col("clipped_pixels") + 1, "clipped_pixels"), every(59, F.lit(-1.0), "rmse"), "mae", every(43, F.col("peak").withField("prow", F.col("peak.prow") + 1), "peak"),
        F.when(F.col("patch_id") % 47 == 0, None).when(F.col("patch_id") % 53 == 0, F.when(F.col("anchor").isNotNull(), F.col("anchor").withField("value", F.col("anchor.value") + 1))).otherwise(F.col("anchor")).alias("anchor"))
    return contract.ice_rules(shown, p, 1)


@query(f"""{PIX}, {PATCHES}, {EXTENT}, place AS (SELECT concat(p.mosaic_id, '/', p.pole) AS mosaic, p.*, p.row0 - e.min_row + CASE WHEN patch_id % 31 = 0 THEN 1 ELSE 0 END AS r, p.col0 - e.min_col AS c, e.height, e.width FROM patches p JOIN extent e ON e.mosaic_id = p.mosaic_id AND e.pole = p.pole),
times AS (SELECT *, CASE WHEN patch_id % 37 = 0 THEN 0 WHEN patch_id % 41 = 0 THEN 2 ELSE 1 END AS n FROM place), each AS (SELECT *, unnest(range(n)) FROM times)
SELECT 'mosaic-placement' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, CAST(n AS VARCHAR) AS message FROM times WHERE n <> 1 UNION ALL SELECT 'mosaic-position', CAST(patch_id AS VARCHAR), mosaic FROM each WHERE patch_id % 31 = 0
UNION ALL SELECT 'mosaic-outside', CAST(patch_id AS VARCHAR), mosaic FROM each WHERE r + 8 > height OR c + 8 > width UNION ALL SELECT 'mosaic-projection', CAST(patch_id AS VARCHAR), mosaic FROM each WHERE patch_id % 43 = 0
UNION ALL SELECT 'mosaic-pole', CAST(patch_id AS VARCHAR), mosaic FROM each WHERE patch_id % 47 = 0""")
def mosaic_contract(spark: SparkSession, d: str) -> DataFrame:
    p = _patches(spark, d).withColumn("mosaic", F.concat_ws("/", "mosaic_id", "pole"))
    extent = raster.mosaic_extent(p, ("mosaic", "pole"))
    key = F.col("patch_id")
    placed = p.join(extent.select("mosaic", "min_row", "min_col"), "mosaic").select(
        F.col("mosaic").alias("mosaic_id"), "patch_id", (F.col("row0") - F.col("min_row") + F.when(key % 31 == 0, 1).otherwise(0)).alias("row"), (F.col("col0") - F.col("min_col")).alias("col"), "height", "width",
        F.explode(F.when(key % 37 == 0, F.array().cast("array<int>")).when(key % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_n")).drop("_n")
    sectors = p.select("patch_id", F.when(key % 47 == 0, "other").otherwise(F.col("pole")).alias("pole"), F.when(key % 43 == 0, "other").otherwise(F.col("pole")).alias("projection"), (F.col("col0") * 100.0).alias("x_min"), (F.col("row0") * -100.0).alias("y_max"))
    mosaics = extent.select(F.col("mosaic").alias("mosaic_id"), "pole", F.col("pole").alias("projection"), (F.col("min_col") * 100.0).alias("x_min"), (F.col("min_row") * -100.0).alias("y_max"), F.lit(100.0).alias("px"), "height", "width")
    return contract.mosaic_rules(placed, sectors, mosaics)


_MLAT, _MLON = q.inverse("x_min + col * px * 64", "y_max - row * px * 64")


@query(f"""{fx.with_sql('tile', 'pixel')}, {MASKED}, r AS (SELECT patch_id + 1 AS tile_id, count_if(mask AND covered) AS pixels, avg(CASE WHEN mask AND covered THEN prow + 0.5e0 END) AS row, avg(CASE WHEN mask AND covered THEN pcol + 0.5e0 END) AS col FROM m GROUP BY patch_id),
g AS (SELECT r.*, {_MLAT} AS lat, {_MLON} AS lon, {LISTS} FROM r JOIN tile t ON t.tile_id = r.tile_id)
SELECT tile_id, pixels, pixels * 0.25e0 AS area_m2, round(lat, 6) AS lat, CASE WHEN round(lon, 6) >= 180 THEN round(lon, 6) - 360 ELSE round(lon, 6) END AS lon, lat BETWEEN list_min(lats) AND list_max(lats) AND lon BETWEEN list_min(lons) AND list_max(lons) AS in_box FROM g""")
def imp_regions(spark: SparkSession, d: str) -> DataFrame:
    """Masks of 8 x 8 pixels laid over the tile of the next number."""
    masks = raster.mask_records(raster.segmented(fx.pixels(spark, d)), 0.25).withColumn("tile_id", F.col("patch_id") + 1)
    tiles = fx.tiles(spark, d).drop("split").withColumns({"width": F.lit(8), "px": F.col("px") * 64})
    rows = raster.mask_regions(proximity.with_corners(tiles), masks)
    return rows.select("tile_id", "pixels", "area_m2", geo.published(F.col("lat")).alias("lat"), geo.published_longitude(F.col("lon")).alias("lon"), proximity.in_box().alias("in_box"))


OBJECTS = f"{fx.with_sql('tile', 'pixel')}, obj AS (SELECT 'crater-detection' AS task, split, concat(kind, '/', CAST(lon0 AS INT)) AS place FROM tile UNION ALL SELECT 'ice-prospectivity', split, concat(pole, '/', cell_row, '/', cell_col) FROM pixel WHERE prow = 0 AND pcol = 0)"


def _objects(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tiles(spark, d).select(F.lit("crater-detection").alias("task"), "split", F.concat_ws("/", "kind", F.col("lon0").cast("int")).alias("place"))
    return t.unionByName(fx.pixels(spark, d).where("prow = 0 AND pcol = 0").select(F.lit("ice-prospectivity").alias("task"), "split", F.concat_ws("/", "pole", "cell_row", "cell_col").alias("place")))


@query(OBJECTS + " SELECT task, count(*) AS objects, count_if(split = 'train') AS train, count_if(split = 'validation') AS validation, count_if(split = 'test') AS test, count_if(split = 'external') AS \"external\" FROM obj GROUP BY task")
def manifest_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.manifest_counts(_objects(spark, d))


@query(OBJECTS + """ SELECT 'manifest-count' AS rule_id, task AS object_id, 'test' AS message FROM obj WHERE task = 'crater-detection' GROUP BY task UNION ALL SELECT 'manifest-count', task, 'objects' FROM obj WHERE task = 'crater-detection' GROUP BY task""")
def manifest_contract(spark: SparkSession, d: str) -> DataFrame:
    """The crater counts of the manifest lag one test tile behind."""
    real = catalogue.manifest_counts(_objects(spark, d))
    crater = F.when(F.col("task") == "crater-detection", 1).otherwise(0)
    return contract.count_rules(real.withColumns({"test": F.col("test") - crater, "objects": F.col("objects") - crater}), real, "manifest", "task")


_KILOBYTES = {"crater-detection": 60.0, "ice-prospectivity": 150.0}


@query(OBJECTS + """ SELECT task, count_if(split IN ('train', 'validation')) AS added, count(DISTINCT CASE WHEN split = 'test' THEN place END) AS test_places, count(DISTINCT place) AS places,
round(count_if(split IN ('train', 'validation')) * CASE task WHEN 'crater-detection' THEN 60e0 ELSE 150e0 END / 1024, 1) AS storage_mb FROM obj GROUP BY task""")
def decision_inputs(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.decision_inputs(_objects(spark, d), _KILOBYTES)


NAMED = "WITH obj AS (SELECT c_custkey AS k, n_name AS task, r_name AS model, n_name || '-set' AS dataset FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"


def _named(spark: SparkSession, d: str) -> DataFrame:
    names = fx.table(spark, d, "nation").join(fx.table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", F.col("n_name").alias("task"), F.col("r_name").alias("model"), F.concat("n_name", F.lit("-set")).alias("dataset"))
    return fx.table(spark, d, "customer").join(names, F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("k"), "task", "model", "dataset")


@query(NAMED + """, src AS (SELECT 'model' AS kind, r_name AS source_id, 'r' || r_regionkey AS revision FROM region UNION ALL SELECT 'dataset', n_name || '-set', 'n' || n_nationkey FROM nation WHERE n_nationkey <> 3),
used AS (SELECT 'model' AS kind, model AS source_id, count(*) AS objects FROM obj GROUP BY model UNION ALL SELECT 'dataset', dataset, count(*) FROM obj GROUP BY dataset) SELECT u.kind, u.source_id, u.objects, s.revision FROM used u LEFT JOIN src s ON s.kind = u.kind AND s.source_id = u.source_id""")
def sources_used(spark: SparkSession, d: str) -> DataFrame:
    models = fx.table(spark, d, "region").select(F.lit("model").alias("kind"), F.col("r_name").alias("source_id"), F.concat(F.lit("r"), "r_regionkey").alias("revision"))
    sets = fx.table(spark, d, "nation").where("n_nationkey <> 3").select(F.lit("dataset").alias("kind"), F.concat("n_name", F.lit("-set")).alias("source_id"), F.concat(F.lit("n"), "n_nationkey").alias("revision"))
    return catalogue.sources_used(_named(spark, d), models.unionByName(sets))


@query(NAMED + """, runs AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 10 = 7 THEN 'validation' ELSE 'test' END AS split, max(o_orderkey) AS c FROM orders GROUP BY ALL)
SELECT o.k, CASE WHEN r.k IS NOT NULL THEN concat_ws('|', task, dataset, CAST(o.k AS VARCHAR), split, model, 'c' || c, 'rev', 'ref', 'v1') END AS provenance FROM obj o LEFT JOIN runs r ON r.k = o.k""")
def provenance_records(spark: SparkSession, d: str) -> DataFrame:
    """Customers are objects, their orders a run, and those without orders have none."""
    objects = _named(spark, d)
    pins = objects.select("task", "model", "dataset").distinct().withColumn("reference", F.lit("ref"))
    o = objects.select("k", "task", F.col("k").cast("string").alias("sample"))
    last = fx.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("c"))
    runs = o.join(last, "k").select("task", "sample", F.when(F.col("k") % 10 == 7, "val").otherwise("test").alias("split"), F.concat(F.lit("c"), "c").alias("checkpoint"), F.lit("rev").alias("revision"))
    p = catalogue.with_provenance(o, runs, pins, "v1")
    return p.select("k", F.when(F.col("provenance").isNotNull(), F.concat_ws("|", *[F.col(f"provenance.{c}") for c in ("task", "source_dataset", "source_tile", "dataset_split", "model", "checkpoint", "model_revision", "reference_source", "processing_version")])).alias("provenance"))


_SPLITS = ["test", "validation", "train", "external"]
#: A tile's record: its id, provenance, boxes and metrics.
TILE_SCHEMA = {"type": "object", "required": ["id", "provenance", "boxes"], "properties": {
    "id": {"type": "string", "pattern": "^wac-[0-9]+$"},
    "provenance": {"type": "object", "required": ["task", "model", "split", "revision"], "properties": {"task": {"const": "crater-detection"}, "split": {"enum": _SPLITS}, "grid": {"type": "object", "properties": {"px": {"minimum": 1, "maximum": 100}}}}},
    "boxes": {"type": "array", "minItems": 1, "items": {"type": "object", "properties": {"w": {"type": "number", "maximum": 52}, "score": {"type": "number", "minimum": 0.055, "maximum": 1}}}},
    "metrics": {"additionalProperties": {"type": "object", "oneOf": ["value", "flag"], "properties": {"value": {"minimum": 0, "maximum": 100}}}}}}


@query(f"""{fx.with_sql('tile', 'det')}, t AS (SELECT tile_id, CASE WHEN tile_id % 19 = 0 THEN 'mock-' ELSE 'wac-' END || tile_id AS id, CASE WHEN tile_id % 17 = 0 THEN 'val' ELSE split END AS sp, CASE WHEN tile_id % 23 <> 0 THEN 'm' END AS model, CASE WHEN tile_id % 29 = 0 THEN 400e0 ELSE px END AS size, tile_id % 150 AS share FROM tile),
b AS (SELECT tile_id, row_number() OVER (PARTITION BY tile_id ORDER BY idx) - 1 AS i, w, score FROM det), none AS (SELECT * FROM t WHERE tile_id NOT IN (SELECT tile_id FROM b))
SELECT 'tile-pattern' AS rule_id, CAST(tile_id AS VARCHAR) AS object_id, '$.id' AS message FROM t WHERE NOT regexp_matches(id, '^wac-[0-9]+$') UNION ALL SELECT 'tile-enum', CAST(tile_id AS VARCHAR), '$.provenance.split' FROM t WHERE sp NOT IN ('test', 'validation', 'train', 'external')
UNION ALL SELECT 'tile-required', CAST(tile_id AS VARCHAR), '$.provenance.model' FROM t WHERE model IS NULL UNION ALL SELECT 'tile-required', CAST(tile_id AS VARCHAR), '$.provenance.revision' FROM t UNION ALL SELECT 'tile-maximum', CAST(tile_id AS VARCHAR), '$.provenance.grid.px' FROM t WHERE size > 100
UNION ALL SELECT 'tile-minItems', CAST(tile_id AS VARCHAR), '$.boxes' FROM none UNION ALL SELECT 'tile-maximum', CAST(b.tile_id AS VARCHAR), '$.boxes[' || i || '].w' FROM b JOIN t USING (tile_id) WHERE w > 52 UNION ALL SELECT 'tile-minimum', CAST(b.tile_id AS VARCHAR), '$.boxes[' || i || '].score' FROM b JOIN t USING (tile_id) WHERE score < 0.055
UNION ALL SELECT 'tile-maximum', CAST(tile_id AS VARCHAR), '$.metrics.share.value' FROM t WHERE share > 100 UNION ALL SELECT 'tile-oneOf', CAST(tile_id AS VARCHAR), '$.metrics.whole' FROM t WHERE tile_id % 31 = 0""")
def schema_conformance(spark: SparkSession, d: str) -> DataFrame:
    """Records of all tiles and their boxes against a schema: faults in fields, nested fields, elements of arrays and values of maps. No
    record has a revision; widths, scores and shares break their bounds where the data do."""
    t, k = fx.tiles(spark, d), F.col("tile_id")
    held = fx.detections(spark, d).groupBy("tile_id").agg(F.sort_array(F.collect_list(F.struct("idx", "w", "score"))).alias("boxes"))
    metric = lambda v, f: F.struct(v.cast("double").alias("value"), f.cast("boolean").alias("flag"))
    none = F.lit(None)
    rows = t.join(held, "tile_id", "left").select(k, F.concat(F.when(k % 19 == 0, "mock-").otherwise("wac-"), k.cast("string")).alias("id"),
                                                  F.struct(F.lit("crater-detection").alias("task"), F.when(k % 23 != 0, "m").alias("model"), F.when(k % 17 == 0, "val").otherwise(F.col("split")).alias("split"), F.struct(F.when(k % 29 == 0, 400.0).otherwise(F.col("px")).alias("px")).alias("grid")).alias("provenance"),
                                                  F.coalesce("boxes", F.expr("cast(array() as array<struct<idx:int,w:double,score:double>>)")).alias("boxes"),
                                                  F.create_map(F.lit("share"), metric(k % 150, none), F.lit("whole"), metric(none, F.when(k % 31 != 0, True))).alias("metrics"))
    return conformance.conformance(rows, TILE_SCHEMA, "tile_id", "tile")


_X, _Y = "((cell_col * 8 + pcol + 0.5e0) * 240)", "(-(cell_row * 8 + prow + 0.5e0) * 240)"


@query(f"""{PIX}, off AS (SELECT patch_id, prow, pcol FROM pixel WHERE NOT covered), grid AS (SELECT *, 'ps' AS kind, CASE WHEN pole = 'south' THEN -90e0 ELSE 90e0 END AS lat0, 0e0 AS lon0, 1e0 AS k0, 0e0 AS fe, 0e0 AS fn FROM pixel WHERE covered),
dist AS (SELECT *, {q.inverse(_X, _Y)[0]} AS lat, {q.inverse(_X, _Y)[1]} AS lon, least(prow, pcol, 7 - prow, 7 - pcol, coalesce((SELECT min(greatest(abs(o.prow - p.prow), abs(o.pcol - p.pcol))) - 1 FROM off o WHERE o.patch_id = p.patch_id), 99)) AS e FROM grid p),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patch_id, part ORDER BY value DESC, prow, pcol) AS k FROM (SELECT 'peak' AS part, * FROM dist UNION ALL SELECT 'anchor', * FROM dist WHERE e >= 1)) WHERE k = 1),
told AS (SELECT * REPLACE (CASE WHEN patch_id % 13 = 0 THEN -90e0 ELSE lat0 END AS lat0), CASE WHEN part = 'peak' THEN least(e, 1) WHEN patch_id % 4 = 0 THEN 0 ELSE e END AS t_edge, CASE WHEN part = 'peak' AND patch_id % 3 = 0 THEN round(lat, 3) ELSE lat END AS t_lat, CASE WHEN part = 'anchor' AND patch_id % 7 = 0 THEN lon + 360 ELSE lon END AS t_lon FROM pick),
seen AS (SELECT *, {q.inverse(_X, _Y)[0]} AS x_lat, {q.inverse(_X, _Y)[1]} AS x_lon FROM told)
SELECT 'ice-projection-pole' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, '' AS message FROM seen WHERE part = 'peak' AND (lat0 < 0) <> (pole = 'south') UNION ALL SELECT 'ice-id', CAST(patch_id AS VARCHAR), '' FROM seen WHERE part = 'peak' AND patch_id % 11 = 0 AND pole = 'north'
UNION ALL SELECT 'ice-anchor-method', CAST(patch_id AS VARCHAR), '' FROM seen WHERE part = 'anchor' AND (t_edge < 1 OR patch_id % 17 = 0) UNION ALL SELECT 'ice-' || part || '-edge', CAST(patch_id AS VARCHAR), '' FROM seen WHERE t_edge <> e
UNION ALL SELECT 'ice-' || part || '-range', CAST(patch_id AS VARCHAR), '' FROM seen WHERE t_lon >= 180 UNION ALL SELECT 'ice-' || part || '-coordinate', CAST(patch_id AS VARCHAR), '' FROM seen WHERE abs(x_lat - t_lat) > 1e-6 OR abs(((x_lon - t_lon + 180) % 360 + 360) % 360 - 180) > 1e-6""")
def ice_places(spark: SparkSession, d: str) -> DataFrame:
    """Published peaks and anchors: distances cut at one pixel, coordinates with few digits or beyond the antimeridian, ids and projections
    that tell the south, other methods."""
    p = _located_pixels(spark, d)
    n, south = F.col("patch_id"), F.col("pole") == "south"
    at = F.struct("value", "prow", "pcol", "edge_distance", "lat", "lon")
    order = F.struct(-F.col("value"), "prow", "pcol")
    rows = raster.edge_distance(p.select("patch_id", "prow", "pcol", "covered", "value", "lat", "lon", "pole", "cell_row", "cell_col")).where("edge_distance IS NOT NULL")
    deep = F.col("edge_distance") >= 1
    s = rows.groupBy("patch_id", "pole", "cell_row", "cell_col").agg(F.min_by(at, order).alias("peak"), F.min_by(F.when(deep, at), F.when(deep, order)).alias("anchor"))
    peak = F.col("peak").withField("edge_distance", F.least(F.col("peak.edge_distance"), F.lit(1))).withField("lat", F.when(n % 3 == 0, F.round("peak.lat", 3)).otherwise(F.col("peak.lat")))
    anchor = F.col("anchor").withField("edge_distance", F.when(n % 4 == 0, 0).otherwise(F.col("anchor.edge_distance"))).withField("lon", F.when(n % 7 == 0, F.col("anchor.lon") + 360).otherwise(F.col("anchor.lon")))
    anchor = anchor.withField("method", F.when(n % 17 == 0, "max").otherwise(contract.ANCHOR_METHOD)).withField("edge_margin", F.lit(1))
    shown = s.select("patch_id", F.concat(F.lit("ice-"), F.when(south | (n % 11 == 0), "s").otherwise("n"), F.lit("-"), n.cast("string")).alias("id"), "pole", F.lit("ps").alias("kind"), F.when(south | (n % 13 == 0), -90.0).otherwise(90.0).alias("lat0"), F.lit(0.0).alias("lon0"), F.lit(1.0).alias("k0"),
                     F.lit(0.0).alias("fe"), F.lit(0.0).alias("fn"), (F.col("cell_col") * 8 * 240.0).alias("x_min"), (-F.col("cell_row") * 8 * 240.0).alias("y_max"), F.lit(240.0).alias("px"), peak.alias("peak"), F.when(F.col("anchor").isNotNull(), anchor).alias("anchor"))
    return contract.ice_place_rules(shown, p, 1)


_ENCODED = """range_ AS (SELECT patch_id, min(value) AS lo, CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) / 65535 ELSE 1e0 END AS scale FROM pixel WHERE covered GROUP BY patch_id),
decoded AS (SELECT p.*, scale, lo + scale * CAST(round_even((value - lo) / scale, 0) AS INT) AS decoded FROM pixel p JOIN range_ r ON r.patch_id = p.patch_id WHERE covered)"""


@query(f"""{PIX}, {_ENCODED}, shown AS (SELECT p.patch_id, p.prow, p.pcol, d.decoded, d.scale, CAST(round_even(least(greatest(coalesce(d.decoded, 0), 0), 1) * 255, 0) AS INT) + CASE WHEN p.patch_id % 7 = 0 THEN p.prow ELSE 0 END AS red,
  CASE WHEN p.patch_id % 13 = 0 AND p.pcol = 2 THEN 128 WHEN p.patch_id % 17 = 0 OR p.covered THEN 255 ELSE 0 END AS alpha FROM pixel p LEFT JOIN decoded d ON d.patch_id = p.patch_id AND d.prow = p.prow AND d.pcol = p.pcol),
n AS (SELECT patch_id, count_if(alpha NOT IN (0, 255)) AS a, count_if((alpha = 255) <> (decoded IS NOT NULL)) AS c, count_if(patch_id % 11 = 0 AND (prow + pcol) % 5 = 0) AS g, count_if(decoded IS NOT NULL AND abs(red - round_even(least(greatest(decoded, 0), 1) * 255, 0)) > 1 + 255 * scale) AS v FROM shown GROUP BY patch_id)
SELECT 'display-alpha' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, CAST(a AS VARCHAR) AS message FROM n WHERE a > 0 UNION ALL SELECT 'display-coverage', CAST(patch_id AS VARCHAR), CAST(c AS VARCHAR) FROM n WHERE c > 0
UNION ALL SELECT 'display-gray', CAST(patch_id AS VARCHAR), CAST(g AS VARCHAR) FROM n WHERE g > 0 UNION ALL SELECT 'display-clip', CAST(patch_id AS VARCHAR), CAST(v AS VARCHAR) FROM n WHERE v > 0""")
def display_contract(spark: SparkSession, d: str) -> DataFrame:
    """Display rasters made from the decoded ones, some brighter from row to row, some coloured, some with other alphas."""
    p = fx.pixels(spark, d)
    decoded = raster.quantized(p).select("patch_id", "prow", "pcol", "decoded", "scale")
    n = F.col("patch_id")
    rows = p.select("patch_id", "prow", "pcol", "covered").join(decoded, ["patch_id", "prow", "pcol"], "left")
    red = raster.display_level(F.coalesce("decoded", F.lit(0.0))) + F.when(n % 7 == 0, F.col("prow")).otherwise(0)
    alpha = F.when((n % 13 == 0) & (F.col("pcol") == 2), 128).when((n % 17 == 0) | F.col("covered"), 255).otherwise(0)
    shown = rows.select("patch_id", "prow", "pcol", red.alias("red"), red.alias("green"), (red + F.when((n % 11 == 0) & ((F.col("prow") + F.col("pcol")) % 5 == 0), 1).otherwise(0)).alias("blue"), alpha.alias("alpha"))
    return contract.display_rules(shown, decoded)


@query(f"""{PIX}, {_ENCODED}, top AS (SELECT mosaic_id, pole, min(value) AS lo, CASE WHEN max(value) > min(value) THEN (max(value) - min(value)) / 65535 ELSE 1e0 END AS scale FROM pixel WHERE covered GROUP BY ALL),
m AS (SELECT p.patch_id, p.prow, p.pcol, lo + scale * CAST(round_even((value - lo) / scale, 0) AS INT) + CASE WHEN p.patch_id % 19 = 0 THEN value * value / 1000 ELSE 0 END AS shown, scale AS m_scale FROM pixel p JOIN top USING (mosaic_id, pole) WHERE covered AND NOT (p.patch_id % 23 = 0 AND pcol < 2)),
n AS (SELECT p.patch_id, count_if((d.decoded IS NULL) <> (m.shown IS NULL)) AS c, count_if(abs(d.decoded - m.shown) > (d.scale + m_scale) / 2 + 1e-9) AS v FROM pixel p LEFT JOIN decoded d ON d.patch_id = p.patch_id AND d.prow = p.prow AND d.pcol = p.pcol LEFT JOIN m ON m.patch_id = p.patch_id AND m.prow = p.prow AND m.pcol = p.pcol GROUP BY p.patch_id)
SELECT 'mosaic-coverage' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, CAST(c AS VARCHAR) AS message FROM n WHERE c > 0 UNION ALL SELECT 'mosaic-value', CAST(patch_id AS VARCHAR), CAST(v AS VARCHAR) FROM n WHERE v > 0""")
def mosaic_values(spark: SparkSession, d: str) -> DataFrame:
    """Patches against mosaics of an encoding of their own, in which some values are off by what they are themselves, and some are missing."""
    p = fx.pixels(spark, d)
    at = {"mrow": F.col("cell_row") * 8 + F.col("prow"), "mcol": F.col("cell_col") * 8 + F.col("pcol")}
    decoded = raster.quantized(p).select("patch_id", "prow", "pcol", "decoded", "scale")
    patches = p.withColumns(at).select("patch_id", "mosaic_id", "pole", "prow", "pcol", "mrow", "mcol").join(decoded, ["patch_id", "prow", "pcol"], "left")
    whole = raster.quantized(p.withColumns(at).withColumns({"own": F.col("patch_id"), "patch_id": F.concat_ws("/", "mosaic_id", "pole")}))
    off = F.when(F.col("own") % 19 == 0, F.col("value") * F.col("value") / 1000).otherwise(0.0)
    mosaic = whole.where("NOT (own % 23 = 0 AND pcol < 2)").select("mosaic_id", "pole", "mrow", "mcol", (F.col("decoded") + off).alias("decoded"), "scale")
    return contract.mosaic_value_rules(patches, mosaic)
