"""Queries of names, grids, samples and layers: what a build reads before it computes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions import geo
from tilewright.operators import boxes, catalogue, contract, proximity, raster, text
from tilewright.plans import sphere_sql as q
from tilewright.plans.rasters import PIX
from tilewright.plans.registry import query
from tilewright.sources import collections as src
from tilewright.sources import fixtures as fx
from tilewright.sources.scratch import new_path, written

_K = "c_custkey"
_CRATER = f"'M' || {_K} || 'CE_' || ({_K} * 7 % 9999) || '_' || ({_K} % 512) || CASE WHEN {_K} % 5 = 0 THEN '_x' ELSE '' END"
_IMP = f"'M1' || {_K} || CASE WHEN {_K} % 2 = 0 THEN 'RE' ELSE 'LE' END || '.ech.cog__target_' || ({_K} % 97) || '__idx_' || {_K} || CASE WHEN {_K} % 4 = 0 THEN '_p1' ELSE '_p0' END"
_TILE = f"'M' || {_K} || CASE WHEN {_K} % 6 = 0 THEN '_goal_' ELSE '_target_' END || ({_K} % 97) || CASE WHEN {_K} % 7 = 0 THEN '' ELSE '_img' END || '.tif'"


@query(f"""WITH n AS (SELECT {_K} AS k, {_CRATER} AS crater, {_IMP} AS imp, {_TILE} AS tile FROM customer)
SELECT k, CASE WHEN k % 5 > 0 THEN 'wac-m' || k || 'ce-' || (k * 7 % 9999) || '-' || (k % 512) END AS region_id, CASE WHEN k % 4 > 0 THEN 'imp-m1' || k || CASE WHEN k % 2 = 0 THEN 're' ELSE 'le' END || '-t' || (k % 97) || '-i' || k END AS imp_id,
CASE WHEN k % 6 > 0 THEN CAST(k % 97 AS VARCHAR) END AS target, replace(replace(tile, '.tif', ''), '_img', '') AS sample, split_part(imp, '.', 1) AS product FROM n""")
def sample_names(spark: SparkSession, d: str) -> DataFrame:
    """Ids, targets, samples and products that names tell; some names have other forms."""
    n = fx.table(spark, d, "customer").selectExpr("c_custkey AS k", f"{_CRATER} AS crater", f"{_IMP} AS imp", f"{_TILE} AS tile")
    return n.select("k", text.crater_region_id(F.col("crater")).alias("region_id"), text.imp_region_id(F.col("imp")).alias("imp_id"), text.target_id(F.col("tile")).alias("target"), text.sample_of(F.col("tile")).alias("sample"), text.product_id(F.col("imp")).alias("product"))


@query(f"""{PIX}, p AS (SELECT patch_id, pole AS named, CASE WHEN patch_id % 23 = 0 THEN 'north' ELSE pole END AS tagged, CASE WHEN patch_id % 29 = 0 THEN NULL ELSE pole END AS projected FROM pixel WHERE prow = 0 AND pcol = 0)
SELECT patch_id FROM p WHERE named IS DISTINCT FROM tagged OR named IS DISTINCT FROM projected""")
def pole_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Patches whose name, tag and projection do not all tell the same pole."""
    p = fx.pixels(spark, d).where("prow = 0 AND pcol = 0")
    named = text.pole_of_name(F.concat(F.lit("patch_"), F.col("patch_id").cast("string"), F.when(F.col("pole") == "south", "_S_80S").otherwise("_80N")))
    rows = p.select("patch_id", named.alias("named"), F.when(F.col("patch_id") % 23 == 0, "north").otherwise(F.col("pole")).alias("tagged"), F.when(F.col("patch_id") % 29 != 0, F.col("pole")).alias("projected"))
    return text.pole_violations(rows, "named", "tagged", "projected").select("patch_id")


@query(f"""{fx.with_sql('tile')} SELECT tile_id, round(x_min + 0.12345e0, 3) AS x_min, round(y_max + 0.12345e0, 3) AS y_max, round(px + 0.0000012e0, 6) AS px, tile_id % 7 > 0 AND tile_id % 11 > 0 AS north_up,
concat_ws('|', kind, CAST(lat0 AS VARCHAR), CAST(lon0 AS VARCHAR), CAST(round(x_min, 3) AS VARCHAR), CAST(round(x_min + width * px, 3) AS VARCHAR), CAST(round(y_max - width * px, 3) AS VARCHAR), CAST(round(y_max, 3) AS VARCHAR)) AS footprint FROM tile""")
def grid_keys(spark: SparkSession, d: str) -> DataFrame:
    """Published grids, footprint keys, and whether transforms (of which some are turned or flipped) are north up."""
    t, c, side = fx.tiles(spark, d), F.col, F.col("width") * F.col("px")
    grid = geo.grid_record(c("x_min") + 0.12345, c("y_max") + 0.12345, c("px") + 0.0000012, c("px"), c("width"), c("width"))
    up = geo.north_up(c("px"), F.when(c("tile_id") % 7 == 0, 0.5).otherwise(0.0), F.lit(0.0), F.when(c("tile_id") % 11 == 0, c("px")).otherwise(-c("px")))
    key = geo.footprint_key(c("kind"), c("lat0"), c("lon0"), c("x_min"), c("y_max"), side, side)
    return t.select("tile_id", grid.alias("g"), up.alias("north_up"), key.alias("footprint")).select("tile_id", "g.x_min", "g.y_max", "g.px", "north_up", "footprint")


@query(f"""{fx.with_sql('tile')} SELECT tile_id, CASE WHEN tile_id % 9 > 0 THEN kind END AS kind, CASE WHEN tile_id % 9 > 0 THEN lat0 END AS lat0, CASE WHEN tile_id % 9 > 0 THEN lon0 END AS lon0, CASE WHEN tile_id % 9 > 0 THEN CASE WHEN tile_id % 4 = 0 THEN 1e0 ELSE k0 END END AS k0, CASE WHEN tile_id % 9 > 0 THEN fe END AS fe, CASE WHEN tile_id % 9 > 0 THEN fn END AS fn, CASE WHEN tile_id % 9 > 0 THEN 1737400e0 END AS radius FROM tile""")
def projection_records(spark: SparkSession, d: str) -> DataFrame:
    """Projections of parameter strings; some are of other kinds, some lack their scale."""
    t, s = fx.tiles(spark, d), lambda c: F.col(c).cast("string")
    kind = F.when(F.col("tile_id") % 9 == 0, "longlat").when(F.col("kind") == "ps", "stere").otherwise("tmerc")
    crs = F.concat(F.lit("+proj="), kind, F.lit(" +lat_0="), s("lat0"), F.lit(" +lon_0="), s("lon0"), F.when(F.col("tile_id") % 4 == 0, "").otherwise(F.concat(F.when(F.col("tile_id") % 2 == 0, " +k_0=").otherwise(" +k="), s("k0"))), F.lit(" +x_0="), s("fe"), F.lit(" +y_0="), s("fn"), F.lit(" +R=1737400"))
    return t.select("tile_id", geo.projection_of(crs).alias("p")).select("tile_id", "p.kind", "p.lat0", "p.lon0", "p.k0", "p.fe", "p.fn", "p.radius")


@query("SELECT 'S' || p_partkey AS sample, CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE 2 END AS n FROM part WHERE p_partkey % 17 = 0 OR p_partkey % 13 = 0")
def requested_samples(spark: SparkSession, d: str) -> DataFrame:
    """Requested samples with no metadata row or two, from a metadata table of file names."""
    part, path = fx.table(spark, d, "part").select(F.col("p_partkey").alias("k")), new_path(spark, "metadata")
    name = F.concat(F.lit("a/b/S"), F.col("k").cast("string"), F.lit(".nc")).alias("WAC_VIS_TILE")
    part.where("k % 17 <> 0").select(name).unionByName(part.where("k % 13 = 0 AND k % 17 <> 0").select(name)).write.parquet(path)
    return src.exactly_one(part.select(F.concat(F.lit("S"), F.col("k").cast("string")).alias("sample")), src.tile_metadata(spark, path))


@query(f"""{fx.with_sql('det')}, t AS (SELECT p_partkey AS k FROM part), b AS (SELECT tile_id, count(*) AS boxes, round(sum(x + w), 3) AS total FROM det WHERE tile_id % 11 > 0 AND tile_id % 5 > 0 GROUP BY tile_id)
SELECT 'S' || k AS sample, k % 11 > 0 AS known, coalesce(boxes, 0) AS boxes, total FROM t LEFT JOIN b ON b.tile_id = k WHERE k % 5 > 0""")
def annotated_samples(spark: SparkSession, d: str) -> DataFrame:
    """Annotation documents of 64 tiles each, of most tiles, restricted to wanted samples, of which some have no image."""
    det, path = fx.detections(spark, d).where("tile_id % 11 <> 0"), new_path(spark, "coco")
    stem = lambda c: F.concat(F.lit("S"), F.col(c).cast("string"))
    part = F.floor(F.col("tile_id") / 64).alias("part")
    image = fx.tiles(spark, d).where("tile_id % 11 <> 0").groupBy(part).agg(F.collect_list(F.struct(F.col("tile_id").alias("id"), F.concat(F.lit("img/"), stem("tile_id"), F.lit(".png")).alias("file_name"))).alias("images"))
    boxes_ = det.groupBy(part).agg(F.collect_list(F.struct(F.col("tile_id").alias("image_id"), F.array("x", "y", "w", "h").alias("bbox"))).alias("annotations"))
    image.join(boxes_, "part", "left").repartition("part").write.partitionBy("part").json(path)
    wanted = fx.tiles(spark, d).where("tile_id % 5 <> 0").select(stem("tile_id").alias("sample"))
    images, found, missing = src.coco(spark, path, wanted)
    per = found.join(images, "image_id").groupBy("sample").agg(F.count("*").alias("boxes"), F.round(F.sum(F.col("x") + F.col("w")), 3).alias("total"))
    known = images.select("sample", F.lit(True).alias("known")).unionByName(missing.select("sample", F.lit(False).alias("known")))
    return known.join(per, "sample", "left").select("sample", "known", F.coalesce("boxes", F.lit(0)).cast("long").alias("boxes"), "total")


@query(f"""{PIX} SELECT DISTINCT 'patch_' || cell_row || '_' || cell_col AS patch FROM pixel WHERE patch_id % 9 > 0""")
def patch_names(spark: SparkSession, d: str) -> DataFrame:
    """Patches that a listing of their layers' files names; other files are left out."""
    p = fx.pixels(spark, d).where("prow = 0 AND pcol = 0")
    p = p.withColumn("layer", F.explode(F.array(F.lit("slope"), F.lit("tmax"))))
    file = F.concat(F.lit("layers/"), F.col("layer"), F.lit("/"), F.when(F.col("patch_id") % 9 == 0, "readme").otherwise("patch"), F.lit("_"), F.col("cell_row").cast("string"), F.lit("_"), F.col("cell_col").cast("string"), F.lit(".tif"))
    return src.patch_listing(p.select(file.alias("path")), r"/(patch_\d+_\d+)\.tif$")


@query(f"""{PIX} SELECT patch_id, count(*) AS pixels, round(sum(value), 5) AS a, round(sum(ref_value), 5) AS b, count_if((patch_id + prow) % 6 > 0 AND covered) AS covered FROM pixel WHERE patch_id % 31 > 0 AND patch_id % 37 > 0 GROUP BY patch_id
UNION ALL SELECT patch_id, NULL, NULL, NULL, NULL FROM pixel WHERE (patch_id % 31 = 0 OR patch_id % 37 = 0) AND prow = 0 AND pcol = 0""")
def patch_layers(spark: SparkSession, d: str) -> DataFrame:
    """Layers put together pixel by pixel, and how many pixels have numbers in all; patches whose layers differ in grid, or lack one, are nulls."""
    p = fx.pixels(spark, d)
    layer = lambda v, g: p.select("patch_id", "prow", "pcol", g.alias("grid"), v.alias("value"))
    grid = F.when(F.col("patch_id") % 31 == 0, "other").otherwise("g")
    wide, bad = src.assembled({"a": layer(F.col("value"), F.lit("g")), "b": layer(F.col("ref_value"), grid).where("patch_id % 37 <> 0")})
    mask = p.select("patch_id", "prow", "pcol", F.when(F.col("covered"), 1.0).otherwise(F.lit(float("nan"))).alias("m"), F.when((F.col("patch_id") + F.col("prow")) % 6 > 0, 0.0).alias("n"))
    seen = raster.coverage(wide.join(mask, ["patch_id", "prow", "pcol"]), "a", "b", "m", "n")
    good = seen.groupBy("patch_id").agg(F.count("*").alias("pixels"), F.round(F.sum("a"), 5).alias("a"), F.round(F.sum("b"), 5).alias("b"), F.count_if("covered").alias("covered"))
    none = F.lit(None)
    return good.unionByName(bad.select("patch_id", none.cast("long").alias("pixels"), none.cast("double").alias("a"), none.cast("double").alias("b"), none.cast("long").alias("covered")))


_PX, _PY = "x_min + (pcol + 0.5e0) * px", "y_max - (prow + 0.5e0) * px"


@query(f"""{fx.with_sql('tile', 'pixel')}, off AS (SELECT patch_id, prow, pcol FROM pixel WHERE NOT covered),
p AS (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, prow, pcol) AS k, least(prow, pcol, 7 - prow, 7 - pcol, coalesce((SELECT min(greatest(abs(o.prow - x.prow), abs(o.pcol - x.pcol))) - 1 FROM off o WHERE o.patch_id = x.patch_id), 99)) AS e FROM pixel x WHERE covered)
SELECT patch_id, prow, pcol, round(value, 6) AS value, e AS edge_distance, round({q.inverse(_PX, _PY)[0]}, 6) AS lat, round({q.inverse(_PX, _PY)[1]}, 6) AS lon FROM p JOIN tile t ON t.tile_id = p.patch_id WHERE k = 1""")
def pixel_records(spark: SparkSession, d: str) -> DataFrame:
    """The peak of each patch with its coordinates in the tile of that number, its value and its distance to the edge."""
    p = raster.edge_distance(fx.pixels(spark, d).select("patch_id", "prow", "pcol", "value", "covered"))
    top = p.join(raster.peak(p).select("patch_id", "prow", "pcol"), ["patch_id", "prow", "pcol"], "left_semi").withColumn("tile_id", F.col("patch_id"))
    at = raster.geolocated(fx.tiles(spark, d), top)
    return at.select("patch_id", "prow", "pcol", F.round("value", 6).alias("value"), "edge_distance", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""{fx.with_sql('tile')}, r AS (SELECT tile_id, 'crater|' || split || '|' || CASE WHEN tile_id % 3 = 0 THEN tile_id - tile_id % 9 ELSE tile_id END AS key FROM tile)
SELECT 'entry' AS what, key, count(*) AS n FROM r WHERE starts_with(key, 'crater|test') GROUP BY key UNION ALL SELECT 'duplicate-identity', key, count(*) FROM r GROUP BY key HAVING count(*) > 1""")
def region_identities(spark: SparkSession, d: str) -> DataFrame:
    """Identity keys of regions: entries of one prefix, and keys that several regions share."""
    tile = F.when(F.col("tile_id") % 3 == 0, F.col("tile_id") - F.col("tile_id") % 9).otherwise(F.col("tile_id"))
    r = fx.tiles(spark, d).select("tile_id", catalogue.region_key(F.lit("crater"), F.col("split"), tile).alias("key"))
    entries = catalogue.registry_entries(r, "crater|test").groupBy("key").agg(F.count("*").alias("n")).select(F.lit("entry").alias("what"), "key", "n")
    twice = catalogue.duplicate_keys(r).select(F.col("rule_id").alias("what"), F.col("object_id").alias("key"), F.col("message").cast("long").alias("n"))
    return entries.unionByName(twice)


@query(f"""{PIX}, c AS (SELECT patch_id, pole, cell_row AS r, cell_col AS c, cell_col * 1920e0 + CASE WHEN patch_id % 53 = 0 THEN 4 ELSE 0 END AS x, -cell_row * 1920e0 - CASE WHEN patch_id % 59 = 0 THEN 7 ELSE 0 END AS y FROM pixel WHERE prow = 0 AND pcol = 0)
SELECT pole, 'row' AS axis, r AS at, round(max(y) - min(y), 6) AS spread FROM c GROUP BY pole, r HAVING max(y) - min(y) > 1e-3 UNION ALL SELECT pole, 'col', c, round(max(x) - min(x), 6) FROM c GROUP BY pole, c HAVING max(x) - min(x) > 1e-3""")
def origin_spreads(spark: SparkSession, d: str) -> DataFrame:
    """Rows and columns of the poles' grids whose patches do not share their origin; some patches are moved."""
    p = fx.pixels(spark, d).where("prow = 0 AND pcol = 0")
    cells = p.select("pole", F.col("cell_row").alias("row"), F.col("cell_col").alias("col"), (F.col("cell_col") * 1920.0 + F.when(F.col("patch_id") % 53 == 0, 4).otherwise(0)).alias("x_min"), (-F.col("cell_row") * 1920.0 - F.when(F.col("patch_id") % 59 == 0, 7).otherwise(0)).alias("y_max"))
    return proximity.origin_spread(cells).select("pole", "axis", "at", F.round("spread", 6).alias("spread"))


@query(f"""{fx.with_sql('tile')}, {q.CENTER}, f AS (SELECT 'coordinate-range' AS rule_id, tile_id FROM center WHERE tile_id % 21 = 0 UNION ALL SELECT 'raw-scores', tile_id FROM center WHERE tile_id % 8 = 0)
SELECT 'full' AS scope, rule_id, CAST(tile_id AS VARCHAR) AS object_id FROM f UNION ALL SELECT 'published', rule_id, CAST(tile_id AS VARCHAR) FROM f WHERE rule_id <> 'raw-scores'""")
def rule_scopes(spark: SparkSession, d: str) -> DataFrame:
    """Violations in the scope of a whole build and of a published one, which has no raw data to be compared with."""
    c = written(boxes.with_center(fx.tiles(spark, d)), "centers")
    places = contract.coordinate_rules(c.withColumn("lon", F.when(F.col("tile_id") % 21 == 0, F.col("lon") + 400).otherwise(F.col("lon"))), "tile_id")
    raw = contract.violations(c, "raw-scores", F.col("tile_id") % 8 == 0, "tile_id")
    of = lambda scope: contract.problems(spark, places, raw, scope=scope, raw_rules=("raw-scores",)).select(F.lit(scope).alias("scope"), "rule_id", "object_id")
    return of("full").unionByName(of("published"))
