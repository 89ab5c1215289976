"""Queries over catalogue objects, registries, texts and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions import geo, scoring
from tilewright.operators import boxes, catalogue, contract, proximity, raster, text
from tilewright.plans import sphere_sql as q
from tilewright.plans.rasters import MASKED, PIX, _deep
from tilewright.plans.registry import query
from tilewright.plans.spatial import CONFIDENT, ROUNDED, _confident_located, _published
from tilewright.sources import collections as src, fixtures as fx
from tilewright.sources.scratch import written

MASKS = f"{PIX}, {MASKED}, area AS (SELECT patch_id, count_if(mask AND covered) * 0.25e0 AS area_m2, arbitrary(target) AS target, arbitrary(split) AS split FROM m GROUP BY patch_id)"


def _regions(spark: SparkSession, d: str) -> DataFrame:
    """Segmentation regions: patches with their mask's area, a target of four patches, and the target's place."""
    p = fx.pixels(spark, d)
    area = raster.mask_records(raster.segmented(p), 0.25).select(F.col("patch_id").alias("region_id"), "area_m2")
    r = p.where("prow = 0 AND pcol = 0").select(F.col("patch_id").alias("region_id"), "target", "split").join(area, "region_id")
    moved = F.when(F.col("region_id") % 50 == 0, 1).otherwise(0)
    lat, lon = F.col("target") % 120 - 60 + 0.001 * (F.col("region_id") % 4), F.col("target") * 7 % 360 - 180 + 0.0005 * (F.col("region_id") % 4)
    return r.withColumns({"footprint": F.concat_ws("/", F.col("target"), moved), "lat": lat.cast("double"), "lon": lon.cast("double")})


REGIONS = MASKS + """, reg AS (SELECT patch_id AS region_id, target, split, area_m2, concat_ws('/', target, CASE WHEN patch_id % 50 = 0 THEN 1 ELSE 0 END) AS footprint, target % 120 - 60 + 0.001e0 * (patch_id % 4) AS lat, target * 7 % 360 - 180 + 0.0005e0 * (patch_id % 4) AS lon FROM area),
ok AS (SELECT * FROM reg WHERE target IN (SELECT target FROM reg GROUP BY target HAVING count(DISTINCT footprint) = 1)),
v AS (SELECT target, avg(cos(radians(lat)) * cos(radians(lon))) AS x, avg(cos(radians(lat)) * sin(radians(lon))) AS y, avg(sin(radians(lat))) AS z FROM ok GROUP BY target),
g AS (SELECT target, degrees(atan2(z, sqrt(x * x + y * y))) AS g_lat, degrees(atan2(y, x)) AS g_lon FROM v)"""


@query(REGIONS + f""" SELECT ok.target, round(g_lat, 6) AS g_lat, round(g_lon, 6) AS g_lon, array_to_string(list(region_id ORDER BY area_m2 DESC, region_id), ',') AS observation_ids, count_if(split = 'train') AS train, count_if(split = 'validation') AS validation, count_if(split = 'test') AS test,
round(max({q.distance('g_lat', 'g_lon', 'lat', 'lon')}) + 181.02e0, 1) AS radius_m FROM ok JOIN g ON g.target = ok.target GROUP BY ok.target, g_lat, g_lon""")
def observation_groups(spark: SparkSession, d: str) -> DataFrame:
    g, _ = proximity.observation_groups(_regions(spark, d), 181.02)
    return g.select("target", F.round("g_lat", 6).alias("g_lat"), F.round("g_lon", 6).alias("g_lon"), F.array_join(F.col("observation_ids").cast("array<string>"), ",").alias("observation_ids"), "train", "validation", "test", "radius_m")


@query(REGIONS + " SELECT target, count(DISTINCT footprint) AS footprints FROM reg GROUP BY target HAVING count(DISTINCT footprint) > 1")
def observation_group_violations(spark: SparkSession, d: str) -> DataFrame:
    return proximity.observation_groups(_regions(spark, d), 181.02)[1]


@query(REGIONS + " SELECT footprint, array_to_string(list(region_id ORDER BY region_id), ',') AS ids FROM reg GROUP BY footprint HAVING count(*) > 1")
def shared_footprints(spark: SparkSession, d: str) -> DataFrame:
    return proximity.shared_footprints(_regions(spark, d)).select("footprint", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(REGIONS + f" SELECT a.target AS g, round(max({q.distance('a.lat', 'a.lon', 'b.lat', 'b.lon')}), 3) AS span_m FROM reg a JOIN reg b ON a.target = b.target AND a.region_id < b.region_id GROUP BY a.target")
def group_span(spark: SparkSession, d: str) -> DataFrame:
    return proximity.group_span(_regions(spark, d).select(F.col("target").alias("g"), F.col("region_id").alias("id"), "lat", "lon")).select("g", F.round("span_m", 3).alias("span_m"))


RANK = "ranked AS (SELECT *, CASE WHEN area_m2 > 0 THEN floor(100e0 * (rank() OVER w - 1 + 0.5e0 * count(*) OVER (PARTITION BY area_m2 > 0, area_m2)) / count(*) OVER (PARTITION BY area_m2 > 0) * 10 + 0.5e0) / 10 END AS score FROM reg WINDOW w AS (PARTITION BY area_m2 > 0 ORDER BY area_m2))"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    r = _regions(spark, d).withColumn("positive", F.when(F.col("area_m2") > 0, F.col("area_m2")))
    return scoring.percentile_rank(r, "positive", "score").drop("positive")


@query(REGIONS + f", {RANK} SELECT region_id, area_m2, score FROM ranked")
def area_rank(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("region_id", "area_m2", "score")


@query(REGIONS + f", {RANK} SELECT target, arg_min(region_id, k) AS region_id, round(arg_min(area_m2, k), 6) AS area_m2 FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY area_m2 DESC, region_id) AS k FROM ranked WHERE target IN (SELECT target FROM ok)) WHERE score IS NOT NULL GROUP BY target")
def group_primaries(spark: SparkSession, d: str) -> DataFrame:
    g, _ = proximity.observation_groups(_regions(spark, d), 181.02)
    return catalogue.primaries(g, _scored(spark, d)).select("target", "region_id", F.round("area_m2", 6).alias("area_m2"))


@query(REGIONS + """, cl AS (SELECT a.region_id AS a, b.region_id AS b FROM reg a JOIN reg b ON a.region_id <> b.region_id AND """ + q.distance("a.lat", "a.lon", "b.lat", "b.lon") + """ < 5000), rc(node, other) AS (SELECT a, b FROM cl UNION SELECT r.node, c.b FROM rc r JOIN cl c ON c.a = r.other),
comp AS (SELECT r.*, least(r.region_id, coalesce((SELECT min(other) FROM rc WHERE node = r.region_id), r.region_id)) AS component FROM reg r)
SELECT component, count(*) AS observations, count(DISTINCT footprint) AS footprints, array_to_string(list_sort(list(DISTINCT target)), ',') AS targets, count_if(split = 'test') AS test FROM comp GROUP BY component""")
def imp_sites(spark: SparkSession, d: str) -> DataFrame:
    s = proximity.sites(_regions(spark, d).withColumnRenamed("region_id", "id"))
    return s.select("component", "observations", "footprints", F.array_join(F.col("targets").cast("array<string>"), ",").alias("targets"), F.coalesce(F.try_element_at("splits", F.lit("test")), F.lit(0)).cast("bigint").alias("test"))


# --- curation and registry --------------------------------------------------------------------------------------------

CRATERS = f"{fx.with_sql('tile', 'det', 'ref')}, {q.LOCATED}, {ROUNDED}, {CONFIDENT}, {q.matches()}, pub AS (SELECT c.*, CASE WHEN m.ref IS NULL THEN 0 ELSE 1 END AS matched FROM craters c LEFT JOIN matches m ON m.tile_id = c.tile_id AND m.det = c.idx)"
CATS = """cats AS (SELECT 'large' AS category, 0 AS cat, -diameter_km AS o1, -score AS o2, * FROM pub WHERE truncated = 0 AND score >= 0.9 UNION ALL SELECT 'high-confidence', 1, -score, 0e0, * FROM pub WHERE truncated = 0 AND diameter_km >= 3 AND score >= 0.99
  UNION ALL SELECT 'unmatched-high-confidence', 2, -score, 0e0, * FROM pub WHERE truncated = 0 AND diameter_km >= 3 AND score >= 0.9 AND matched = 0)"""
ORDER = ["o1", "o2", "tile_id", "idx"]
CATEGORIES = ["large", "high-confidence", "unmatched-high-confidence"]


@query(CRATERS + f", {CATS} SELECT category, row_number() OVER (PARTITION BY category ORDER BY o1, o2, tile_id, idx) AS place, tile_id, idx, round(o1, 9) AS o1, round(o2, 9) AS o2 FROM cats")
def crater_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate of each category with its place and the numbers that it is ordered by."""
    c = catalogue.ranked(catalogue.crater_candidates(_published(spark, d)), ORDER)
    return c.select("category", "place", "tile_id", "idx", F.round("o1", 9).alias("o1"), F.round("o2", 9).alias("o2"))


SPREAD_KM, SPREAD_LIMIT = 120, 8


def _picks(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.curated(catalogue.crater_candidates(_published(spark, d)), CATEGORIES, ORDER, SPREAD_KM, SPREAD_LIMIT)


FAR = q.distance("c.lat", "c.lon", "t.lat", "t.lon")
CURATED = CRATERS + f""", {CATS}, line AS (SELECT *, CASE WHEN split = 'test' THEN 0 ELSE 3 END + cat AS stage FROM cats),
pick(n, stage, taken, o1, o2, tile_id, idx) AS (
  SELECT 0, -1, CAST([] AS STRUCT(lat DOUBLE, lon DOUBLE, stage INTEGER)[]), 0e0, 0e0, CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT p.n + 1, x.s, list_append(p.taken, {{'lat': x.lat, 'lon': x.lon, 'stage': x.s}}), x.o1, x.o2, x.tile_id, x.idx FROM pick p, LATERAL (
    SELECT c.stage AS s, c.lat, c.lon, c.o1, c.o2, c.tile_id, c.idx FROM line c
    WHERE c.stage >= p.stage AND len(list_filter(p.taken, lambda t: t.stage = c.stage)) < {SPREAD_LIMIT} AND len(list_filter(p.taken, lambda t: {FAR} < {SPREAD_KM * 1000})) = 0 ORDER BY c.stage, c.o1, c.o2, c.tile_id, c.idx LIMIT 1) x)
"""


@query(CURATED + """ SELECT CAST(stage // 3 AS INT) AS pass, CASE stage % 3 WHEN 0 THEN 'large' WHEN 1 THEN 'high-confidence' ELSE 'unmatched-high-confidence' END AS category,
CAST(row_number() OVER (PARTITION BY stage ORDER BY n) - 1 AS INT) AS pick, tile_id, idx FROM pick WHERE n > 0""")
def curated_spread(spark: SparkSession, d: str) -> DataFrame:
    return _picks(spark, d).select("pass", "category", "pick", "tile_id", "idx")


SHARES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999]


@query(CURATED + f""", v AS (SELECT diameter_km AS x FROM pub WHERE truncated = 0), s AS (SELECT count(*) AS population, quantile_cont(x, {SHARES + [0.99]}) AS p FROM v),
c AS (SELECT b.diameter_km AS x FROM pick k JOIN pub b ON b.tile_id = k.tile_id AND b.idx = k.idx WHERE n > 0), e AS (SELECT count(*) AS curated, min(x) AS lo, max(x) AS hi FROM c)
SELECT population, {', '.join(f"round(p[{i + 1}], 3) AS p{f'{100 * x:g}'.replace('.', '_')}" for i, x in enumerate(SHARES))}, (SELECT count(*) FROM v WHERE x >= p[{len(SHARES) + 1}]) AS at_or_above_p99, curated,
round(100e0 * ((SELECT count(*) FROM v WHERE x < lo) + 0.5e0 * (SELECT count(*) FROM v WHERE x = lo)) / population, 2) AS rank_min, round(100e0 * ((SELECT count(*) FROM v WHERE x < hi) + 0.5e0 * (SELECT count(*) FROM v WHERE x = hi)) / population, 2) AS rank_max,
round(lo, 3) AS diameter_min, round(hi, 3) AS diameter_max FROM s, e""")
def diameter_analysis(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.diameter_analysis(_published(spark, d), _picks(spark, d), SHARES)


_REGION = "concat(CASE WHEN abs(lon) <= 90 THEN 'NEARSIDE' ELSE 'FARSIDE' END, ' · ', CASE WHEN lat >= 0 THEN 'NORTHERN' ELSE 'SOUTHERN' END, ' HEMISPHERE')"
_SENTENCE = """concat('Model detection of a crater-like feature, ', printf('%.2f', diameter_km), ' km across, at confidence ', printf('%.2f', score), '.', CASE WHEN matched = 0 THEN ' No reference annotation overlaps it.' ELSE '' END, CASE WHEN split <> 'test' THEN ' The tile was part of the training or validation data.' ELSE '' END)"""


@query(CURATED + f""" SELECT p.tile_id, p.idx, {_REGION} AS region, {_SENTENCE} AS description, split = 'test' AS featured, concat('confidence=', round(score, 6), ' diameter=', round(diameter_km, 6), 'km referenceMatch=', matched = 1) AS metrics
FROM pick k JOIN pub p ON p.tile_id = k.tile_id AND p.idx = k.idx WHERE n > 0""")
def discovery_records(spark: SparkSession, d: str) -> DataFrame:
    r = catalogue.discoveries(_picks(spark, d))
    text = F.transform("metrics", lambda m: F.concat(m["key"], F.lit("="), F.coalesce(F.round(m["value"], 6).cast("string"), m["value_bool"].cast("string")), F.coalesce(m["unit"], F.lit(""))))
    return r.select("tile_id", "idx", "region", "description", "featured", F.array_join(text, " ").alias("metrics"))


@query(CRATERS + """ SELECT tile_id, idx, concat(CASE WHEN abs(lon) <= 90 THEN 'NEARSIDE' ELSE 'FARSIDE' END, ' · ', CASE WHEN lat >= 0 THEN 'NORTHERN' ELSE 'SOUTHERN' END, ' HEMISPHERE') AS region,
concat('Model detection of a crater-like feature, ', printf('%.2f', diameter_km), ' km across, at confidence ', printf('%.2f', score), '.', CASE WHEN matched = 0 THEN ' No reference annotation overlaps it.' ELSE '' END, CASE WHEN split <> 'test' THEN ' The tile was part of the training or validation data.' ELSE '' END) AS description FROM pub""")
def describe(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.describe(_published(spark, d)).select("tile_id", "idx", "region", "description")


def _keys(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tiles(spark, d)
    kind = F.when(F.col("tile_id") % 3 == 0, "CRATER_CANDIDATE").when(F.col("tile_id") % 3 == 1, "HIGH_PROSPECTIVITY_REGION").otherwise("IMP_CANDIDATE")
    return t.select("tile_id", kind.alias("type"), F.concat(F.lit("k|"), F.lpad(F.col("tile_id").cast("string"), 7, "0")).alias("key"))


KEYS = f"{fx.with_sql('tile')}, keys AS (SELECT tile_id, CASE tile_id % 3 WHEN 0 THEN 'CRATER_CANDIDATE' WHEN 1 THEN 'HIGH_PROSPECTIVITY_REGION' ELSE 'IMP_CANDIDATE' END AS type, CASE tile_id % 3 WHEN 0 THEN 'MM-CR' WHEN 1 THEN 'MM-ICE' ELSE 'MM-IMP' END AS prefix, 'k|' || lpad(CAST(tile_id AS VARCHAR), 7, '0') AS key FROM tile)"


def _registry(spark: SparkSession, d: str) -> DataFrame:
    none = spark.createDataFrame([], "id string, type string, key string, first_catalogued string")
    return catalogue.registry_assign(none, _keys(spark, d).where("tile_id % 4 <> 0"), "2026-01-01")


REG = KEYS + """, old AS (SELECT prefix || '-' || lpad(CAST(row_number() OVER (PARTITION BY prefix ORDER BY key) AS VARCHAR), 6, '0') AS id, type, key, '2026-01-01' AS first_catalogued, prefix, row_number() OVER (PARTITION BY prefix ORDER BY key) AS n FROM keys WHERE tile_id % 4 <> 0),
top AS (SELECT prefix, max(n) AS top FROM old GROUP BY prefix), new AS (SELECT k.prefix || '-' || lpad(CAST(coalesce(t.top, 0) + row_number() OVER (PARTITION BY k.prefix ORDER BY k.key) AS VARCHAR), 6, '0') AS id, k.type, k.key, '2026-02-02' AS first_catalogued FROM keys k LEFT JOIN top t ON t.prefix = k.prefix WHERE k.key NOT IN (SELECT key FROM old))"""


@query(REG + " SELECT id, type, key, first_catalogued FROM old UNION ALL SELECT * FROM new")
def registry_assign(spark: SparkSession, d: str) -> DataFrame:
    return catalogue.registry_assign(_registry(spark, d), _keys(spark, d), "2026-02-02")


ALL_REG = KEYS + """, old AS (SELECT prefix || '-' || lpad(CAST(row_number() OVER (PARTITION BY prefix ORDER BY key) AS VARCHAR), 6, '0') AS id, type, key, prefix FROM keys)"""


def _whole_registry(spark: SparkSession, d: str) -> DataFrame:
    none = spark.createDataFrame([], "id string, type string, key string, first_catalogued string")
    return catalogue.registry_assign(none, _keys(spark, d), "2026-01-01")


@query(ALL_REG + """ SELECT 'registry-append-only' AS rule_id, id AS object_id, key AS message FROM old WHERE key LIKE '%7' UNION ALL SELECT 'registry-id', replace(id, '-', '_'), '' FROM old WHERE key LIKE '%7'
UNION ALL SELECT 'registry-type', replace(id, '-', '_'), type FROM old WHERE key LIKE '%7'""")
def registry_guard(spark: SparkSession, d: str) -> DataFrame:
    """The registry of all tiles against itself with some ids changed."""
    old = _whole_registry(spark, d)
    new = old.withColumn("id", F.when(F.col("key").endswith("7"), F.replace("id", F.lit("-"), F.lit("_"))).otherwise(F.col("id")))
    return catalogue.append_only_violations(old, new).unionByName(catalogue.registry_violations(new))


@query(ALL_REG + """, asked AS (SELECT CASE WHEN key LIKE '%3' THEN 'IMP_CANDIDATE' WHEN key LIKE '%5' THEN 'OTHER' ELSE type END AS type, key, type AS registered FROM keys)
SELECT 'registry-unknown-type' AS rule_id, key AS object_id, type AS message FROM asked WHERE type = 'OTHER' UNION ALL SELECT 'registry-type-conflict', key, registered || '/' || type FROM asked WHERE type <> 'OTHER' AND type <> registered
UNION ALL SELECT 'registry-full', 'n' || key, 'MM-ICE' FROM keys""")
def registry_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests with some types changed, and new keys for a prefix whose last number is given."""
    k = _keys(spark, d)
    changed = F.when(F.col("key").endswith("3"), "IMP_CANDIDATE").when(F.col("key").endswith("5"), "OTHER").otherwise(F.col("type"))
    last = _whole_registry(spark, d).unionByName(spark.createDataFrame([("MM-ICE-999999", "HIGH_PROSPECTIVITY_REGION", "last", "2026-01-01")], "id string, type string, key string, first_catalogued string"))
    asked = k.select(changed.alias("type"), "key").unionByName(k.select(F.lit("HIGH_PROSPECTIVITY_REGION").alias("type"), F.concat(F.lit("n"), "key").alias("key")))
    return catalogue.request_violations(last, asked)


@query(ALL_REG + """, shown AS (SELECT CASE WHEN key LIKE '%1' THEN id || '0' ELSE id END AS id, CASE WHEN key LIKE '%2' THEN 'OTHER' ELSE type END AS type, CASE WHEN key LIKE '%4' THEN key || '!' ELSE key END AS key FROM old)
SELECT 'discovery-unregistered' AS rule_id, id AS object_id, '' AS message FROM shown WHERE key LIKE '%1' UNION ALL SELECT 'discovery-type', id, type FROM shown WHERE type = 'OTHER' UNION ALL SELECT 'discovery-identity', id, key FROM shown WHERE key LIKE '%!'""")
def discovery_identities(spark: SparkSession, d: str) -> DataFrame:
    """Discoveries with some ids, types and keys changed, against the registry."""
    old = _whole_registry(spark, d)
    ends = lambda x: F.col("key").endswith(x)
    shown = old.select(F.when(ends("1"), F.concat("id", F.lit("0"))).otherwise(F.col("id")).alias("id"), F.when(ends("2"), "OTHER").otherwise(F.col("type")).alias("type"), F.when(ends("4"), F.concat("key", F.lit("!"))).otherwise(F.col("key")).alias("key"))
    return contract.identity_rules(shown, old)


@query(f"""{fx.with_sql('det')}, b AS (SELECT tile_id, CAST(round_even(x + w / 2, 0) AS INT) AS cx, CAST(round_even(y + h / 2, 0) AS INT) AS cy, CAST(round_even(w, 0) AS INT) AS bw, CAST(round_even(h, 0) AS INT) AS bh, d1 FROM det WHERE score >= 0.9),
o AS (SELECT DISTINCT tile_id, cx + CASE WHEN d1 % 5 = 0 THEN 1 ELSE 0 END AS cx, cy, bw, bh FROM b),
k AS (SELECT *, concat('crater-detection|set|', tile_id, '|ckpt|box=', concat_ws(',', cx, cy, bw, bh)) AS key FROM o), n AS (SELECT DISTINCT tile_id, cx, cy, bw, bh, concat('crater-detection|set|', tile_id, '|ckpt|box=', concat_ws(',', cx, cy, bw, bh)) AS key FROM b)
SELECT k.key AS id, k.key, min(n.key) AS near FROM k JOIN n ON n.tile_id = k.tile_id AND abs(n.cx - k.cx) <= 2 AND abs(n.cy - k.cy) <= 2 AND abs(n.bw - k.bw) <= 2 AND abs(n.bh - k.bh) <= 2 WHERE k.key NOT IN (SELECT key FROM n) GROUP BY k.key""")
def identity_drift(spark: SparkSession, d: str) -> DataFrame:
    det = fx.detections(spark, d).where("score >= 0.9")
    key = lambda dx: catalogue.crater_key(F.lit("set"), F.col("tile_id"), F.lit("ckpt"), F.rint(F.col("x") + F.col("w") / 2) + dx - F.col("w") / 2, F.col("y"), F.col("w"), F.col("h"))
    old = det.select(key(F.when(F.col("d1") % 5 == 0, 1).otherwise(0)).alias("key")).distinct().withColumn("id", F.col("key"))
    return catalogue.identity_drift(old, det.select(key(F.lit(0)).alias("key")))


_P90 = f"{PIX}, r AS (SELECT patch_id, pole, split, quantile_cont(value, 0.9) AS p90, arbitrary(cell_row) AS cr, arbitrary(cell_col) AS cc FROM pixel WHERE covered GROUP BY ALL)"
_SCORE = "floor(least(greatest(p90, 0e0), 1e0) * 100 * 10 + 0.5e0) / 10 AS score"
DENS = f"""n AS (SELECT c.tile_id, c.split, width * ground_m / 1000 AS side, (SELECT count(*) FROM pub d WHERE d.tile_id = c.tile_id) AS detections FROM center c), dd AS (SELECT *, round(detections / (side * side) * 1000, 3) AS density FROM n),
sc AS (SELECT *, floor(100e0 * (rank() OVER (ORDER BY density) - 1 + 0.5e0 * count(*) OVER (PARTITION BY density)) / count(*) OVER () * 10 + 0.5e0) / 10 AS score FROM dd),
{fx.SQL['pixel']}, {MASKED}, reg AS (SELECT patch_id, arbitrary(split) AS split, count_if(mask AND covered) * 0.25e0 AS area_m2 FROM m GROUP BY patch_id),
rk AS (SELECT *, CASE WHEN area_m2 > 0 THEN floor(100e0 * (rank() OVER w - 1 + 0.5e0 * count(*) OVER (PARTITION BY area_m2 > 0, area_m2)) / count(*) OVER (PARTITION BY area_m2 > 0) * 10 + 0.5e0) / 10 END AS score FROM reg WINDOW w AS (PARTITION BY area_m2 > 0 ORDER BY area_m2)),"""


@query(CRATERS + f""", {q.CENTER}, {DENS} obj AS (SELECT 'crater-detection' AS task, split, detections AS predictions, score FROM sc UNION ALL SELECT 'imp-segmentation', split, 1, score FROM rk)
SELECT coalesce(task, 'all') AS task, coalesce(split, 'all') AS split, count(*) AS objects, CAST(sum(predictions) AS BIGINT) AS predictions, count_if(score >= 80) AS high_interest FROM obj GROUP BY CUBE (task, split)""")
def global_stats(spark: SparkSession, d: str) -> DataFrame:
    c = written(_published(spark, d), "published")
    tiles = boxes.region_records(fx.tiles(spark, d), c, fx.references(spark, d), c.where("matched = 1"))
    objects = tiles.select(F.lit("crater-detection").alias("task"), "split", F.col("detections").alias("predictions"), "score").unionByName(_scored(spark, d).select(F.lit("imp-segmentation").alias("task"), "split", F.lit(1).cast("bigint").alias("predictions"), "score"))
    return catalogue.global_stats(objects).drop("level")


_SOURCES = [("wac", "dataset"), ("detector", "model"), ("layers", "dataset"), ("prospector", "model"), ("nac", "dataset"), ("old", "dataset")]


@query(CRATERS + f""", {q.CENTER}, {DENS} p90 AS (SELECT patch_id, pole, split, quantile_cont(value, 0.9) AS p90 FROM pixel WHERE covered GROUP BY ALL), ice AS (SELECT pole, split, {_SCORE} FROM p90),
obj AS (SELECT 'crater' AS task, split, '' AS pole, detections AS predictions, 0e0 AS area, score FROM sc UNION ALL SELECT 'ice', split, pole, 1, 0, score FROM ice UNION ALL SELECT 'imp', split, '', 1, area_m2, score FROM rk),
disc AS (SELECT 'crater' AS type, split = 'test' AS featured FROM sc WHERE score >= 95 UNION ALL SELECT 'ice', split = 'test' FROM ice WHERE score >= 60 UNION ALL SELECT 'imp', split = 'test' FROM rk WHERE score >= 90),
grp AS (SELECT target FROM pixel WHERE prow = 0 AND pcol = 0 GROUP BY target HAVING count(DISTINCT CASE WHEN patch_id % 50 = 0 THEN 1 ELSE 0 END) = 1)
SELECT count(*) AS regions_analyzed, count_if(task = 'crater') AS crater_regions, CAST(sum(CASE WHEN task = 'crater' THEN predictions ELSE 0 END) AS BIGINT) AS crater_detections, count_if(pole = 'north') AS patches_north, count_if(pole = 'south') AS patches_south,
count_if(task = 'imp') AS imp_tiles, count_if(task = 'imp' AND area > 0) AS imp_candidates, CAST(sum(predictions) AS BIGINT) AS model_predictions, count_if(score >= 80) AS high_interest, count_if(split = 'train') AS split_train, count_if(split = 'validation') AS split_validation,
count_if(split = 'test') AS split_test, count_if(split = 'external') AS split_external, count_if(task = 'ice') AS reference_maps, count_if(task = 'imp') AS reference_masks, (SELECT count(*) FROM disc) AS discoveries, (SELECT count_if(type = 'crater') FROM disc) AS discoveries_crater,
(SELECT count_if(type = 'ice') FROM disc) AS discoveries_ice, (SELECT count_if(type = 'imp') FROM disc) AS discoveries_imp, (SELECT count_if(featured) FROM disc) AS featured, (SELECT count(*) FROM grp) AS imp_groups, (SELECT count(*) FROM ref) AS reference_boxes, CAST(3 AS BIGINT) AS datasets, CAST(1 AS BIGINT) AS models FROM obj""")
def build_stats(spark: SparkSession, d: str) -> DataFrame:
    """What the whole build holds; sectors have a dataset and no model, and one source is not used."""
    c = written(_published(spark, d), "published")
    none = F.lit(None)
    row = lambda df, task, pole, n, area, dataset, model: df.select(F.lit(task).alias("task"), "split", pole.cast("string").alias("pole"), n.cast("long").alias("predictions"), area.cast("double").alias("area_m2"), "score", F.lit(dataset).alias("dataset"), model.cast("string").alias("model"))
    tiles = row(boxes.region_records(fx.tiles(spark, d), c, fx.references(spark, d), c.where("matched = 1")), "crater-detection", none, F.col("detections"), none, "wac", F.lit("detector"))
    s = raster.stats(fx.pixels(spark, d), ("patch_id", "pole", "split")).withColumn("score", scoring.bounded_score(F.col("p90")))
    objects = written(tiles.unionByName(row(s, "ice-prospectivity", F.col("pole"), F.lit(1), none, "layers", none)).unionByName(row(_scored(spark, d), "imp-segmentation", none, F.lit(1), F.col("area_m2"), "nac", none)), "objects")
    kind = F.when(F.col("task") == "crater-detection", "CRATER_CANDIDATE").when(F.col("task") == "ice-prospectivity", "HIGH_PROSPECTIVITY_REGION").otherwise("IMP_CANDIDATE")
    least = F.when(F.col("task") == "crater-detection", 95).when(F.col("task") == "ice-prospectivity", 60).otherwise(90)
    found = objects.where(F.col("score") >= least).select(kind.alias("type"), (F.col("split") == "test").alias("featured"))
    groups, _ = proximity.observation_groups(_regions(spark, d), 100.0)
    return catalogue.build_stats(objects, found, groups, fx.references(spark, d), spark.createDataFrame(_SOURCES, "id string, kind string"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN round(CAST(o_totalprice AS DOUBLE) + 1, 2) ELSE round(CAST(o_totalprice AS DOUBLE), 2) END AS price FROM orders")
def upsert_by_id(spark: SparkSession, d: str) -> DataFrame:
    base = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice").cast("double"), 2).alias("price"))
    return catalogue.upsert(base, base.where("o_orderkey % 5 = 0").withColumn("price", F.round(F.col("price") + 1, 2)), "o_orderkey")


@query("SELECT CAST(o_custkey AS VARCHAR) AS sample, count(*) AS n, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ';') AS splits FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def split_conflicts(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("sample"), F.col("o_orderpriority").alias("split"))
    return src.split_conflicts(rows).select("sample", "n", F.array_join("splits", ";").alias("splits"))


@query("""WITH pins AS (SELECT n_name AS task, r_name AS model, n_name || '-set' AS dataset FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 3),
obj AS (SELECT c_custkey AS object_id, n_name AS task, CASE WHEN c_custkey % 7 = 0 THEN 'other' ELSE r_name END AS model, n_name || CASE WHEN c_custkey % 11 = 0 THEN '-old' ELSE '-set' END AS dataset, CASE WHEN c_custkey % 13 = 0 THEN 'val' ELSE 'test' END AS split FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT 'provenance-task' AS rule_id, CAST(object_id AS VARCHAR) AS object_id, task AS message FROM obj WHERE task NOT IN (SELECT task FROM pins)
UNION ALL SELECT 'provenance-model', CAST(object_id AS VARCHAR), o.model FROM obj o JOIN pins p USING (task) WHERE o.model <> p.model UNION ALL SELECT 'provenance-dataset', CAST(object_id AS VARCHAR), o.dataset FROM obj o JOIN pins p USING (task) WHERE o.dataset <> p.dataset
UNION ALL SELECT 'provenance-split', CAST(object_id AS VARCHAR), split FROM obj WHERE split = 'val'""")
def provenance_check(spark: SparkSession, d: str) -> DataFrame:
    names = fx.table(spark, d, "nation").join(fx.table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select("n_nationkey", "n_name", "r_name")
    pins = names.where("n_nationkey <> 3").select(F.col("n_name").alias("task"), F.col("r_name").alias("model"), F.concat("n_name", F.lit("-set")).alias("dataset"))
    key = F.col("c_custkey")
    objects = fx.table(spark, d, "customer").join(names, F.col("n_nationkey") == F.col("c_nationkey")).select(
        key.alias("object_id"), F.col("n_name").alias("task"), F.when(key % 7 == 0, "other").otherwise(F.col("r_name")).alias("model"), F.concat("n_name", F.when(key % 11 == 0, "-old").otherwise("-set")).alias("dataset"), F.when(key % 13 == 0, "val").otherwise("test").alias("split"))
    return contract.provenance_rules(objects, pins)


@query(CRATERS + f""", shown AS (SELECT tile_id, count(*) + CASE WHEN tile_id % 29 = 0 THEN 1 ELSE 0 END AS detections, CAST(sum(matched) AS BIGINT) AS matched FROM pub GROUP BY tile_id), n AS (SELECT tile_id, count(*) AS n FROM pub GROUP BY tile_id)
SELECT 'crater-count' AS rule_id, CAST(s.tile_id AS VARCHAR) AS object_id, concat_ws('/', n.n, s.detections) AS message FROM shown s JOIN n ON n.tile_id = s.tile_id WHERE n.n <> s.detections
UNION ALL SELECT 'crater-box', CAST(tile_id AS VARCHAR), CAST(idx AS VARCHAR) FROM pub WHERE x < 0 OR y < 0 OR x + w > 490 OR y + h > 490""")
def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    """Some counts are off by one, and tiles count as 490 pixels wide, so that the rules have something to find."""
    c = written(_published(spark, d), "published")  # read by each rule
    shown = c.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("matched").alias("matched")).select("tile_id", (F.col("n") + F.when(F.col("tile_id") % 29 == 0, 1).otherwise(0)).alias("detections"), "matched")
    return contract.problems(spark, contract.crater_rules(shown, c, 490))


_CLAIMS, _DENIALS = ("the mit license", "on the", "der ein"), ("not", " no ", "nicht")


@query(f"""WITH RECURSIVE t AS (SELECT doc_id AS id, lower(text) AS t FROM documents), f(id, phrase, t, position) AS (
  SELECT id, phrase, t, strpos(t, phrase) - 1 FROM t, (VALUES {', '.join(f"('{c}')" for c in _CLAIMS)}) p(phrase) WHERE strpos(t, phrase) > 0
  UNION ALL SELECT id, phrase, t, position + length(phrase) + strpos(substr(t, position + length(phrase) + 1), phrase) - 1 FROM f WHERE strpos(substr(t, position + length(phrase) + 1), phrase) > 0),
b AS (SELECT id, phrase, position, substr(t, greatest(position - 40 + 1, 1), least(40, position)) AS before FROM f)
SELECT id, phrase, position FROM b WHERE NOT ({' OR '.join(f"contains(before, '{n}')" for n in _DENIALS)})""")
def claim_lint(spark: SparkSession, d: str) -> DataFrame:
    return text.claim_hits(fx.table(spark, d, "documents"), _CLAIMS, _DENIALS, id_col="doc_id")


@query("""SELECT e.event_id, CAST(e.user_id AS VARCHAR) AS sample, e.event_type AS task, CASE WHEN e.user_id % 10 < 7 THEN 'train' ELSE 'test' END AS split, round(e.value, 4) AS seconds FROM events e WHERE e.user_id IN (SELECT c_custkey FROM customer)""")
def sample_lineage(spark: SparkSession, d: str) -> DataFrame:
    objects = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    runs = fx.table(spark, d, "events").join(objects, "user_id", "left_semi")
    return runs.select("event_id", F.col("user_id").cast("string").alias("sample"), F.col("event_type").alias("task"), F.when(F.col("user_id") % 10 < 7, "train").otherwise("test").alias("split"), F.round("value", 4).alias("seconds"))


@query(f"""{PIX}, obj AS (SELECT 'ice-' || CASE pole WHEN 'north' THEN 'n' ELSE 's' END || '-' || lpad(CAST(cell_row AS VARCHAR), 4, '0') || '-' || lpad(CAST(cell_col AS VARCHAR), 4, '0') AS id FROM pixel WHERE prow = 0 AND pcol = 0 AND patch_id % 9 <> 0) SELECT id, count(*) AS n FROM obj GROUP BY id""")
def sector_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids from patch names; names of no known form are left out."""
    p = fx.pixels(spark, d).where("prow = 0 AND pcol = 0")
    cell = lambda c: F.lpad(F.col(c).cast("string"), 4, "0")
    name = F.concat(F.lit("patch_"), cell("cell_row"), F.lit("_"), cell("cell_col"), F.when(F.col("patch_id") % 9 == 0, "_odd").when(F.col("pole") == "south", "_S_80S").otherwise("_80N"))
    return p.select(text.sector_id(name).alias("id")).where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"))


@query("""WITH o AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'mock-' ELSE '' END || 'wac-a1-r' || c_custkey || '-c' || CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '7' END AS id FROM customer) SELECT k, id, k % 4 = 0 OR k % 6 = 0 AS synthetic, NOT regexp_full_match(id, 'wac-[a-z0-9]+-r\\d+-c\\d+') AS malformed FROM o""")
def id_conformance(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    o = fx.table(spark, d, "customer").select(k.alias("k"), F.concat(F.when(k % 4 == 0, "mock-").otherwise(""), F.lit("wac-a1-r"), k.cast("string"), F.lit("-c"), F.when(k % 5 == 0, "x").otherwise("7")).alias("id"), F.when(k % 6 == 0, "mock_tile").otherwise("tile").alias("tile"))
    bad = text.id_violations(o.withColumn("task", F.lit("crater-detection"))).select("k", F.lit(True).alias("malformed"))
    return o.join(bad, "k", "left").select("k", "id", text.is_synthetic(F.col("id"), F.col("tile"), F.lit("1"), F.lit("r")).alias("synthetic"), F.coalesce("malformed", F.lit(False)).alias("malformed"))


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem), b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 101 = 0 THEN -1 ELSE l_partkey END AS l_partkey FROM lineitem)
SELECT 'rows' AS rule_id, CAST(l_orderkey AS VARCHAR) AS object_id, 'only in the first' AS message FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'rows', CAST(l_orderkey AS VARCHAR), 'only in the second' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def same_rows(spark: SparkSession, d: str) -> DataFrame:
    a = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return contract.same_rows(a, a.withColumn("l_partkey", F.when(F.col("l_orderkey") % 101 == 0, F.lit(-1)).otherwise(F.col("l_partkey"))), "rows", "l_orderkey")


@query("SELECT (SELECT count(*) FROM part) AS tiles, (SELECT count(*) FROM lineitem) AS detections, (SELECT count(*) FROM embeddings) AS patches, (SELECT count(*) FROM documents) AS texts")
def build_summary(spark: SparkSession, d: str) -> DataFrame:
    return contract.build_summary(tiles=fx.tiles(spark, d), detections=fx.table(spark, d, "lineitem"), patches=fx.table(spark, d, "embeddings"), texts=fx.table(spark, d, "documents"))


def _sectors(spark: SparkSession, d: str) -> DataFrame:
    p = fx.pixels(spark, d)
    s = raster.stats(p, ("patch_id", "pole", "split", "cell_row", "cell_col"))
    lat = F.when(F.col("pole") == "south", -1).otherwise(1) * (80 + 0.5 * F.col("cell_row"))
    safe = raster.anchors(p, 1).where("value IS NOT NULL").select("patch_id")
    return s.join(safe, "patch_id", "left_semi").select(F.col("patch_id").alias("region_id"), "pole", "split", "p90", scoring.bounded_score(F.col("p90")).alias("score"), lat.alias("lat"), (20.0 * F.col("cell_col") - 180).alias("lon"))


@query(f"{_P90} SELECT patch_id AS region_id, pole, round(p90, 6) AS p90, {_SCORE} FROM r")
def bounded_scores(spark: SparkSession, d: str) -> DataFrame:
    s = raster.stats(fx.pixels(spark, d), ("patch_id", "pole"))
    return s.select(F.col("patch_id").alias("region_id"), "pole", F.round("p90", 6).alias("p90"), scoring.bounded_score(F.col("p90")).alias("score"))


@query(f"""{_P90}, s AS (SELECT patch_id AS region_id, pole, split, CASE WHEN pole = 'south' THEN -1 ELSE 1 END * (80 + 0.5e0 * cr) AS lat, 20e0 * cc - 180 AS lon, {_SCORE} FROM r), {_deep(1)},
line AS (SELECT *, -score AS o1, CASE WHEN split = 'test' THEN 0 ELSE 2 END + CASE pole WHEN 'south' THEN 0 ELSE 1 END AS stage FROM s WHERE region_id IN (SELECT patch_id FROM deep WHERE deep AND covered)),
pick(n, stage, taken, region_id, score) AS (
  SELECT 0, -1, CAST([] AS STRUCT(lat DOUBLE, lon DOUBLE, stage INTEGER)[]), CAST(0 AS BIGINT), 0e0
  UNION ALL
  SELECT p.n + 1, x.s, list_append(p.taken, {{'lat': x.lat, 'lon': x.lon, 'stage': x.s}}), x.region_id, x.score FROM pick p, LATERAL (
    SELECT c.stage AS s, c.lat, c.lon, c.o1, c.region_id, c.score FROM line c
    WHERE c.stage >= p.stage AND len(list_filter(p.taken, lambda t: t.stage = c.stage)) < 8 AND len(list_filter(p.taken, lambda t: {FAR} < 100000)) = 0 ORDER BY c.stage, c.o1, c.region_id LIMIT 1) x)
SELECT CAST(stage // 2 AS INT) AS pass, CASE stage % 2 WHEN 0 THEN 'south' ELSE 'north' END AS category, CAST(row_number() OVER (PARTITION BY stage ORDER BY n) - 1 AS INT) AS pick, region_id, score FROM pick WHERE n > 0""")
def polar_picks(spark: SparkSession, d: str) -> DataFrame:
    c = catalogue.polar_candidates(_sectors(spark, d))
    return catalogue.curated(c, ["south", "north"], ["o1", "region_id"], 100, 8).select("pass", "category", "pick", "region_id", "score")


@query("""WITH r AS (SELECT event_type AS task, user_id % 50 AS sample, count(*) AS size, count(CASE WHEN value IS NULL THEN 1 END) AS non_finite, stddev_pop(value) AS std FROM events GROUP BY ALL)
SELECT 'run-constant' AS rule_id, task || '/' || sample AS object_id, '' AS message FROM r WHERE std IS NULL OR std <= 0 UNION ALL SELECT 'run-finite', task || '/' || sample, '' FROM r WHERE non_finite > 0 UNION ALL SELECT 'run-checkpoint', task || '/' || sample, '' FROM r WHERE sample % 10 = 3""")
def run_checks(spark: SparkSession, d: str) -> DataFrame:
    runs = fx.table(spark, d, "events").select(F.col("event_type").alias("task"), (F.col("user_id") % 50).alias("sample"), F.col("value").cast("double").alias("value"))
    r = raster.array_profile(runs, ("task", "sample"), "value").withColumn("run_id", F.concat_ws("/", "task", "sample"))
    r = r.withColumns({"missing_keys": F.lit(0), "unexpected_keys": F.lit(0), "sha256": F.when(F.col("sample") % 10 == 3, "x").otherwise("y"), "pinned_sha256": F.lit("y")})
    return contract.run_rules(r)
