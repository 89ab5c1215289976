"""Queries over tiles, boxes and points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions import geo, scoring, selection
from tilewright.operators import boxes, proximity
from tilewright.plans import sphere_sql as q
from tilewright.plans.registry import query
from tilewright.sources import fixtures as fx


def _confident_located(spark: SparkSession, d: str) -> DataFrame:
    return boxes.located(fx.tiles(spark, d), boxes.confident(fx.detections(spark, d)))


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return boxes.greedy_matches(boxes.iou_pairs(boxes.confident(fx.detections(spark, d)), fx.references(spark, d)))


CONFIDENT = q.PAIRS.format(where="WHERE d.score >= 0.5")
DENSITY = f"""{fx.with_sql('tile', 'det', 'ref')}, {q.CENTER}, {CONFIDENT}, {q.matches()},
n AS (SELECT c.tile_id, c.split, c.lat, c.lon, width * ground_m / 1000 AS side, (SELECT count(*) FROM det d WHERE d.tile_id = c.tile_id AND d.score >= 0.5) AS detections, (SELECT count(*) FROM ref r WHERE r.tile_id = c.tile_id) AS refs,
  (SELECT count(*) FROM matches m WHERE m.tile_id = c.tile_id) AS matched FROM center c),
d AS (SELECT *, round(detections / (side * side) * 1000, 3) AS density FROM n),
s AS (SELECT *, floor(100e0 * (rank() OVER (ORDER BY density) - 1 + 0.5e0 * count(*) OVER (PARTITION BY density)) / count(*) OVER () * 10 + 0.5e0) / 10 AS score FROM d)"""


@query(DENSITY + "SELECT tile_id, split, detections, refs AS reference_count, matched, round(side, 3) AS size_km, density, score FROM s")
def tile_density_rank(spark: SparkSession, d: str) -> DataFrame:
    rows = boxes.region_records(fx.tiles(spark, d), boxes.confident(fx.detections(spark, d)), fx.references(spark, d), _matches(spark, d))
    return rows.select("tile_id", "split", "detections", F.col("references").alias("reference_count"), "matched", "size_km", "density", "score")


@query(f"{fx.with_sql('tile', 'det')}, {q.LOCATED} SELECT tile_id, d1, d2, d3, round(lat, 6) AS lat, CASE WHEN round(lon, 6) >= 180 THEN round(lon, 6) - 360 ELSE round(lon, 6) END AS lon, round(diameter_km, 3) AS diameter_km, truncated FROM located")
def georeference_detections(spark: SparkSession, d: str) -> DataFrame:
    return _confident_located(spark, d).select("tile_id", "d1", "d2", "d3", geo.published(F.col("lat")).alias("lat"), geo.published_longitude(F.col("lon")).alias("lon"), F.round("diameter_km", 3).alias("diameter_km"), "truncated")


@query(f"{fx.with_sql('det', 'ref')}, {CONFIDENT} SELECT tile_id, det, ref, round(iou, 9) AS iou FROM pairs")
def box_iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    return boxes.iou_pairs(boxes.confident(fx.detections(spark, d)), fx.references(spark, d)).select("tile_id", "det", "ref", F.round("iou", 9).alias("iou"))


@query(f"{fx.with_sql('det', 'ref')}, {CONFIDENT}, {q.matches()} SELECT tile_id, det, ref, round(iou, 9) AS iou FROM matches")
def greedy_match(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("tile_id", "det", "ref", F.round("iou", 9).alias("iou"))


@query(f"""{fx.with_sql('det', 'ref')}, {CONFIDENT}, {q.matches()}
SELECT t.tile_id, (SELECT count(*) FROM det d WHERE d.tile_id = t.tile_id AND score >= 0.5) AS predictions, (SELECT count(*) FROM ref r WHERE r.tile_id = t.tile_id) AS reference_boxes,
  (SELECT count(*) FROM matches m WHERE m.tile_id = t.tile_id) AS matched, (SELECT coalesce(round(sum(round(iou, 4)), 4), 0) FROM matches m WHERE m.tile_id = t.tile_id) AS iou_sum
FROM (SELECT tile_id FROM det WHERE score >= 0.5 UNION SELECT tile_id FROM ref) t""")
def tile_details(spark: SparkSession, d: str) -> DataFrame:
    rows = boxes.tile_details(boxes.confident(fx.detections(spark, d)), fx.references(spark, d), _matches(spark, d))
    n = lambda c: F.coalesce(F.array_size(c), F.lit(0))
    total = F.coalesce(F.aggregate("matches", F.lit(0.0), lambda a, m: a + m["iou"]), F.lit(0.0))
    return rows.select("tile_id", n("prediction").alias("predictions"), n("reference").alias("reference_boxes"), n("matches").alias("matched"), F.round(total, 4).alias("iou_sum"))


_P = [("c", "x_min + width / 2 * px", "y_max - width / 2 * px"), ("ul", "x_min", "y_max"), ("lr", "x_min + width * px", "y_max - width * px")]
_META = " UNION ALL ".join(f"SELECT tile_id, {x} AS x, {y} AS y, round({q.inverse(x, y)[0]}, 9) AS mlat, round({q.inverse(x, y)[1]}, 9) AS mlon FROM tile" for _, x, y in _P)
_CAND = """cand AS (SELECT 'tm' AS kind, 0e0 AS lat0, -176e0 + 8 * z AS lon0, 0.999e0 AS k0, 250000e0 AS fe, fn, concat_ws('/', 'tm', 0, CAST(-176 + 8 * z AS INT), CAST(fn AS INT)) AS candidate FROM (SELECT unnest(range(45)) AS z), (VALUES (0e0), (2500000e0)) f(fn)
  UNION ALL SELECT 'ps', lat0, 0e0, 0.994e0, 500000e0, 500000e0, concat_ws('/', 'ps', CAST(lat0 AS INT), 0, 500000) FROM (VALUES (-90e0), (90e0)) c(lat0))"""


@query(f"""{fx.with_sql('tile')}, meta AS ({_META}), {_CAND},
off AS (SELECT tile_id, candidate, max(greatest(abs(lat - mlat), least(abs(lon - mlon), 360 - abs(lon - mlon)))) AS o FROM (SELECT *, {q.inverse('x', 'y')[0]} AS lat, {q.inverse('x', 'y')[1]} AS lon FROM meta, cand) GROUP BY tile_id, candidate)
SELECT tile_id, CASE WHEN count_if(o <= 1e-6) = 1 THEN arg_min(candidate, o) END AS candidate, count_if(o <= 1e-6) AS fits FROM off GROUP BY tile_id""")
def projection_recovery(spark: SparkSession, d: str) -> DataFrame:
    tiles, p = fx.tiles(spark, d), geo.Projection()
    spots = F.explode(F.array(*[F.struct(F.expr(x).alias("x"), F.expr(y).alias("y")) for _, x, y in _P])).alias("s")
    meta = tiles.select("*", spots).select("*", "s.x", "s.y")
    lat, lon = geo.inverse(p, F.col("x"), F.col("y"))
    meta = meta.select("tile_id", "x", "y", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))
    return proximity.recovered_projection(meta, proximity.projection_candidates(spark))


_FX, _FY = "x_min + j * (width / 1) * px", "y_max - i * (width / 1) * px"


@query(f"""{fx.with_sql('tile')} SELECT tile_id, i, j, round({q.inverse(_FX, _FY)[0]}, 6) AS lat, CASE WHEN round({q.inverse(_FX, _FY)[1]}, 6) >= 180 THEN round({q.inverse(_FX, _FY)[1]}, 6) - 360 ELSE round({q.inverse(_FX, _FY)[1]}, 6) END AS lon
FROM tile, (SELECT unnest(range(2)) AS i), (SELECT unnest(range(2)) AS j)""")
def footprint_corners(spark: SparkSession, d: str) -> DataFrame:
    return proximity.footprint(fx.tiles(spark, d), 2).select("tile_id", "i", "j", geo.published(F.col("lat")).alias("lat"), geo.published_longitude(F.col("lon")).alias("lon"))


REACH = "degrees(0.75e0 * width * px / 1737400e0)"


@query(f"""{fx.with_sql('tile')}, {q.CENTER}, pt AS (SELECT tile_id AS point_id, lat AS p_lat, lon AS p_lon FROM center),
m AS (SELECT point_id, tile_id, ({q.forward('p_lat', 'p_lon')[0]} - x_min) / px AS c, (y_max - {q.forward('p_lat', 'p_lon')[1]}) / px AS r FROM pt JOIN center c ON abs(p_lat - lat) <= 1.5 AND {q.distance('p_lat', 'p_lon', 'lat', 'lon')} <= 0.75e0 * width * px * 1.0000001)
SELECT point_id, tile_id FROM m WHERE round(c, 6) BETWEEN 0 AND 512 AND round(r, 6) BETWEEN 0 AND 512""")
def points_in_tiles(spark: SparkSession, d: str) -> DataFrame:
    tiles = boxes.with_center(fx.tiles(spark, d)).withColumn("reach_deg", F.expr(REACH))
    return proximity.points_in_tiles(tiles.select(F.col("tile_id").alias("point_id"), "lat", "lon"), tiles)


def _published(spark: SparkSession, d: str) -> DataFrame:
    """Craters as published: rounded coordinates and diameters, with their match."""
    hit = _matches(spark, d).select("tile_id", F.col("det").alias("idx"), F.lit(1).alias("matched"))
    rows = _confident_located(spark, d).withColumns({"lat": geo.published(F.col("lat")), "lon": geo.published_longitude(F.col("lon")), "diameter_km": F.round("diameter_km", 3)})
    return rows.join(hit, ["tile_id", "idx"], "left").fillna(0, ["matched"])


ROUNDED = "craters AS (SELECT * REPLACE (round(lat, 6) AS lat, CASE WHEN round(lon, 6) >= 180 THEN round(lon, 6) - 360 ELSE round(lon, 6) END AS lon, round(diameter_km, 3) AS diameter_km) FROM located)"


@query(f"""{fx.with_sql('tile', 'det')}, {q.LOCATED}, {ROUNDED}, a AS (SELECT tile_id, idx, lat, lon, diameter_km, CAST(floor(lat / 0.25) AS INT) AS i, CAST(floor(lon / 0.25) AS INT) AS j FROM craters),
near AS (SELECT a.* REPLACE (i + di AS i, j + dj AS j) FROM a, (SELECT unnest([-1, 0, 1]) AS di), (SELECT unnest([-1, 0, 1]) AS dj))
SELECT tile_id, count(DISTINCT idx) AS repeated FROM (SELECT n.tile_id, n.idx FROM near n JOIN a b ON n.i = b.i AND n.j = b.j AND n.tile_id <> b.tile_id WHERE abs(n.diameter_km - b.diameter_km) <= 0.25 * greatest(n.diameter_km, b.diameter_km)
  AND {q.distance('n.lat', 'n.lon', 'b.lat', 'b.lon')} <= greatest(1000e0, 250 * n.diameter_km)) GROUP BY tile_id""")
def cross_tile_repeats(spark: SparkSession, d: str) -> DataFrame:
    rows = _confident_located(spark, d).withColumns({"lat": geo.published(F.col("lat")), "lon": geo.published_longitude(F.col("lon")), "diameter_km": F.round("diameter_km", 3)})
    return boxes.repeats(rows).groupBy("tile_id").agg(F.count("*").alias("repeated"))


@query(f"""{fx.with_sql('tile', 'det')}, {q.LOCATED}, {ROUNDED}, a AS (SELECT tile_id, idx, lat, lon, diameter_km * CASE WHEN tile_id % 5 = 0 THEN 12 ELSE 1 END AS d FROM craters)
SELECT a.tile_id, count(*) AS repeated FROM a WHERE EXISTS (SELECT 1 FROM a b WHERE b.tile_id <> a.tile_id AND b.lat BETWEEN a.lat - 1 AND a.lat + 1 AND b.d BETWEEN 0.7 * a.d AND 1.5 * a.d AND abs(a.d - b.d) <= 0.25 * greatest(a.d, b.d)
  AND {q.distance('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= greatest(1000e0, 250 * a.d)) GROUP BY a.tile_id""")
def repeats_by_reach(spark: SparkSession, d: str) -> DataFrame:
    """Repeats among all craters, those of every fifth tile twelve times as large: up to some 60 km."""
    rows = _confident_located(spark, d).withColumns({"lat": geo.published(F.col("lat")), "lon": geo.published_longitude(F.col("lon"))})
    rows = rows.withColumn("diameter_km", F.round("diameter_km", 3) * F.when(F.col("tile_id") % 5 == 0, 12).otherwise(1))
    return boxes.repeats_by_reach(rows).groupBy("tile_id").agg(F.count("*").alias("repeated"))


@query(f"""{fx.with_sql('tile', 'det', 'ref')}, {q.PAIRS.format(where='')}, {q.matches(boxes.THRESHOLDS)},
per AS (SELECT t.split, l.thr, d.score, m.ref FROM det d JOIN tile t ON t.tile_id = d.tile_id CROSS JOIN (SELECT unnest({list(boxes.THRESHOLDS)}) AS thr) l LEFT JOIN matches m ON m.tile_id = d.tile_id AND m.thr = l.thr AND m.det = d.idx),
steps AS (SELECT split, thr, score, count(ref) AS tp, count(*) AS n FROM per GROUP BY ALL), total AS (SELECT split, count(*) AS total FROM ref JOIN tile USING (tile_id) GROUP BY split),
curve AS (SELECT split, thr, sum(tp) OVER w / total AS recall, sum(tp) OVER w / sum(n) OVER w AS precision FROM steps JOIN total USING (split) WINDOW w AS (PARTITION BY split, thr ORDER BY score DESC)),
grid AS (SELECT split, thr, r FROM total, (SELECT unnest({list(boxes.THRESHOLDS)}) AS thr), (SELECT unnest(range(101)) AS r))
SELECT split, thr AS threshold, round(avg(p), 6) AS ap FROM (SELECT g.split, g.thr, g.r, coalesce(max(c.precision), 0) AS p FROM grid g LEFT JOIN curve c ON c.split = g.split AND c.thr = g.thr AND floor(c.recall * 100 + 1e-9) >= g.r GROUP BY ALL) GROUP BY split, thr""")
def detection_map(spark: SparkSession, d: str) -> DataFrame:
    split = fx.tiles(spark, d).select("tile_id", "split")
    ap = boxes.average_precision(fx.detections(spark, d).join(split, "tile_id"), fx.references(spark, d).join(split, "tile_id"))
    return ap.select("split", "threshold", F.round("ap", 6).alias("ap"))


_EDGES = [round(0.5 + 0.05 * i, 2) for i in range(11)]


@query(f"""{fx.with_sql('det')}, b AS (SELECT * FROM (VALUES {', '.join(f"({i}, {a}e0, {b}e0)" for i, (a, b) in enumerate(zip(_EDGES[:-1], _EDGES[1:], strict=True)))}) v(bin, low, high))
SELECT bin, low, high, (SELECT count(*) FROM det WHERE score >= low AND (score < high OR (bin = 9 AND score <= high))) AS n FROM b""")
def confidence_histogram(spark: SparkSession, d: str) -> DataFrame:
    return scoring.histogram(fx.detections(spark, d), "score", _EDGES)


@query(f"""{fx.with_sql('tile', 'det')}, {q.LOCATED}, {ROUNDED}, v AS (SELECT diameter_km AS x FROM craters WHERE truncated = 0), s AS (SELECT count(*) AS population, quantile_cont(x, [0.5, 0.9, 0.99, 0.999]) AS p FROM v)
SELECT population, round(p[1], 3) AS p50, round(p[2], 3) AS p90, round(p[3], 3) AS p99, round(p[4], 3) AS p999, (SELECT count(*) FROM v WHERE x >= round(p[3], 3)) AS at_or_above_p99 FROM s""")
def diameter_quantiles(spark: SparkSession, d: str) -> DataFrame:
    v = _confident_located(spark, d).where("truncated = 0").select(F.round("diameter_km", 3).alias("x"))
    n, p = selection.quantiles(v, "x", [0.5, 0.9, 0.99, 0.999])
    p = [None if x is None else round(x, 3) for x in p]
    found = v.agg(F.count("x").alias("population"), F.count_if(F.col("x") >= F.lit(p[2])).alias("at_or_above_p99"))
    return found.select("population", *(F.lit(x).cast("double").alias(c) for c, x in zip(("p50", "p90", "p99", "p999"), p, strict=True)), "at_or_above_p99")


@query(f"""{fx.with_sql('tile')}, {q.CENTER} SELECT coalesce(split, 'all') AS split, count(*) AS tiles, round(min(lat), 2) AS lat_min, round(max(lat), 2) AS lat_max, round(min(lon), 2) AS lon_min, round(max(lon), 2) AS lon_max, count_if(lat >= 0) AS north, count_if(lat < 0) AS south,
count_if(abs(lon) <= 90) AS nearside, count_if(abs(lon) > 90) AS farside, count_if(kind = 'ps') AS ps, count_if(kind = 'tm') AS tm FROM center GROUP BY ROLLUP (split)""")
def split_rollup(spark: SparkSession, d: str) -> DataFrame:
    return proximity.split_stats(boxes.with_center(fx.tiles(spark, d)), "ps", "tm")


@query(f"""{fx.with_sql('tile')}, {q.CENTER}, b AS (SELECT split, 'lat' AS axis, CAST(floor(lat / 15) * 15 AS INT) AS band FROM center UNION ALL SELECT split, 'lon', CAST(floor(lon / 30) * 30 AS INT) FROM center)
SELECT split, axis, band, count(*) AS n FROM (SELECT * FROM b UNION ALL SELECT 'all', axis, band FROM b) GROUP BY ALL""")
def split_bands(spark: SparkSession, d: str) -> DataFrame:
    return proximity.bands(boxes.with_center(fx.tiles(spark, d)))


_CX, _CY = "x_min + j * (width / 11e0) * px", "y_max - i * (width / 11e0) * px"


@query(f"""{fx.with_sql('tile')}, pts AS (SELECT split, round({q.inverse(_CX, _CY)[0]}, 9) AS lat, round({q.inverse(_CX, _CY)[1]}, 9) AS lon FROM tile, (SELECT unnest(range(12)) AS i), (SELECT unnest(range(12)) AS j)),
cells AS (SELECT DISTINCT split, CAST(least(floor((lat + 90) / 0.5e0), 359) AS INT) AS ci, CAST(least(floor((lon + 180) / 0.5e0), 719) AS INT) AS cj FROM pts),
named AS (SELECT split, ci, cj FROM cells UNION ALL SELECT DISTINCT 'union', ci, cj FROM cells UNION ALL SELECT DISTINCT 'added', ci, cj FROM cells c WHERE NOT EXISTS (SELECT 1 FROM cells t WHERE t.split = 'test' AND t.ci = c.ci AND t.cj = c.cj)),
area AS (SELECT split, pow(1737.4e0, 2) * radians(0.5e0) * (sin(radians(-90e0 + ci * 0.5e0) + radians(0.5e0)) - sin(radians(-90e0 + ci * 0.5e0))) AS a FROM named)
SELECT split, count(*) AS cells, round(sum(a), 3) AS km2, round(sum(a) / (4 * pi() * pow(1737.4e0, 2)), 8) AS fraction FROM area GROUP BY split""")
def coverage_cells(spark: SparkSession, d: str) -> DataFrame:
    return proximity.covered_area(proximity.coverage_cells(fx.tiles(spark, d))).select("split", "cells", F.round("km2", 3).alias("km2"), F.round("fraction", 8).alias("fraction"))


_CLOSE = f"close AS (SELECT a.tile_id AS a, b.tile_id AS b, {q.distance('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS m FROM center a JOIN center b ON a.tile_id < b.tile_id AND abs(a.lat - b.lat) <= 1.0 WHERE {q.distance('a.lat', 'a.lon', 'b.lat', 'b.lon')} < 25600)"
_REACH = "sym AS (SELECT a, b FROM close UNION SELECT b, a FROM close), reach(node, other) AS (SELECT a, b FROM sym UNION SELECT r.node, e.b FROM reach r JOIN sym e ON e.a = r.other), low AS (SELECT node, min(other) AS low FROM reach GROUP BY node), comp AS (SELECT c.tile_id AS id, c.split, least(c.tile_id, coalesce(l.low, c.tile_id)) AS component FROM center c LEFT JOIN low l ON l.node = c.tile_id)"


def _points(spark: SparkSession, d: str) -> DataFrame:
    return boxes.with_center(fx.tiles(spark, d)).select(F.col("tile_id").alias("id"), "lat", "lon", "split")


@query(f"{fx.with_sql('tile')}, {q.CENTER}, {_CLOSE} SELECT a, b, round(m, 3) AS m FROM close")
def close_pairs(spark: SparkSession, d: str) -> DataFrame:
    return proximity.close_pairs(_points(spark, d), 25.6).select("a", "b", F.round("m", 3).alias("m"))


@query(f"{fx.with_sql('tile')}, {q.CENTER}, {_CLOSE}, {_REACH} SELECT id, component FROM comp")
def components(spark: SparkSession, d: str) -> DataFrame:
    return proximity.point_groups(_points(spark, d), 25.6)


@query(f"""{fx.with_sql('tile')}, {q.CENTER}, {_CLOSE}, {_REACH}, per AS (SELECT component, count(*) AS n, max(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS tr, max(CASE WHEN split = 'validation' THEN 1 ELSE 0 END) AS va, max(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS te FROM comp GROUP BY component)
SELECT count(*) AS components, count_if(n > 1) AS with_repeats, max(n) AS largest, CAST(sum(tr) AS BIGINT) AS train, CAST(sum(va) AS BIGINT) AS validation, CAST(sum(te) AS BIGINT) AS test, count_if(te = 0) AS without_test FROM per""")
def component_stats(spark: SparkSession, d: str) -> DataFrame:
    p = _points(spark, d)
    return proximity.group_stats(proximity.point_groups(p, 25.6), p.select("id", "split"))


@query(f"""{fx.with_sql('tile', 'det', 'ref')}, {CONFIDENT}, {q.matches()}, {q.LOCATED} SELECT (SELECT count(*) FROM det) AS raw, count(*) AS confident, (SELECT count(*) FROM ref) AS reference_boxes, (SELECT count(*) FROM matches) AS matched,
count(*) - (SELECT count(*) FROM matches) AS unmatched, CAST(sum(truncated) AS BIGINT) AS truncated FROM located""")
def detection_totals(spark: SparkSession, d: str) -> DataFrame:
    one = lambda df, name: df.agg(F.count("*").alias(name))
    main = _confident_located(spark, d).agg(F.count("*").alias("confident"), F.sum("truncated").alias("truncated"))
    for df, name in ((fx.detections(spark, d), "raw"), (fx.references(spark, d), "reference_boxes"), (_matches(spark, d), "matched")):
        main = main.crossJoin(one(df, name))
    return main.select("raw", "confident", "reference_boxes", "matched", (F.col("confident") - F.col("matched")).alias("unmatched"), "truncated")


@query(f"""{fx.with_sql('tile', 'det')}, {q.LOCATED}, {ROUNDED} SELECT l.tile_id, round(max({q.distance('l.lat', 'l.lon', 'c.lat', 'c.lon')}), 3) AS max_m FROM located l JOIN craters c ON c.tile_id = l.tile_id AND c.idx = l.idx GROUP BY l.tile_id""")
def coordinate_residual(spark: SparkSession, d: str) -> DataFrame:
    rows = _confident_located(spark, d).withColumns({"lat": geo.published(F.col("lat")), "lon": geo.published_longitude(F.col("lon"))})
    return boxes.coordinate_residual(fx.tiles(spark, d), boxes.confident(fx.detections(spark, d)), rows).select("tile_id", F.round("max_m", 3).alias("max_m"))


@query(f"""{fx.with_sql('tile')}, {q.CENTER} SELECT tile_id, round(((degrees(atan2(sin(radians(30 - lon)) * cos(radians(1.5e0)), cos(radians(lat)) * sin(radians(1.5e0)) - sin(radians(lat)) * cos(radians(1.5e0)) * cos(radians(30 - lon)))) % 360) + 360) % 360, 6) AS azimuth FROM center""")
def sun_bearing(spark: SparkSession, d: str) -> DataFrame:
    tiles = boxes.with_center(fx.tiles(spark, d))
    return tiles.select("tile_id", F.round(geo.bearing(F.col("lat"), F.col("lon"), F.lit(1.5), F.lit(30.0)), 6).alias("azimuth"))


_U = "CAST(('0x' || substr(md5(concat_ws('|', tile_id, k, 7, {})), 1, 8)) AS BIGINT) / 4294967296e0"


@query(f"""{fx.with_sql('tile')}, pt AS (SELECT *, x_min + {_U.format(1)} * width * px AS x, y_max - {_U.format(2)} * width * px AS y FROM tile, (SELECT unnest(range(1, 21)) AS k)),
g AS (SELECT *, {q.inverse('x', 'y')[0]} AS lat, {q.inverse('x', 'y')[1]} AS lon FROM pt), b AS (SELECT *, sqrt(pow({q.forward('lat', 'lon')[0]} - x, 2) + pow({q.forward('lat', 'lon')[1]} - y, 2)) AS off FROM g)
SELECT tile_id, max(off) < 1e-3 AS exact, round(sum(lat), 5) AS lat_sum FROM b GROUP BY tile_id""")
def grid_round_trip(spark: SparkSession, d: str) -> DataFrame:
    e = proximity.round_trip_error(fx.tiles(spark, d), 20, 7)
    return e.select("tile_id", (F.col("max_error_m") < 1e-3).alias("exact"), F.round("lat_sum", 5).alias("lat_sum"))
