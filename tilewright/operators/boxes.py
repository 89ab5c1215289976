"""Detections and reference boxes of tiles: overlap, matching, geolocation, region records, detection metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.functions import geo
from tilewright.functions.scoring import percentile_rank, running_total
from tilewright.sources.scratch import written

CONFIDENCE, MATCH_IOU = 0.5, 0.5


def confident(detections: DataFrame, least: float = CONFIDENCE) -> DataFrame:
    return detections.where(F.col("score") >= least)


def iou_pairs(detections: DataFrame, references: DataFrame, least: float = MATCH_IOU) -> DataFrame:
    """(tile_id, det, ref, score, iou) of overlapping boxes of a tile with at least that intersection over union."""
    d = detections.select("tile_id", F.col("idx").alias("det"), "score", "x", "y", "w", "h")
    r = references.select("tile_id", F.col("idx").alias("ref"), *(F.col(c).alias("r" + c) for c in "xywh"))
    both = d.join(r, "tile_id").where("x < rx + rw AND rx < x + w AND y < ry + rh AND ry < y + h")
    inter = (F.least(F.col("x") + F.col("w"), F.col("rx") + F.col("rw")) - F.greatest("x", "rx")) * (F.least(F.col("y") + F.col("h"), F.col("ry") + F.col("rh")) - F.greatest("y", "ry"))
    both = both.withColumn("inter", inter).withColumn("iou", F.col("inter") / (F.col("w") * F.col("h") + F.col("rw") * F.col("rh") - F.col("inter")))
    return both.where(F.col("iou") >= least).select("tile_id", "det", "ref", "score", "iou")


def greedy_matches(pairs: DataFrame, group: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """(group, det, ref, iou): in order of falling score (index on ties) each detection takes, of the references that are
    left, the one of largest (iou, ref).

    A tile's candidates are folded as one array; tiles hold hundreds of boxes at most, whatever the size of the table.
    """
    each = pairs.groupBy(*group, "det", "score").agg(F.sort_array(F.collect_list(F.struct("iou", "ref")), asc=False).alias("c"))
    tile = each.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), "det", "c"))).alias("all"))
    kind = "struct<taken: array<int>, out: array<struct<det: int, ref: int, iou: double>>>"
    fold = f"""aggregate(all, cast(named_struct('taken', array(), 'out', array()) AS {kind}), (a, d) ->
        transform(array(get(filter(d.c, c -> NOT array_contains(a.taken, c.ref)), 0)), p ->
            IF(p IS NULL, a, named_struct('taken', array_append(a.taken, p.ref), 'out', array_append(a.out, named_struct('det', d.det, 'ref', p.ref, 'iou', p.iou)))))[0], a -> a.out)"""
    return tile.selectExpr(*group, f"inline({fold})")


def located(tiles: DataFrame, detections: DataFrame) -> DataFrame:
    """Detections with the tile's columns, latitude, longitude, diameter in km and whether the box is cut by the tile's edge."""
    p = geo.Projection()
    rows = detections.join(tiles, "tile_id")
    lat, lon = geo.pixel_to_lonlat(p, F.col("x_min"), F.col("y_max"), F.col("px"), F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2)
    rows = rows.withColumns({"lat": lat, "lon": lon})
    ground = F.col("px") / geo.scale_factor(p, F.col("lat"), F.col("lon"))
    cut = (F.col("x") <= 0) | (F.col("y") <= 0) | (F.col("x") + F.col("w") >= F.col("width")) | (F.col("y") + F.col("h") >= F.col("width"))
    return rows.withColumns({"diameter_km": (F.col("w") + F.col("h")) / 2 * ground / 1000, "truncated": cut.cast("int")})


def with_center(tiles: DataFrame) -> DataFrame:
    """Tiles with the latitude, longitude and ground pixel size of their centre."""
    p, half = geo.Projection(), F.col("width") / 2
    lat, lon = geo.pixel_to_lonlat(p, F.col("x_min"), F.col("y_max"), F.col("px"), half, half)
    rows = tiles.withColumns({"lat": lat, "lon": lon})
    return rows.withColumn("ground_m", F.col("px") / geo.scale_factor(p, F.col("lat"), F.col("lon")))


def region_records(tiles: DataFrame, detections: DataFrame, references: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per tile: counts, size, area, density per 1000 km² and the percentile of the density over all tiles.

    ``detections`` are those to be counted. Tiles without any have zeros. The three counts are aggregated by tile before they meet.
    """
    count = lambda df, name: df.groupBy("tile_id").agg(F.count("*").alias(name))
    rows = with_center(tiles).join(count(detections, "detections"), "tile_id", "left").join(count(references, "references"), "tile_id", "left").join(count(matches, "matched"), "tile_id", "left")
    rows = rows.fillna(0, ["detections", "references", "matched"])
    side = F.col("width") * F.col("ground_m") / 1000
    rows = rows.withColumns({"size_km": F.round(side, 3), "density": F.round(F.col("detections") / (side * side) * 1000, 3)})
    return percentile_rank(rows, "density", "score")


def tile_details(detections: DataFrame, references: DataFrame, matches: DataFrame) -> DataFrame:
    """One document per tile: its predicted and reference boxes and the matches, as ordered arrays."""
    box = lambda *extra: F.struct("idx", *(F.round(c, 2).alias(c) for c in "xywh"), *extra)
    p = detections.groupBy("tile_id").agg(F.sort_array(F.collect_list(box(F.round("score", 4).alias("score")))).alias("prediction"))
    r = references.groupBy("tile_id").agg(F.sort_array(F.collect_list(box())).alias("reference"))
    m = matches.groupBy("tile_id").agg(F.sort_array(F.collect_list(F.struct("det", "ref", F.round("iou", 4).alias("iou")))).alias("matches"))
    return p.join(r, "tile_id", "full_outer").join(m, "tile_id", "left")


# --- metrics ----------------------------------------------------------------------------------------------------------

THRESHOLDS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))


def average_precision(detections: DataFrame, references: DataFrame, split: str = "split", most: int = 500, thresholds=THRESHOLDS) -> DataFrame:
    """(split, threshold, ap): box average precision by the public COCO protocol, with 101 recall points.

    In each tile the ``most`` best detections are matched at each threshold: in order of falling score, each takes the free
    reference of largest overlap of at least the threshold. Scores are ordered over the whole split by counting equal scores
    first and adding up ranges, never in one partition. Detections of equal score count as one step of the curve.
    """
    best = Window.partitionBy("tile_id").orderBy(F.desc("score"), "idx")
    det = detections.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    pairs = iou_pairs(det, references, min(thresholds))
    levels = F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold")
    matched = greedy_matches(pairs.select("*", levels).where("iou >= threshold"), ("tile_id", "threshold"))
    hits = matched.select("tile_id", "threshold", "det").join(det.select("tile_id", F.col("idx").alias("det"), split, "score"), ["tile_id", "det"])
    # scores without a hit add nothing to the curve but to the detections so far, which are the same at each threshold
    tps = running_total(hits.groupBy(split, "threshold", "score").agg(F.count("*").alias("tp")), "score", "tp", "above", ascending=False, by=(split, "threshold"))
    ns = running_total(det.groupBy(split, "score").agg(F.count("*").alias("n")), "score", "n", "above", ascending=False, by=(split,))
    steps = tps.withColumn("tps", F.col("above") + F.col("tp")).join(ns.select(split, "score", (F.col("above") + F.col("n")).alias("ns")), [split, "score"])
    total = references.groupBy(split).agg(F.count("*").alias("total"))
    curve = steps.join(total, split).select(split, "threshold", (F.col("tps") / F.col("total")).alias("recall"), (F.col("tps") / F.col("ns")).alias("precision"))
    points = F.explode(F.sequence(F.lit(0), F.lit(100))).alias("r")
    # the best precision at or beyond each recall point
    reached = curve.select("*", F.floor(F.col("recall") * 100 + 1e-9).alias("top")).groupBy(split, "threshold", "top").agg(F.max("precision").alias("p"))
    grid = total.select(split, points).crossJoin(F.broadcast(detections.sparkSession.createDataFrame([(t,) for t in thresholds], "threshold double")))
    up = Window.partitionBy(split, "threshold").orderBy(F.desc("r")).rowsBetween(Window.unboundedPreceding, 0)
    filled = grid.join(reached, [grid[split] == reached[split], grid["threshold"] == reached["threshold"], grid["r"] == reached["top"]], "left").select(grid[split], grid["threshold"], "r", "p")
    filled = filled.withColumn("best", F.coalesce(F.max("p").over(up), F.lit(0.0)))
    return filled.groupBy(split, "threshold").agg(F.avg("best").alias("ap"))


def repeats(craters: DataFrame, cell: float = 0.25, wrap: bool = False) -> DataFrame:
    """Craters (tile_id, idx, lat, lon, diameter_km) that another tile's crater repeats: closer than max(1 km, 250 m per km
    of diameter), with diameters that differ by at most a quarter of the larger.

    Joined by cells: each crater looks into the nine cells around its own. With ``wrap`` cells meet over the antimeridian.
    """
    width = round(360 / cell)
    cells = lambda c: F.floor(F.col(c) / cell)
    a = craters.select("tile_id", "idx", "lat", "lon", "diameter_km", cells("lat").alias("i"), cells("lon").alias("j"))
    near = a.withColumn("i", F.explode(F.array(F.col("i") - 1, F.col("i"), F.col("i") + 1))).withColumn("j", F.explode(F.array(F.col("j") - 1, F.col("j"), F.col("j") + 1)))
    b = a.select(*(F.col(c).alias("o_" + c) for c in ("tile_id", "lat", "lon", "diameter_km")), "i", "j")
    if wrap:
        near, b = (x.withColumn("j", F.pmod(F.col("j"), F.lit(width))) for x in (near, b))
    larger = F.greatest("diameter_km", "o_diameter_km")
    close = (geo.distance_m(F.col("lat"), F.col("lon"), F.col("o_lat"), F.col("o_lon")) <= F.greatest(F.lit(1000.0), 250 * F.col("diameter_km"))) & (F.abs(F.col("diameter_km") - F.col("o_diameter_km")) <= 0.25 * larger)
    return near.join(b, ["i", "j"]).where((F.col("tile_id") != F.col("o_tile_id")) & close).select("tile_id", "idx").distinct()


def repeats_by_reach(craters: DataFrame, least_km: float = 1.0, share: float = 0.25) -> DataFrame:
    """(tile_id, idx) of the craters (tile_id, idx, lat, lon, diameter_km) that another tile's crater repeats: no further than
    max(``least_km``, ``share`` of the diameter), with diameters that differ by at most ``share`` of the larger. No size and no
    place is missed. Rows with a null among these columns repeat nothing.

    The grid has a level for each class of diameters, three-dimensional, so that poles and the antimeridian are like any other place. A
    cell of a level is three times as wide as the farthest reach of its class: a crater looks into the cells of its own level that lie
    on the sphere and within its reach, about three, and stands itself in one cell of each level whose craters may be repeated by it, two.
    Levels also keep small and large craters of one spot apart. The craters are written once, so that what makes them (projections, say)
    is computed neither for both sides nor again in each filter that the optimizer puts below the join.
    """
    step = 1.001 / (1 - share) ** 2
    names, r = ("tile_id", "idx", "lat", "lon", "diameter_km"), geo.RADIUS / 1000
    rows = written(craters.select(*names), "craters").where("tile_id is not null and lat is not null and lon is not null and diameter_km is not null")
    level = lambda part: F.floor(F.log(F.greatest(F.col("diameter_km"), F.lit(1e-9))) / math.log(step) + part)
    width = 3 * F.greatest(F.lit(least_km), share * F.pow(F.lit(step), F.col("level") + 1))
    p, q = F.radians("lat"), F.radians("lon")
    rows = rows.withColumns({"x": r * F.cos(p) * F.cos(q), "y": r * F.cos(p) * F.sin(q), "z": r * F.sin(p)})
    # a hash as a cell's name: what two cells of one hash bring together is compared like the rest
    cell = lambda *c: F.xxhash64("level", *c).alias("cell")
    reach = F.greatest(F.lit(least_km), share * F.col("diameter_km"))
    look = rows.withColumns({"level": level(0), "reach": reach * 1.000001}).withColumn("width", width)
    for c in "xyz":
        look = look.withColumn("c" + c, F.explode(F.sequence(F.floor((F.col(c) - F.col("reach")) / F.col("width")), F.floor((F.col(c) + F.col("reach")) / F.col("width")))))
    low = {c: F.col("c" + c) * F.col("width") for c in "xyz"}
    square = lambda of: sum((of(c, low[c], low[c] + F.col("width")) ** 2 for c in "xyz"), F.lit(0.0))
    within = square(lambda c, lo, hi: F.greatest(lo - F.col(c), F.col(c) - hi, F.lit(0.0))) <= F.col("reach") ** 2
    on_sphere = (square(lambda c, lo, hi: F.greatest(lo, -hi, F.lit(0.0))) <= r * r * 1.000001) & (square(lambda c, lo, hi: F.greatest(-lo, hi)) >= r * r * 0.999999)
    look = look.where(within & on_sphere).select(*names, cell("cx", "cy", "cz"))
    span = -math.log(1 - share) / math.log(step) + 1e-4
    stand = rows.withColumn("level", F.explode(F.sequence(level(-span), level(span)))).withColumn("width", width)
    stand = stand.select(*(F.col(c).alias("o_" + c) for c in names if c != "idx"), cell(*(F.floor(F.col(c) / F.col("width")) for c in "xyz")))
    # latitudes are compared first, since they are the cheap part of the distance
    beside = F.abs(F.col("lat") - F.col("o_lat")) <= reach * math.degrees(1.000001 / r)
    near = geo.distance_m(F.col("lat"), F.col("lon"), F.col("o_lat"), F.col("o_lon")) <= 1000 * reach
    alike = F.abs(F.col("diameter_km") - F.col("o_diameter_km")) <= share * F.greatest("diameter_km", "o_diameter_km")
    a, b = look.alias("a"), stand.alias("b")
    return a.join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("tile_id") != F.col("o_tile_id")) & alike & beside & near, "left_semi").select("tile_id", "idx").distinct()


def coordinate_residual(tiles: DataFrame, detections: DataFrame, published: DataFrame) -> DataFrame:
    """(tile_id, max_m): the largest distance between recomputed and published (tile_id, idx, lat, lon) coordinates."""
    again = located(tiles, detections).select("tile_id", "idx", F.col("lat").alias("a"), F.col("lon").alias("b"))
    far = geo.distance_m(F.col("a"), F.col("b"), F.col("lat"), F.col("lon"))
    return again.join(published.select("tile_id", "idx", "lat", "lon"), ["tile_id", "idx"]).groupBy("tile_id").agg(F.max(far).alias("max_m"))
