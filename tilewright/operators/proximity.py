"""Points and footprints on the sphere: projection recovery, corners, containment, close pairs, groups, coverage."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tilewright.functions import geo
from tilewright.operators.graph import connected_components
from tilewright.sources.scratch import written

TOLERANCE_DEG = 1e-6


def projection_candidates(spark: SparkSession) -> DataFrame:
    """The 92 projections that a tile may have: 45 zones of transverse Mercator with two false northings, two polar caps."""
    zones = spark.range(45).select(F.lit("tm").alias("kind"), F.lit(0.0).alias("lat0"), (-176.0 + 8 * F.col("id")).alias("lon0"), F.lit(0.999).alias("k0"), F.lit(250000.0).alias("fe"), F.explode(F.array(F.lit(0.0), F.lit(2500000.0))).alias("fn"))
    caps = spark.range(2).select(F.lit("ps").alias("kind"), (F.col("id") * 180.0 - 90).alias("lat0"), F.lit(0.0).alias("lon0"), F.lit(0.994).alias("k0"), F.lit(500000.0).alias("fe"), F.lit(500000.0).alias("fn"))
    return zones.unionByName(caps).withColumn("candidate", F.concat_ws("/", "kind", F.col("lat0").cast("int"), F.col("lon0").cast("int"), F.col("fn").cast("int")))


def recovered_projection(meta: DataFrame, candidates: DataFrame, tolerance: float = TOLERANCE_DEG) -> DataFrame:
    """(tile_id, candidate, fits): the candidate that reproduces all published points, and how many do; null unless exactly one.

    ``meta`` has (tile_id, x, y, lat, lon), a row per point. Candidates that differ by their meridian alone give the same
    latitude and longitudes that differ by the meridian, so a point is projected back once for each of the few families;
    meridians are tried only where the latitude fits. The families are a handful of rows and are broadcast.
    """
    shape = ["kind", "lat0", "k0", "fe", "fn"]
    families = candidates.groupBy(*shape).agg(F.collect_list(F.struct("candidate", F.col("lon0").alias("meridian"))).alias("zones")).withColumn("lon0", F.lit(0.0))
    lat, east = geo.inverse(geo.Projection(), F.col("x"), F.col("y"))
    rows = meta.crossJoin(F.broadcast(families)).withColumns({"_off": F.abs(lat - F.col("lat")), "_east": east}).where(F.col("_off") <= tolerance)
    turn = F.abs(geo.wrap(F.col("_east") + F.col("z.meridian") - F.col("lon")))
    hits = rows.select("tile_id", "lon", "_east", F.explode("zones").alias("z")).where(turn <= tolerance).groupBy("tile_id", "z.candidate").agg(F.count("*").alias("n"))
    whole = meta.groupBy("tile_id").agg(F.count("*").alias("points"))
    found = hits.join(whole, "tile_id").where("n = points").groupBy("tile_id").agg(F.count("*").alias("fits"), F.min("candidate").alias("one"))
    rows = whole.join(found, "tile_id", "left").fillna(0, ["fits"])
    return rows.select("tile_id", F.when(F.col("fits") == 1, F.col("one")).alias("candidate"), "fits")


def footprint(tiles: DataFrame, n: int = 2) -> DataFrame:
    """(tile_id, i, j, lat, lon, x, y) of an n x n grid of points over each tile's outer edges; two are the corners."""
    step = F.col("width") / F.lit(n - 1)
    rows = tiles.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")).select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
    p = geo.Projection()
    rows = rows.withColumns({"x": F.col("x_min") + F.col("j") * step * F.col("px"), "y": F.col("y_max") - F.col("i") * step * F.col("px")})
    lat, lon = geo.inverse(p, F.col("x"), F.col("y"))
    return rows.withColumns({"lat": lat, "lon": lon})


def points_in_tiles(points: DataFrame, tiles: DataFrame, cell: float = 2.0) -> DataFrame:
    """(point_id, tile_id): points inside the quadrilateral of a tile, edges included, told by its own pixel grid to a millionth pixel.

    ``tiles`` carry ``lat`` and ``lon`` of their centre and ``reach_deg``, the largest angle from it to a point of the tile.
    Both sides meet in cells of latitude and longitude; a tile enters every cell that the circle around it may touch, all
    longitudes where the circle holds a pole. Distinct places meet distinct grids; their points and tiles come in only where a
    place is found inside, so that what many share is computed once and only the result grows with the square of copies.
    """
    rows, turn = round(180 / cell), round(360 / cell)
    at = lambda v, o: F.floor((v + o) / cell)
    lo, hi = F.greatest(F.col("lat") - F.col("reach_deg"), F.lit(-90.0)), F.least(F.col("lat") + F.col("reach_deg"), F.lit(90.0))
    most = F.greatest(F.abs(lo), F.abs(hi))
    # the circle's half width in longitude: asin(sin reach / cos lat), or all of it around a pole
    ratio = F.sin(F.radians("reach_deg")) / F.cos(F.radians("lat"))
    half = F.when((most >= 89.999) | (ratio >= 1), 180.0).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9)
    i = F.explode(F.sequence(at(lo, 90), F.least(at(hi, 90), F.lit(rows - 1))))
    grid = ["kind", "lat0", "lon0", "k0", "fe", "fn", "x_min", "y_max", "px", "width", "lat", "lon", "reach_deg"]
    t = tiles.select(*grid).distinct().withColumn("half", half).withColumn("ci", i)
    t = t.withColumn("cj", F.explode(F.array_distinct(F.transform(F.sequence(at(F.col("lon") - F.col("half"), 180), at(F.col("lon") + F.col("half"), 180)), lambda j: F.pmod(j, F.lit(turn))))))
    p = points.select("point_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    one = p.select("p_lat", "p_lon").distinct().withColumns({"ci": F.least(at(F.col("p_lat"), 90), F.lit(rows - 1)), "cj": F.pmod(at(F.col("p_lon"), 180), F.lit(turn))})
    # explicit numbers of tasks: candidates and the result are far more than what adaptive execution measures
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = one.repartition(n, "ci", "cj").join(t.repartition(n, "ci", "cj"), ["ci", "cj"])
    col, row = geo.lonlat_to_pixel(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), F.col("p_lat"), F.col("p_lon"))
    near = geo.distance_m(F.col("p_lat"), F.col("p_lon"), F.col("lat"), F.col("lon")) <= F.radians("reach_deg") * geo.RADIUS * 1.0000001
    inside = both.where(near).withColumns({"c": F.round(col, 6), "r": F.round(row, 6)}).where("c BETWEEN 0 AND width AND r BETWEEN 0 AND width")
    held = inside.select("p_lat", "p_lon", *grid).join(tiles.select("tile_id", *grid), grid).select("p_lat", "p_lon", "tile_id")
    return p.repartition(n, "p_lat", "p_lon").join(held, ["p_lat", "p_lon"]).select("point_id", "tile_id")


def with_corners(tiles: DataFrame) -> DataFrame:
    """Tiles with ``lats`` and ``lons`` of their four outer corners, clockwise from the upper left."""
    w = F.col("width")
    at = [geo.pixel_to_lonlat(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), col * w, row * w) for col, row in ((0, 0), (1, 0), (1, 1), (0, 1))]
    return tiles.withColumns({"lats": F.array(*[lat for lat, _ in at]), "lons": F.array(*[lon for _, lon in at])})


def in_bounds(margin: float = 0.0) -> Column:
    """Whether (lat, lon) lies in the bounds of the latitudes ``lats`` and the longitudes ``lons``, unwrapped around the point."""
    near = F.transform("lons", lambda x: F.pmod(x - F.col("lon") + 180, F.lit(360.0)) - 180)
    return F.col("lat").between(F.array_min("lats") - margin, F.array_max("lats") + margin) & (F.array_min(near) <= margin) & (F.array_max(near) >= -margin)


def within_bounds(pairs: DataFrame, margin: float = 0.0) -> DataFrame:
    """Pairs (lat, lon, lats, lons) whose point lies in the bounds of the footprint."""
    return pairs.where(in_bounds(margin))


def in_box() -> Column:
    """Whether (lat, lon) lies between the least and the largest of ``lats`` and ``lons`` as they stand, without unwrapping."""
    return F.col("lat").between(F.array_min("lats"), F.array_max("lats")) & F.col("lon").between(F.array_min("lons"), F.array_max("lons"))


def close_pairs(points: DataFrame, km: float) -> DataFrame:
    """(a, b, m): points (id, lat, lon) closer than ``km``, a < b.

    Joined by cells of the three-dimensional grid of that width on the sphere: each point looks into the 27 cells around
    its own, so poles and the antimeridian are like any other place, and no cell holds more than its surface.
    """
    p, q = F.radians("lat"), F.radians("lon")
    r = geo.RADIUS / 1000 / km
    rows = points.select("id", "lat", "lon", *(F.floor(v * r).alias(c) for c, v in (("cx", F.cos(p) * F.cos(q)), ("cy", F.cos(p) * F.sin(q)), ("cz", F.sin(p)))))
    around = F.sequence(F.lit(-1), F.lit(1))
    look = rows.withColumn("cx", F.explode(F.transform(around, lambda d: F.col("cx") + d))).withColumn("cy", F.explode(F.transform(around, lambda d: F.col("cy") + d))).withColumn("cz", F.explode(F.transform(around, lambda d: F.col("cz") + d)))
    other = rows.select(F.col("id").alias("b"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), "cx", "cy", "cz")
    m = geo.distance_m(F.col("lat"), F.col("lon"), F.col("b_lat"), F.col("b_lon"))
    return look.join(other, ["cx", "cy", "cz"]).where("id < b").select(F.col("id").alias("a"), "b", m.alias("m")).where(F.col("m") < km * 1000)


def point_groups(points: DataFrame, km: float) -> DataFrame:
    """(id, component) of every point: components of the graph of close pairs. Points without numbers as coordinates are alone.

    Points of one place are close, so only distinct places are paired, each by the least id of its points; an id that stands at
    several places links them. However many points share places, pairs grow with the places alone.
    """
    held = points.where("id is not null").where((F.abs("lat") < float("inf")) & (F.abs("lon") < float("inf"))).select("id", "lat", "lon")
    places = written(held.groupBy("lat", "lon").agg(F.min("id").alias("place")), "places")
    at = F.struct("lat", "lon")
    apart = held.groupBy("id").agg(F.min(at).alias("from"), F.max(at).alias("to")).where(F.col("from") != F.col("to")).select("id")
    same = held.join(apart, "id", "left_semi").join(places, ["lat", "lon"]).select(F.col("place").alias("a"), F.col("id").alias("b"))
    pairs = close_pairs(places.withColumnRenamed("place", "id"), km).select("a", "b").unionByName(same)
    found = places.join(connected_components(pairs, "a", "b"), F.col("place") == F.col("node"), "left").select("lat", "lon", F.coalesce("component", "place").alias("component"))
    return points.select("id", "lat", "lon").join(found, ["lat", "lon"], "left").select("id", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def group_stats(groups: DataFrame, splits: DataFrame) -> DataFrame:
    """One row: components, those of several points, the largest, components by split, and those without the test split."""
    per = groups.join(splits, "id").groupBy("component").agg(F.count("*").alias("n"), *(F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "validation", "test")))
    return per.agg(F.count("*").alias("components"), F.count_if(F.col("n") > 1).alias("with_repeats"), F.max("n").alias("largest"), *(F.sum(s).alias(s) for s in ("train", "validation", "test")), F.count_if(F.col("test") == 0).alias("without_test"))


#: Places up to which a group's pairs are all looked at.
FEW_PLACES = 32


def group_span(points: DataFrame, few: int = FEW_PLACES) -> DataFrame:
    """(g, span_m): the largest distance of two points (g, id, lat, lon) of a group. Groups of one point are missing, points without
    coordinates are left out; a group may have any number of points.

    Pairs of all places are looked at in groups of few. Larger ones are cut by octrees on the sphere's points: pairs of cells are
    bounded from below by a pair of their points and from above by their boxes, and only pairs of cells that may still hold the
    farthest pair are cut further, until they hold few pairs of points.
    """
    lat, lon = F.radians("lat"), F.radians("lon")
    held = points.where("g is not null and lat is not null and lon is not null")
    places = held.groupBy("g", "lat", "lon").agg(F.count("*").alias("n")).withColumns({"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)})
    places = written(places, "places")
    size = places.groupBy("g").agg(F.count("*").alias("k"), F.sum("n").alias("n")).where("n > 1")
    size = written(size, "sizes")
    near = geo.distance_m(F.col("lat"), F.col("lon"), F.col("b_lat"), F.col("b_lon"))
    one = places.join(size.where(F.col("k") <= few).select("g"), "g")
    other = one.select("g", F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
    apart = one.join(other, "g").where("struct(lat, lon) < struct(b_lat, b_lon)").groupBy("g").agg(F.max(near).alias("span_m"))
    large = size.where(F.col("k") > few).select("g")
    if not large.isEmpty():
        apart = apart.unionByName(_farthest(places.join(large, "g")).groupBy("g").agg(F.max(near).alias("span_m")))
    return size.select("g").join(apart, "g", "left").select("g", F.coalesce("span_m", F.lit(0.0)).alias("span_m"))


def _farthest(places: DataFrame, step: int = 2, deepest: int = 20) -> DataFrame:
    """(g, lat, lon, b_lat, b_lon): pairs of places of each group among which its farthest one is."""
    box = places.groupBy("g").agg(*(F.min(c).alias("o" + c) for c in "xyz"), F.greatest(*(F.max(c) - F.min(c) for c in "xyz")).alias("wide"))
    unit = lambda c: (F.col(c) - F.col("o" + c)) / F.col("wide") * (1 - 1e-9)
    rows = written(places.join(box, "g").select("g", "lat", "lon", "x", "y", "z", *(unit(c).alias("u" + c) for c in "xyz")), "places")
    cell = lambda level: reduce(lambda k, c: k * 2**21 + F.floor(F.col("u" + c) * 2**level), "xyz", F.lit(0).cast("long"))
    pairs, level = None, 0
    while True:
        level += step
        boxes = [f(c).alias(n + c) for n, f in (("l", F.min), ("h", F.max)) for c in "xyz"]
        cells = rows.groupBy("g", cell(level).alias("c"), cell(level - step).alias("p")).agg(F.count("*").alias("n"), F.min(F.struct("x", "y", "z")).alias("at"), *boxes)
        cells = written(cells, "cells")
        a, b = (cells.select("g", *(F.col(c).alias(k + c) for c in ("c", "p", "n", "at", *(n + x for n in "lh" for x in "xyz")))) for k in ("a_", "b_"))
        both = a.join(b, "g") if pairs is None else pairs.join(a, ["g", "a_p"]).join(b, ["g", "b_p"])
        gap = lambda c: F.greatest(F.abs(F.col("a_h" + c) - F.col("b_l" + c)), F.abs(F.col("b_h" + c) - F.col("a_l" + c)))
        least = sum((F.col(f"a_at.{c}") - F.col(f"b_at.{c}")) ** 2 for c in "xyz")
        both = both.where("a_p <> b_p OR a_c <= b_c").withColumns({"least": least, "most": sum(gap(c) ** 2 for c in "xyz")})
        both = written(both.select("g", "a_c", "b_c", "a_n", "b_n", "least", "most"), "pairs")
        best = both.groupBy("g").agg(F.max("least").alias("best"))
        open_ = written(both.join(best, "g").where(F.col("most") >= F.col("best") * (1 - 1e-12)).select("g", "a_c", "b_c", "a_n", "b_n"), "open")
        ends = open_.select("g", F.col("a_c").alias("c")).union(open_.select("g", F.col("b_c").alias("c"))).distinct()
        rows = written(rows.withColumn("c", cell(level)).join(ends, ["g", "c"], "left_semi").drop("c"), "places")
        work = open_.agg(F.sum(F.col("a_n") * F.col("b_n")).alias("work"), F.count("*").alias("pairs")).first()
        if level >= deepest or work["work"] <= 8 * work["pairs"]:
            break
        pairs = open_.select("g", F.col("a_c").alias("a_p"), F.col("b_c").alias("b_p"))
    ends = rows.select("g", "lat", "lon", cell(level).alias("c"))
    left = open_.select("g", "a_c", "b_c").join(ends.withColumnRenamed("c", "a_c"), ["g", "a_c"])
    return left.join(ends.select("g", F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), F.col("c").alias("b_c")), ["g", "b_c"]).select("g", "lat", "lon", "b_lat", "b_lon")


def coverage_cells(tiles: DataFrame, cell: float = 0.5, n: int = 12) -> DataFrame:
    """(split, i, j): distinct cells that an n x n grid of points of each tile touches; tiles of equal grids are projected once."""
    rows = round(180 / cell)
    at = lambda v, o, most: F.least(F.floor((F.round(v, 9) + o) / cell), F.lit(most - 1)).cast("int")
    grids = tiles.select("split", "kind", "lat0", "lon0", "k0", "fe", "fn", "x_min", "y_max", "px", "width").distinct()
    # few bytes, much to compute: an explicit number of tasks, since adaptive execution puts small partitions together
    grids = grids.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return footprint(grids, n).select("split", at(F.col("lat"), 90, rows).alias("i"), at(F.col("lon"), 180, 2 * rows).alias("j")).distinct()


def covered_area(cells: DataFrame, cell: float = 0.5) -> DataFrame:
    """(split, cells, km2, fraction) of each split, of ``union``, and of ``added``: cells that only other splits than test have."""
    r, d = geo.RADIUS / 1000, math.radians(cell)
    lat0 = F.radians(F.lit(-90.0) + F.col("i") * cell)
    area = r * r * d * (F.sin(lat0 + d) - F.sin(lat0))
    each = cells.groupBy("i", "j").agg(F.collect_set("split").alias("s"))
    named = each.select("i", "j", F.explode(F.array_union(F.array_union(F.col("s"), F.array(F.lit("union"))), F.when(~F.array_contains("s", "test"), F.array(F.lit("added"))).otherwise(F.array().cast("array<string>")))).alias("split"))
    return named.groupBy("split").agg(F.count("*").alias("cells"), F.sum(area).alias("km2")).withColumn("fraction", F.col("km2") / (4 * math.pi * r * r))


def split_stats(points: DataFrame, *counted: str) -> DataFrame:
    """Per split and for all (``rollup``): points, ranges, hemispheres and near side of (split, lat, lon)."""
    lat, lon = F.col("lat"), F.col("lon")
    rows = points.rollup("split").agg(F.count("*").alias("tiles"), F.round(F.min(lat), 2).alias("lat_min"), F.round(F.max(lat), 2).alias("lat_max"), F.round(F.min(lon), 2).alias("lon_min"), F.round(F.max(lon), 2).alias("lon_max"),
                                      F.count_if(lat >= 0).alias("north"), F.count_if(lat < 0).alias("south"), F.count_if(F.abs(lon) <= 90).alias("nearside"), F.count_if(F.abs(lon) > 90).alias("farside"), *(F.count_if(F.col("kind") == k).alias(k) for k in counted))
    return rows.fillna("all", ["split"])


def bands(points: DataFrame, lat_step: int = 15, lon_step: int = 30) -> DataFrame:
    """(split, axis, band, n): points in bands of latitude and longitude, by split and for all."""
    band = F.explode(F.array(F.struct(F.lit("lat").alias("axis"), (F.floor(F.col("lat") / lat_step) * lat_step).alias("band")), F.struct(F.lit("lon").alias("axis"), (F.floor(F.col("lon") / lon_step) * lon_step).alias("band")))).alias("b")
    return points.select("split", band).select("split", "b.*").groupBy("axis", "band", "split").agg(F.count("*").alias("n")).select("split", "axis", "band", "n").unionByName(
        points.select("split", band).select("b.*").groupBy("axis", "band").agg(F.count("*").alias("n")).withColumn("split", F.lit("all")))


def observation_groups(regions: DataFrame, extra_m: float) -> tuple[DataFrame, DataFrame]:
    """(groups, violations) of (region_id, target, footprint, lat, lon, area_m2, split).

    A group has its spherical mean, the radius that holds its members' tiles, its members by falling area, and its splits.
    Targets of several footprints are violations and have no group.
    """
    marks = regions.groupBy("target").agg(F.count_distinct("footprint").alias("footprints"))
    violations = marks.where("footprints > 1")
    ok = regions.join(marks.where("footprints = 1"), "target", "left_semi")
    lat, lon = geo.mean_coordinate(F.col("lat"), F.col("lon"))
    ids = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("area_m2")).alias("o"), "region_id"))), lambda s: s["region_id"])
    groups = ok.groupBy("target").agg(lat.alias("g_lat"), lon.alias("g_lon"), ids.alias("observation_ids"), *(F.count_if(F.col("split") == s).alias(s) for s in ("train", "validation", "test")))
    radius = ok.join(groups.select("target", "g_lat", "g_lon"), "target").groupBy("target").agg(F.max(geo.distance_m(F.col("g_lat"), F.col("g_lon"), F.col("lat"), F.col("lon"))).alias("far"))
    return groups.join(radius, "target").withColumn("radius_m", F.round(F.col("far") + extra_m, 1)).drop("far"), violations


def shared_footprints(regions: DataFrame) -> DataFrame:
    return regions.groupBy("footprint").agg(F.sort_array(F.collect_list("region_id")).alias("ids")).where("size(ids) > 1")


def cell_matrix(cells: DataFrame, splits: DataFrame, size: int = 9, of: tuple[str, ...] = ("pole",)) -> DataFrame:
    """(pole, row, col, split) of all size x size cells: ``missing`` where there is no patch, ``unlisted`` where it has no split."""
    grid = cells.select(*of).distinct().select(*of, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("col"))
    known = cells.join(splits, "patch_id", "left").select(*of, "row", "col", F.coalesce("split", F.lit("unlisted")).alias("split"))
    return grid.join(known, [*of, "row", "col"], "left").fillna("missing", ["split"])


def origin_spread(cells: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Named rows and columns of a pole whose patches do not share their origin: (pole, axis, at, spread)."""
    rows = cells.groupBy("pole", F.lit("row").alias("axis"), F.col("row").alias("at")).agg((F.max("y_max") - F.min("y_max")).alias("spread"))
    cols = cells.groupBy("pole", F.lit("col").alias("axis"), F.col("col").alias("at")).agg((F.max("x_min") - F.min("x_min")).alias("spread"))
    return rows.unionByName(cols).where(F.col("spread") > tolerance)


def sites(regions: DataFrame, km: float = 5.0) -> DataFrame:
    """(component, lat, lon, observations, footprints, targets, splits) of groups of close regions (id, lat, lon, ...)."""
    rows = regions.join(point_groups(regions.select("id", "lat", "lon"), km), "id")
    lat, lon = geo.mean_coordinate(F.col("lat"), F.col("lon"))
    by_split = rows.groupBy("component", "split").agg(F.count("*").alias("n")).groupBy("component").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("split", "n")))).alias("splits"))
    main = rows.groupBy("component").agg(lat.alias("lat"), lon.alias("lon"), F.count("*").alias("observations"), F.count_distinct("footprint").alias("footprints"), F.sort_array(F.collect_set("target")).alias("targets"))
    return main.join(by_split, "component")


def round_trip_error(grids: DataFrame, n: int, seed: int) -> DataFrame:
    """(tile_id, max_error_m, lat_sum) of n seeded points of each grid: projected point, inverse, forward; and the sum of their
    latitudes, which tells the points. A point is where the MD5 of tile, number, seed and axis says."""
    rows = grids.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("k"))
    u = lambda s: F.conv(F.substring(F.md5(F.concat_ws("|", "tile_id", "k", F.lit(seed), F.lit(s))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    p = geo.Projection()
    rows = rows.withColumns({"x": F.col("x_min") + u(1) * F.col("width") * F.col("px"), "y": F.col("y_max") - u(2) * F.col("width") * F.col("px")})
    lat, lon = geo.inverse(p, F.col("x"), F.col("y"))
    rows = rows.withColumns({"lat": lat, "lon": lon})
    x, y = geo.forward(p, F.col("lat"), F.col("lon"))
    return rows.withColumn("off", F.hypot(x - F.col("x"), y - F.col("y"))).groupBy("tile_id").agg(F.max("off").alias("max_error_m"), F.sum("lat").alias("lat_sum"))
