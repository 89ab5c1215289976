"""Constraint queries: a rule is a name and a table of what breaks it; a validation is the union of its rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tilewright.functions import geo
from tilewright.operators import proximity, raster

SCHEMA = "rule_id string, object_id string, message string"


def violations(rows: DataFrame, rule: str, broken: Column, object_: str, message: Column | None = None) -> DataFrame:
    """Rows for which ``broken`` is true, or null: what cannot be told is not in order."""
    return rows.where(F.coalesce(broken, F.lit(True))).select(F.lit(rule).alias("rule_id"), F.col(object_).cast("string").alias("object_id"), (message if message is not None else F.lit("")).cast("string").alias("message"))


def checked(rows: DataFrame, object_: str, *rules: tuple) -> DataFrame:
    """The union of ``violations`` over the same rows for (rule, broken) or (rule, broken, message), in one pass over them."""
    found = F.array(*[F.struct(F.lit(rule).alias("rule_id"), F.coalesce(broken, F.lit(True)).alias("broken"), (message[0] if message else F.lit("")).cast("string").alias("message")) for rule, broken, *message in rules])
    hits = rows.select(F.col(object_).cast("string").alias("object_id"), F.explode(F.filter(found, lambda r: r["broken"])).alias("r"))
    return hits.select("r.rule_id", "object_id", "r.message")


def duplicates(rows: DataFrame, rule: str, key: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return n.select(F.lit(rule).alias("rule_id"), F.col(key).cast("string").alias("object_id"), F.col("n").cast("string").alias("message"))


def missing(expected: DataFrame, found: DataFrame, rule: str, key: str) -> DataFrame:
    return expected.join(found.select(key).distinct(), key, "left_anti").select(F.lit(rule).alias("rule_id"), F.col(key).cast("string").alias("object_id"), F.lit("missing").alias("message"))


def problems(spark: SparkSession, *tables: DataFrame, scope: str = "full", raw_rules: tuple[str, ...] = ()) -> DataFrame:
    """All violations; in scope ``published`` without the rules that need raw data."""
    rows = reduce(DataFrame.unionByName, tables, spark.createDataFrame([], SCHEMA))
    return rows.where(~F.col("rule_id").isin(*raw_rules)) if scope == "published" and raw_rules else rows


def coordinate_rules(rows: DataFrame, object_: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    return violations(rows, "coordinate-range", ~(F.col(lat).between(-90, 90) & (F.col(lon) >= -180) & (F.col(lon) < 180)), object_)


def provenance_rules(objects: DataFrame, pins: DataFrame, splits: tuple[str, ...] = ("train", "validation", "test", "external")) -> DataFrame:
    """Objects (object_id, task, model, dataset, split) against one pinned (model, dataset) per task. Pins are a small
    dimension; Spark broadcasts them if their measured size allows."""
    p = pins.select("task", F.col("model").alias("pin_model"), F.col("dataset").alias("pin_dataset"))
    both = objects.join(p, "task", "left")
    return reduce(DataFrame.unionByName, [
        violations(both, "provenance-task", F.col("pin_model").isNull(), "object_id", F.col("task")),
        violations(both.where("pin_model IS NOT NULL"), "provenance-model", F.col("model") != F.col("pin_model"), "object_id", F.col("model")),
        violations(both.where("pin_model IS NOT NULL"), "provenance-dataset", F.col("dataset") != F.col("pin_dataset"), "object_id", F.col("dataset")),
        violations(both, "provenance-split", ~F.col("split").isin(*splits), "object_id", F.col("split")),
    ])


def run_rules(runs: DataFrame) -> DataFrame:
    """Runs (run_id, missing_keys, unexpected_keys, sha256, pinned_sha256, non_finite, size, std)."""
    return reduce(DataFrame.unionByName, [
        violations(runs, "run-strict", (F.col("missing_keys") > 0) | (F.col("unexpected_keys") > 0), "run_id"), violations(runs, "run-checkpoint", F.col("sha256") != F.col("pinned_sha256"), "run_id"),
        violations(runs, "run-finite", F.col("non_finite") > 0, "run_id"), violations(runs, "run-empty", F.col("size") == 0, "run_id"), violations(runs, "run-constant", F.col("std") <= 0, "run_id"),
    ])


def crater_rules(regions: DataFrame, craters: DataFrame, size: int = 512) -> DataFrame:
    """Counts, ranges and boxes of (tile_id, detections, matched) against (tile_id, idx, x, y, w, h, score, diameter_km, matched, lat, lon)."""
    per = craters.groupBy("tile_id").agg(F.count("*").alias("n"), F.sum("matched").alias("m"))
    both = regions.join(per, "tile_id", "full_outer").fillna(0, ["n", "m", "detections"])
    return reduce(DataFrame.unionByName, [
        violations(both, "crater-count", F.col("n") != F.col("detections"), "tile_id", F.concat_ws("/", "n", "detections")), violations(both.where("matched IS NOT NULL"), "crater-matched", F.col("m") != F.col("matched"), "tile_id"),
        violations(craters, "crater-tuple", ~(F.col("score").between(0, 1) & (F.col("diameter_km") > 0) & F.col("matched").isin(0, 1)), "tile_id", F.col("idx")),
        violations(craters, "crater-box", (F.col("x") < 0) | (F.col("y") < 0) | (F.col("x") + F.col("w") > size) | (F.col("y") + F.col("h") > size), "tile_id", F.col("idx")), coordinate_rules(craters, "tile_id"),
    ])


def mask_rules(published: DataFrame, masks: DataFrame, object_: str = "patch_id", size: int = 8) -> DataFrame:
    """Published mask records (pixels, area_m2, fraction, mean_softmax, iou, row, col) against those of their masks: shares within
    0 and 1, no negative area, the centroid inside its tile of ``size`` pixels, and as many pixels as the mask has."""
    share = lambda c: F.col(c).isNull() | F.col(c).between(0, 1)
    counted = published.select(object_, "pixels").join(masks.select(object_, F.col("pixels").alias("n")), object_, "full_outer")
    return reduce(DataFrame.unionByName, [
        violations(published, "mask-fraction", ~F.col("fraction").between(0, 1), object_), violations(published, "mask-area", F.col("area_m2") < 0, object_),
        violations(published, "mask-iou", ~share("iou"), object_), violations(published, "mask-softmax", ~share("mean_softmax"), object_),
        violations(published.where("row IS NOT NULL"), "mask-centroid", ~(F.col("row").between(0, size) & F.col("col").between(0, size)), object_),
        violations(counted, "mask-pixels", F.col("pixels") != F.col("n"), object_, F.concat_ws("/", F.col("pixels"), F.col("n"))),
    ])


def identity_rules(discoveries: DataFrame, registry: DataFrame) -> DataFrame:
    """Published discoveries (id, type, key) against the registry: each id is registered, with the same type and key, and stands once."""
    both = discoveries.join(registry.select("id", F.col("type").alias("registered"), F.col("key").alias("identity")), "id", "left")
    return reduce(DataFrame.unionByName, [
        violations(both.where("registered IS NULL"), "discovery-unregistered", F.lit(True), "id"), violations(both.where("registered IS NOT NULL"), "discovery-type", F.col("type") != F.col("registered"), "id", F.col("type")),
        violations(both.where("registered IS NOT NULL"), "discovery-identity", F.col("key") != F.col("identity"), "id", F.col("key")), duplicates(discoveries, "discovery-twice", "id"),
    ])


def same_rows(a: DataFrame, b: DataFrame, rule: str, key: str) -> DataFrame:
    """Rows of one table that the other lacks, both ways, repeated rows counted."""
    one = a.exceptAll(b).select(F.lit(rule).alias("rule_id"), F.col(key).cast("string").alias("object_id"), F.lit("only in the first").alias("message"))
    return one.unionByName(b.exceptAll(a).select(F.lit(rule).alias("rule_id"), F.col(key).cast("string").alias("object_id"), F.lit("only in the second").alias("message")))


def metric_rules(discoveries: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Each metric of (object_id, metrics) has a known key and exactly one kind of value."""
    m = discoveries.select("object_id", F.explode("metrics").alias("m"))
    return violations(m, "metric-key", ~F.col("m.key").isin(*keys), "object_id", F.col("m.key")).unionByName(violations(m, "metric-value", F.col("m.value").isNull() == F.col("m.value_bool").isNull(), "object_id", F.col("m.key")))


def raster_rules(published: DataFrame, model: DataFrame) -> DataFrame:
    """Decoded pixels (patch_id, prow, pcol, decoded, scale) against the model's values: the same coverage, within half a
    level, and no constant raster."""
    key = ["patch_id", "prow", "pcol"]
    both = published.join(model.where("covered").select(*key, "value"), key, "full_outer")
    off = violations(both, "raster-value", F.abs(F.col("decoded") - F.col("value")) > F.col("scale") / 2 + 1e-12, "patch_id", F.concat_ws(",", "prow", "pcol"))
    flat = published.groupBy("patch_id").agg(F.stddev_pop("decoded").alias("s"))
    return off.unionByName(violations(flat, "raster-constant", F.col("s") <= 0, "patch_id"))


def display_rules(display: DataFrame, decoded: DataFrame, scale: str = "scale") -> DataFrame:
    """Display rasters (patch_id, prow, pcol, red, green, blue, alpha) against decoded ones (patch_id, prow, pcol, decoded, scale) of covered
    pixels, one violation for each patch and rule: alpha is 0 or 255 and says what is covered, colours are gray, and gray is the value
    clipped to 0 and 1 within one level and the encoding's step; a raster covers something. One pass over both tables."""
    key = ["patch_id", "prow", "pcol"]
    both = display.join(decoded.select(*key, "decoded", scale), key, "full_outer")
    gray = F.rint(F.least(F.greatest("decoded", F.lit(0.0)), F.lit(1.0)) * 255)
    seen, covered = F.coalesce(F.col("alpha") == 255, F.lit(False)), F.col("decoded").isNotNull()
    faults = {"alpha": F.col("alpha").isNotNull() & ~F.col("alpha").isin(0, 255), "coverage": seen != covered, "gray": F.col("red").isNotNull() & ((F.col("red") != F.col("green")) | (F.col("green") != F.col("blue"))),
              "clip": covered & F.col("red").isNotNull() & (F.abs(F.col("red") - gray) > 1 + 255 * F.col(scale))}
    per = both.groupBy("patch_id").agg(F.count_if(covered).alias("covered"), *[F.count_if(F.coalesce(x, F.lit(True))).alias(n) for n, x in faults.items()])
    return checked(per, "patch_id", ("display-empty", F.col("covered") == 0), *[(f"display-{n}", F.col(n) > 0, F.col(n)) for n in faults])


def mosaic_value_rules(patches: DataFrame, mosaic: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole")) -> DataFrame:
    """Decoded pixels of patches (patch_id, mrow, mcol, decoded, scale; a null is not covered) against their mosaic's (mrow, mcol, decoded, scale) at
    the same places: what is covered, and values within half of both steps. One violation for each patch and rule."""
    m = mosaic.select(*by, "mrow", "mcol", F.col("decoded").alias("_value"), F.col("scale").alias("_scale"))
    both = patches.join(m, [*by, "mrow", "mcol"], "left")
    differs = F.abs(F.col("decoded") - F.col("_value")) > (F.col("scale") + F.col("_scale")) / 2 + 1e-9
    per = both.groupBy("patch_id").agg(F.count_if(F.col("decoded").isNull() != F.col("_value").isNull()).alias("coverage"), F.count_if(differs).alias("value"))
    return checked(per, "patch_id", ("mosaic-coverage", F.col("coverage") > 0, F.col("coverage")), ("mosaic-value", F.col("value") > 0, F.col("value")))


def build_summary(**counts: DataFrame) -> DataFrame:
    """One row of the counts of a build's tables."""
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, each).groupBy().pivot("name", list(counts)).agg(F.first("n"))


def count_rules(published: DataFrame, counted: DataFrame, rule: str, key: str) -> DataFrame:
    """Published counts per key against counted ones, column by column: counts that differ, keys that one side lacks."""
    names = [c for c in published.columns if c != key]
    real = counted.select(key, F.lit(True).alias("_real"), *[F.col(c).alias(f"_{c}") for c in names])
    both = published.withColumn("_shown", F.lit(True)).join(real, key, "full_outer")
    shown, known = F.col("_shown").isNotNull(), F.col("_real").isNotNull()
    return checked(both, key, (f"{rule}-unpublished", ~shown), (f"{rule}-unknown", ~known),
                   *[(f"{rule}-count", shown & known & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in names])


def geolocation_rules(tiles: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Published centre (lat, lon) and corners (lats, lons; clockwise from the upper left) of tiles against what their
    projection and grid give. Each row is judged by itself."""
    truth = proximity.with_corners(tiles.withColumnsRenamed({"lats": "p_lats", "lons": "p_lons"}))
    half = F.col("width") / 2
    lat, lon = geo.pixel_to_lonlat(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), half, half)
    near = lambda a, b, c, d: (F.abs(a - c) <= tolerance) & (F.abs(geo.wrap(b - d)) <= tolerance)
    return checked(truth, "tile_id", ("geolocation-center", ~near(F.col("lat"), F.col("lon"), lat, lon)),
                   *[("geolocation-corner", ~near(F.get("p_lats", F.lit(k)), F.get("p_lons", F.lit(k)), F.get("lats", F.lit(k)), F.get("lons", F.lit(k))), F.lit(k)) for k in range(4)])


def containment_rules(craters: DataFrame, tiles: DataFrame, margin: float = 0.2) -> DataFrame:
    """Craters (tile_id, idx, lat, lon) beyond the bounds of their tile's corners by more than ``margin`` degrees, or without a tile."""
    corners = proximity.with_corners(tiles).select("tile_id", "lats", "lons")
    return checked(craters.join(corners, "tile_id", "left"), "tile_id", ("crater-outside", ~proximity.in_bounds(margin), F.col("idx")))


def ice_rules(published: DataFrame, pixels: DataFrame, margin: int, formula: str = "ice-p90-bounded-v2", tolerance: float = 1e-6) -> DataFrame:
    """Published sector records (those of ``raster.sector_records`` with pole, lat, name and formula) against their pixels.

    Pole, latitude, name and formula agree; statistics, clipped and covered pixels, peak and anchor are recomputed. A sector
    without a covered pixel is one violation (ice-raster). An anchor nearer to the valid edge than ``margin`` is not the
    recomputed one.
    """
    fields = ("min", "max", "covered_pixels", "clipped_pixels", "rmse", "mae", "peak", "anchor")
    truth = raster.sector_records(pixels, margin).select("patch_id", *[F.col(c).alias(f"_{c}") for c in fields])
    both = published.join(truth, "patch_id", "left")
    known, south = F.col("_max").isNotNull(), F.col("pole") == "south"
    off = lambda c: known & F.coalesce(F.abs(F.col(c) - F.col(f"_{c}")) > tolerance, F.lit(True))
    moved = lambda c: (F.col(f"{c}.prow") != F.col(f"_{c}.prow")) | (F.col(f"{c}.pcol") != F.col(f"_{c}.pcol")) | (F.abs(F.col(f"{c}.value") - F.col(f"_{c}.value")) > tolerance)
    return checked(
        both, "patch_id", ("ice-pole", ((F.col("lat") < 0) != south) | (F.abs("lat") < 75)), ("ice-name", F.col("name").endswith("_S_80S") != south),
        ("ice-formula", F.col("formula") != formula), ("ice-errors", (F.col("rmse") < 0) | (F.col("mae") < 0)), ("ice-raster", ~known),
        ("ice-statistics", off("min") | off("max")), ("ice-clipped", known & ~F.col("clipped_pixels").eqNullSafe(F.col("_clipped_pixels"))),
        ("ice-covered", known & ~F.col("covered_pixels").eqNullSafe(F.col("_covered_pixels"))), ("ice-peak", known & F.coalesce(moved("peak"), F.lit(True))),
        ("ice-anchor-presence", known & (F.col("anchor").isNull() != F.col("_anchor").isNull())),
        ("ice-anchor", F.col("anchor").isNotNull() & F.col("_anchor").isNotNull() & F.coalesce(moved("anchor"), F.lit(True))))


#: Fixed value: how an anchor is chosen.
ANCHOR_METHOD = "edge-safe-max-v1"


def ice_place_rules(published: DataFrame, pixels: DataFrame, margin: int, method: str = ANCHOR_METHOD, tolerance_deg: float = 1e-6) -> DataFrame:
    """What published sectors say of their place, against their pixels: records (patch_id, id, pole, projection columns, x_min, y_max, px,
    peak, anchor) whose peak and anchor are (prow, pcol, edge_distance, lat, lon), the anchor with method and edge_margin too.

    The projection's pole and the id's prefix are the sector's; coordinates are in range and those of the pixel's centre; edge
    distances are the exact ones; the anchor was chosen by ``method``, by this margin, and lies no nearer to the edge.
    """
    exact = raster.edge_distance(pixels).select("patch_id", "prow", "pcol", "edge_distance").where("edge_distance IS NOT NULL")
    south, rows = F.col("pole") == "south", published
    for part in ("peak", "anchor"):
        there = exact.select("patch_id", F.col("prow").alias(f"_{part}_row"), F.col("pcol").alias(f"_{part}_col"), F.col("edge_distance").alias(f"_{part}_edge"))
        rows = rows.withColumns({f"_{part}_row": F.col(f"{part}.prow"), f"_{part}_col": F.col(f"{part}.pcol")}).join(there, ["patch_id", f"_{part}_row", f"_{part}_col"], "left")
    checks = [("ice-projection-pole", (F.col("lat0") < 0) != south), ("ice-id", ~F.startswith("id", F.concat(F.lit("ice-"), F.substring("pole", 1, 1), F.lit("-"))))]
    has = F.col("anchor").isNotNull()
    checks.append(("ice-anchor-method", has & F.coalesce((F.col("anchor.method") != method) | (F.col("anchor.edge_margin") != margin) | (F.col("anchor.edge_distance") < F.col("anchor.edge_margin")), F.lit(True))))
    for part in ("peak", "anchor"):
        c = lambda x: F.col(f"{part}.{x}")  # noqa: E731,B023
        lat, lon = geo.pixel_to_lonlat(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), c("pcol") + 0.5, c("prow") + 0.5)
        off = (F.abs(lat - c("lat")) > tolerance_deg) | (F.abs(geo.wrap(lon - c("lon"))) > tolerance_deg)
        there = F.lit(True) if part == "peak" else has
        checks += [(f"ice-{part}-range", there & F.coalesce(~(c("lat").between(-90, 90) & (c("lon") >= -180) & (c("lon") < 180)), F.lit(True))), (f"ice-{part}-coordinate", there & F.coalesce(off, F.lit(True))),
                   (f"ice-{part}-edge", there & ~c("edge_distance").eqNullSafe(F.col(f"_{part}_edge")))]
    return checked(rows, "patch_id", *checks)


def mosaic_rules(placements: DataFrame, sectors: DataFrame, mosaics: DataFrame, tolerance_m: float = 0.01) -> DataFrame:
    """Placements (mosaic_id, patch_id, row, col, height, width) of sectors (patch_id, pole, projection, x_min, y_max) in mosaics
    (mosaic_id, pole, projection, x_min, y_max, px, height, width): each sector once, all of one pole and projection, at its
    place on the grid, inside. Values and coverage are compared by ``raster.patch_vs_mosaic``'s query."""
    times = placements.groupBy("patch_id").agg(F.count("*").alias("n"))
    once = checked(sectors.select("patch_id").join(times, "patch_id", "left").fillna(0, ["n"]), "patch_id", ("mosaic-placement", F.col("n") != 1, F.col("n")))
    s = sectors.select("patch_id", F.col("pole").alias("s_pole"), F.col("projection").alias("s_projection"), F.col("x_min").alias("s_x"), F.col("y_max").alias("s_y"))
    m = mosaics.select("mosaic_id", "pole", "projection", "x_min", "y_max", "px", F.col("height").alias("m_height"), F.col("width").alias("m_width"))
    both = placements.join(s, "patch_id", "left").join(m, "mosaic_id", "left")
    member, found = F.col("s_pole").isNotNull(), F.col("pole").isNotNull()
    known = member & found
    far = lambda a, b: F.abs(a - b) >= tolerance_m
    wrong = lambda c: known & F.coalesce(c, F.lit(True))
    return once.unionByName(checked(
        both, "patch_id", ("mosaic-member", ~member, F.col("mosaic_id")), ("mosaic-unknown", ~found, F.col("mosaic_id")),
        ("mosaic-pole", wrong(F.col("s_pole") != F.col("pole")), F.col("mosaic_id")), ("mosaic-projection", wrong(F.col("s_projection") != F.col("projection")), F.col("mosaic_id")),
        ("mosaic-position", wrong(far(F.col("s_x"), F.col("x_min") + F.col("col") * F.col("px")) | far(F.col("s_y"), F.col("y_max") - F.col("row") * F.col("px"))), F.col("mosaic_id")),
        ("mosaic-outside", wrong((F.col("col") + F.col("width") > F.col("m_width")) | (F.col("row") + F.col("height") > F.col("m_height"))), F.col("mosaic_id"))))
