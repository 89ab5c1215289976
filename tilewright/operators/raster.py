"""Rasters as pixel tables (patch_id, prow, pcol, value, covered, ...): statistics, edges, anchors, mosaics, encodings.

Windows are partitioned by a patch's row or column, never by a whole table, so a patch of any count of pixels spreads over
tasks and the number of patches is free.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.functions import geo

PATCH = ("patch_id",)
LEVELS = 65535


def finite(*layers: str) -> Column:
    """Whether all layers of a pixel have a number."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in layers])


def coverage(pixels: DataFrame, *layers: str) -> DataFrame:
    return pixels.withColumn("covered", finite(*layers))


def stats(pixels: DataFrame, by: tuple[str, ...] = PATCH, value: str = "value") -> DataFrame:
    """Minimum, maximum, mean, percentiles (linear interpolation), pixels beyond 0 and 1, of covered pixels."""
    v = F.col(value)
    rows = pixels.where("covered").groupBy(*by).agg(
        F.count("*").alias("covered_pixels"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.percentile(v, F.array(*[F.lit(q) for q in (0.5, 0.9, 0.95, 0.99)])).alias("q"), F.count_if(v < 0).alias("below0"), F.count_if(v > 1).alias("above1"))
    out = rows.select(*by, "covered_pixels", "min", "max", "mean", *(F.col("q")[i].alias(n) for i, n in enumerate(("median", "p90", "p95", "p99"))), "below0", "above1")
    return out.withColumn("clipped_percent", 100 * (F.col("below0") + F.col("above1")) / F.col("covered_pixels"))


def errors(pixels: DataFrame, by: tuple[str, ...] = PATCH) -> DataFrame:
    """Root mean square and mean absolute error against the reference where both have values; null where none do."""
    e = F.when(F.col("covered") & F.col("ref_covered"), F.col("value") - F.col("ref_value"))
    return pixels.groupBy(*by).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.count(e).alias("n"))


def eroded(pixels: DataFrame, k: int) -> DataFrame:
    """``pixels`` with ``deep``: covered, and so is every pixel within k rows and columns, none of them beyond the patch."""
    if k == 0:
        return pixels.withColumn("deep", F.col("covered"))
    on = F.col("covered").cast("int")
    across = Window.partitionBy("patch_id", "prow").orderBy("pcol").rowsBetween(-k, k)
    down = Window.partitionBy("patch_id", "pcol").orderBy("prow").rowsBetween(-k, k)
    rows = pixels.withColumn("_r", F.when(F.count("*").over(across) == 2 * k + 1, F.min(on).over(across)).otherwise(0))
    return rows.withColumn("deep", F.when(F.count("*").over(down) == 2 * k + 1, F.min("_r").over(down)).otherwise(0) == 1).drop("_r")


def edge_distance(pixels: DataFrame, most: int | None = None) -> DataFrame:
    """``pixels`` with ``edge_distance``: of a covered pixel the chessboard distance to the valid edge (0 on it), else null.

    What lies beyond a patch's rows and columns counts as uncovered, and so does a null. With ``most``, larger distances are given as
    that. Two passes, whatever the distances are: the nearest uncovered pixel of the row by running windows; then each column is an
    array of those, and a pixel's distance is the least k such that within k rows one of them is at most k. Minima over 1, 2, 4, ...
    rows answer that for any k, and k is found by halving: a column of n pixels costs n log n.
    """
    pixels = pixels.drop("edge_distance")
    on = F.coalesce("covered", F.lit(False))
    row = Window.partitionBy("patch_id", "prow")
    before = F.max(F.when(~on, F.col("pcol"))).over(row.orderBy("pcol").rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(~on, F.col("pcol"))).over(row.orderBy("pcol").rowsBetween(0, Window.unboundedFollowing))
    near = F.least(F.col("pcol") - F.coalesce(before, F.min("pcol").over(row) - 1), F.coalesce(after, F.max("pcol").over(row) + 1) - F.col("pcol"))
    rows = pixels.withColumn("_near", near.cast("int"))
    held = F.sort_array(F.collect_list(F.struct("prow", "_near", F.struct(*[c for c in pixels.columns if c not in ("patch_id", "pcol", "prow")]).alias("_rest"))))
    columns = rows.groupBy("patch_id", "pcol").agg(held.alias("_held"))
    placed = columns.select("patch_id", "pcol", F.inline(_with_distances(F.col("_held"))))
    found = F.col("_d") - 1
    found = F.when(F.col("_rest.covered"), found if most is None else F.least(found, F.lit(most)))
    kept = [F.col(c) if c in ("patch_id", "pcol", "prow") else F.col(f"_rest.{c}").alias(c) for c in pixels.columns]
    return placed.select(*kept, found.alias("edge_distance"))


def _with_distances(held: Column) -> Column:
    """A column's pixels (prow, _near, _rest) with ``_d``: the distance to the nearest uncovered pixel or outside."""
    zero = F.lit(0)
    line = F.concat(F.array(zero), F.transform(held, lambda x: x["_near"]), F.array(zero))
    log = lambda n: F.length(F.bin(n.cast("long"))) - 1
    pow2 = lambda j: F.call_function("shiftleft", F.lit(1), j)

    def minima(g: Column) -> Column:
        """Of each place the minimum over 1, 2, 4, ... values from there on."""
        step = lambda t, j: F.concat(t, F.array(F.transform(F.sequence(zero, F.size(g) - pow2(j)), lambda i: F.least(F.get(F.get(t, j - 1), i), F.get(F.get(t, j - 1), i + pow2(j - 1))))))
        return F.aggregate(F.sequence(F.lit(1), log(F.size(g))), F.array(g), step)

    def least(t: Column, a: Column, b: Column) -> Column:
        j = log(b - a + 1)
        return F.least(F.get(F.get(t, j), a), F.get(F.get(t, j), b - pow2(j) + 1))

    def distance(g: Column, t: Column, i: Column) -> Column:
        """The least k for the pixel at place i: halving between 0 and its own row's distance."""
        most = F.least(F.get(g, i), i, F.size(g) - 1 - i)
        halve = lambda s, _: F.transform(F.array(F.floor((s["a"] + s["b"]) / 2).cast("int")), lambda k: F.when(least(t, i - k, i + k) <= k, F.struct(s["a"].alias("a"), k.alias("b"))).otherwise(F.struct(F.least(k + 1, s["b"]).alias("a"), s["b"].alias("b"))))[0]
        return F.aggregate(F.sequence(F.lit(0), log(F.size(g))), F.struct(zero.alias("a"), most.alias("b")), halve)["a"]

    # arrays of one bind what is used more than once
    known = F.transform(F.array(line), lambda g: F.struct(g.alias("g"), minima(g).alias("t")))
    return F.get(F.transform(known, lambda s: F.transform(held, lambda x, i: F.struct(x["prow"].alias("prow"), x["_rest"].alias("_rest"), distance(s["g"], s["t"], i + 1).alias("_d")))), F.lit(0))


def peak(pixels: DataFrame, eligible: str = "covered", by: tuple[str, ...] = PATCH) -> DataFrame:
    """The largest eligible value of each patch and its place, row-major first among equals; patches without any are missing."""
    at = F.min_by(F.struct("value", "prow", "pcol"), F.struct(-F.col("value"), "prow", "pcol"))
    return pixels.where(eligible).groupBy(*by).agg(at.alias("p")).select(*by, "p.value", "p.prow", "p.pcol")


def anchors(pixels: DataFrame, margin: int) -> DataFrame:
    """The peak among pixels at least ``margin`` pixels from the valid edge; null columns where a patch has none."""
    found = peak(eroded(pixels, margin), "deep")
    return pixels.select("patch_id").distinct().join(found, "patch_id", "left")


def at_anchor(anchor: DataFrame, pixels: DataFrame, *layers: str) -> DataFrame:
    """The layers' values at each anchor."""
    return anchor.join(pixels.select("patch_id", "prow", "pcol", *layers), ["patch_id", "prow", "pcol"], "left")


def edge_rings(pixels: DataFrame, rings: list[tuple[int, int]]) -> DataFrame:
    """Per ring of edge distances: share of pixels, enrichment of values beyond 0 and 1, error ratio to the whole."""
    spark = pixels.sparkSession
    rows = edge_distance(pixels)
    ring = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(rings)], "ring int, low int, high int")
    e = F.when(F.col("ref_covered"), F.abs(F.col("value") - F.col("ref_value")))
    per = rows.where("covered").join(F.broadcast(ring), (F.col("edge_distance") >= F.col("low")) & (F.col("edge_distance") < F.col("high")))
    per = per.groupBy("ring", "low").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 1).alias("a"), F.count_if(F.col("value") < 0).alias("b"), F.sum(e).alias("e"), F.count(e).alias("m"))
    total = per.agg(F.sum("n").alias("tn"), F.sum("a").alias("ta"), F.sum("b").alias("tb"), F.sum("e").alias("te"), F.sum("m").alias("tm"))
    rows = per.crossJoin(F.broadcast(total))
    share = F.col("n") / F.col("tn")
    return rows.select("ring", "low", "n", share.alias("share"), (F.col("a") / F.greatest("ta", F.lit(1)) / share).alias("above1_enrichment"), (F.col("b") / F.greatest("tb", F.lit(1)) / share).alias("below0_enrichment"),
                       ((F.col("e") / F.col("m")) / (F.col("te") / F.col("tm"))).alias("mae_ratio"))


def anchor_sensitivity(pixels: DataFrame, margins: list[int]) -> DataFrame:
    """(patch_id, margin, value, delta_value, shift_px, edge_distance, shift_km) for each margin, against the first one; null where a
    patch has no pixel so far from the edge. ``shift_km`` follows where pixels have ``lat`` and ``lon``. One pass over the pixels.
    """
    rows = edge_distance(pixels)
    more = [c for c in ("lat", "lon") if c in pixels.columns]
    at = F.struct("value", "prow", "pcol", "edge_distance", *more)
    order = F.struct(-F.col("value"), "prow", "pcol")
    picks = rows.groupBy("patch_id").agg(*[F.min_by(F.when(F.col("edge_distance") >= m, at), F.when(F.col("edge_distance") >= m, order)).alias(f"m{i}") for i, m in enumerate(margins)])
    each = picks.select("patch_id", F.col("m0").alias("b"), F.inline(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(f"m{i}").alias("p")) for i, m in enumerate(margins)])))
    shift = F.hypot(F.col("p.prow") - F.col("b.prow"), F.col("p.pcol") - F.col("b.pcol"))
    km = geo.distance_m(F.col("b.lat"), F.col("b.lon"), F.col("p.lat"), F.col("p.lon")) / 1000 if len(more) == 2 else None
    return each.select("patch_id", "margin", "p.value", (F.col("p.value") - F.col("b.value")).alias("delta_value"), shift.alias("shift_px"), "p.edge_distance", *([km.alias("shift_km")] if km is not None else []))


def sensitivity_summary(rows: DataFrame) -> DataFrame:
    """Per margin: patches, moved ones, patches without an eligible pixel, largest and median moves."""
    moved = F.col("shift_px") > 0
    return rows.groupBy("margin").agg(F.count("value").alias("patches"), F.count_if(moved).alias("moved"), F.count_if(F.col("value").isNull()).alias("without"), F.max(F.abs("delta_value")).alias("max_delta"),
                                      F.coalesce(F.percentile(F.when(moved, F.abs("delta_value")), 0.5), F.lit(0.0)).alias("median_delta"), F.max("shift_px").alias("max_shift"))


# --- encodings --------------------------------------------------------------------------------------------------------


def quantized(pixels: DataFrame) -> DataFrame:
    """Covered pixels with ``level`` of the patch's 16-bit linear encoding, its bytes, ``offset``, ``scale`` and ``decoded``."""
    range_ = pixels.where("covered").groupBy("patch_id").agg(F.min("value").alias("offset"), F.max("value").alias("top"))
    range_ = range_.select("patch_id", "offset", F.when(F.col("top") > F.col("offset"), (F.col("top") - F.col("offset")) / LEVELS).otherwise(1.0).alias("scale"))
    rows = pixels.where("covered").join(range_, "patch_id").withColumn("level", F.rint((F.col("value") - F.col("offset")) / F.col("scale")).cast("int"))
    return rows.withColumns({"high": F.shiftright("level", 8), "low": F.col("level").bitwiseAND(F.lit(255)), "decoded": F.col("offset") + F.col("scale") * F.col("level")})


def display_level(value: Column) -> Column:
    return F.rint(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")


def stretched(pixels: DataFrame, low: float = 0.005, high: float = 0.995) -> DataFrame:
    """Covered pixels with ``gray``: the value between two percentiles of its patch, as a level of 255."""
    range_ = pixels.where("covered").groupBy("patch_id").agg(F.percentile("value", F.array(F.lit(low), F.lit(high))).alias("q")).select("patch_id", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    x = (F.col("value") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-12))
    return pixels.where("covered").join(range_, "patch_id").withColumn("gray", display_level(x))


# --- mosaics ----------------------------------------------------------------------------------------------------------


def mosaic_extent(patches: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole")) -> DataFrame:
    """Rows and columns of each mosaic, from (row0, col0, height, width) of its patches, and how many patches it has."""
    out = patches.groupBy(*by).agg(F.min("row0").alias("min_row"), F.min("col0").alias("min_col"), F.max(F.col("row0") + F.col("height")).alias("end_row"), F.max(F.col("col0") + F.col("width")).alias("end_col"), F.count("*").alias("patches"))
    return out.select(*by, "min_row", "min_col", (F.col("end_row") - F.col("min_row")).alias("height"), (F.col("end_col") - F.col("min_col")).alias("width"), "patches")


def off_grid(patches: DataFrame, x: str = "x_min", y: str = "y_max", px: str = "px", tolerance: float = 1e-6, by: tuple[str, ...] = ("mosaic_id",)) -> DataFrame:
    """Patches whose origin is not on their mosaic's pixel grid, or whose pixel size differs from the mosaic's."""
    base = patches.groupBy(*by).agg(F.min(x).alias("_x"), F.max(y).alias("_y"), F.min(px).alias("_px"))
    rows = patches.join(base, list(by))
    off = lambda d: F.abs(d - F.rint(d)) > tolerance
    return rows.where(off((F.col(x) - F.col("_x")) / F.col("_px")) | off((F.col("_y") - F.col(y)) / F.col("_px")) | (F.abs(F.col(px) - F.col("_px")) > tolerance)).drop("_x", "_y", "_px")


def placed(pixels: DataFrame, extent: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole"), size: int = 8) -> DataFrame:
    """Covered pixels with their row and column in the mosaic's grid."""
    rows = pixels.where("covered").join(extent.select(*by, "min_row", "min_col"), list(by))
    return rows.withColumns({"mrow": F.col("cell_row") * size + F.col("prow") - F.col("min_row"), "mcol": F.col("cell_col") * size + F.col("pcol") - F.col("min_col")}).drop("min_row", "min_col")


def overlaps(placed_pixels: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole")) -> DataFrame:
    """Mosaic pixels that several patches cover."""
    return placed_pixels.groupBy(*by, "mrow", "mcol").agg(F.count("*").alias("n"), F.min("patch_id").alias("first_patch")).where("n > 1")


def rectangle_overlaps(patches: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole"), cell: int = 64) -> DataFrame:
    """(a, b) of patches whose rectangles overlap: they meet in the cells of a coarse grid, and are told apart there."""
    cells = lambda lo, n: F.sequence(F.floor(F.col(lo) / cell), F.floor((F.col(lo) + F.col(n) - 1) / cell))
    rows = patches.withColumn("i", F.explode(cells("row0", "height"))).withColumn("j", F.explode(cells("col0", "width")))
    b = rows.select(*by, "i", "j", *(F.col(c).alias("b_" + c) for c in ("patch_id", "row0", "col0", "height", "width")))
    return rows.join(b, [*by, "i", "j"]).where("patch_id < b_patch_id AND row0 < b_row0 + b_height AND b_row0 < row0 + height AND col0 < b_col0 + b_width AND b_col0 < col0 + width").select(*by, F.col("patch_id").alias("a"), F.col("b_patch_id").alias("b")).distinct()


def window_mismatches(patch: DataFrame, mosaic: DataFrame, on: list[str]) -> DataFrame:
    """Per mosaic: pixels that only one side covers, the largest difference of values, display levels and rounded values that differ."""
    a = patch.select(*on, F.col("value").alias("a"))
    both = a.join(mosaic.select(*on, F.col("value").alias("b")), on, "full_outer")
    changed = lambda n: F.count_if(F.round("a", n) != F.round("b", n))
    return both.groupBy(*[c for c in on if c not in ("mrow", "mcol")]).agg(
        F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("coverage_mismatch"), F.count_if(display_level(F.col("a")) != display_level(F.col("b"))).alias("display_mismatch"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"), changed(3).alias("changed3"), changed(4).alias("changed4"))


def seams(pixels: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole"), size: int = 8) -> DataFrame:
    """(a, b, direction, seam, interior): neighbouring patches' mean difference across the seam, and just inside it."""
    last, inner = size - 1, size - 2
    out = []
    for name, dr, dc, along, across in (("east", 0, 1, "prow", "pcol"), ("south", 1, 0, "pcol", "prow")):
        edge = pixels.where("covered").where(F.col(across) == last).select(*by, F.col("patch_id").alias("a"), F.col("cell_row") + dr, F.col("cell_col") + dc, F.col(along).alias("k"), F.col("value").alias("edge"))
        edge = edge.toDF(*by, "a", "cell_row", "cell_col", "k", "edge")
        near = pixels.where("covered").where(F.col(across) == inner).select(F.col("patch_id").alias("a"), F.col(along).alias("k"), F.col("value").alias("inner"))
        next_ = pixels.where("covered").where(F.col(across) == 0).select(*by, "cell_row", "cell_col", F.col("patch_id").alias("b"), F.col(along).alias("k"), F.col("value").alias("far"))
        rows = edge.join(next_, [*by, "cell_row", "cell_col", "k"]).join(near, ["a", "k"])
        out.append(rows.groupBy("a", "b").agg(F.avg(F.abs(F.col("edge") - F.col("far"))).alias("seam"), F.avg(F.abs(F.col("edge") - F.col("inner"))).alias("interior"), F.count("*").alias("n")).withColumn("direction", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


def outside(pixels: DataFrame, patches: DataFrame, by: tuple[str, ...] = ("mosaic_id", "pole"), cell: int = 64) -> DataFrame:
    """Mosaic pixels (mrow, mcol) in no patch's rectangle: an anti join on the cells that rectangles reach into."""
    cells = lambda lo, n: F.sequence(F.floor(F.col(lo) / cell), F.floor((F.col(lo) + F.col(n) - 1) / cell))
    held = patches.withColumn("i", F.explode(cells("row0", "height"))).withColumn("j", F.explode(cells("col0", "width"))).select(*by, "i", "j", "row0", "col0", "height", "width")
    p = pixels.withColumns({"i": F.floor(F.col("mrow") / cell), "j": F.floor(F.col("mcol") / cell)})
    match = [p[c] == held[c] for c in (*by, "i", "j")] + [(p["mrow"] >= held["row0"]) & (p["mrow"] < held["row0"] + held["height"]) & (p["mcol"] >= held["col0"]) & (p["mcol"] < held["col0"] + held["width"])]
    return p.join(held, match, "left_anti").drop("i", "j")


# --- filters ----------------------------------------------------------------------------------------------------------


def block_mean(pixels: DataFrame, k: int, value: str = "value") -> DataFrame:
    """(patch_id, brow, bcol, mean) of k x k blocks."""
    return pixels.groupBy("patch_id", F.floor(F.col("prow") / k).cast("int").alias("brow"), F.floor(F.col("pcol") / k).cast("int").alias("bcol")).agg(F.avg(value).alias("mean"))


def high_pass(pixels: DataFrame, radius: int, size: int, value: str = "value") -> DataFrame:
    """(patch_id, prow, pcol, high): the value less the mean of the square around it, patches reflected at their borders."""
    r = F.lit(radius)

    def reflected(df: DataFrame, c: str) -> DataFrame:
        x = F.col(c)
        copies = F.array_compact(F.array(x, F.when(x.between(1, r), -x), F.when(x.between(size - 1 - r, size - 2), 2 * (size - 1) - x)))
        return df.withColumn(c, F.explode(copies))

    rows = reflected(pixels.select("patch_id", "prow", "pcol", F.col(value).alias("v")), "pcol")
    across = Window.partitionBy("patch_id", "prow").orderBy("pcol").rowsBetween(-radius, radius)
    rows = rows.withColumn("s", F.sum("v").over(across)).where(F.col("pcol").between(0, size - 1))
    rows = reflected(rows, "prow")
    down = Window.partitionBy("patch_id", "pcol").orderBy("prow").rowsBetween(-radius, radius)
    rows = rows.withColumn("t", F.sum("s").over(down)).where(F.col("prow").between(0, size - 1))
    return rows.select("patch_id", "prow", "pcol", (F.col("v") - F.col("t") / (2 * radius + 1) ** 2).alias("high"))


def dihedral(r: Column, c: Column, size: int) -> Column:
    """The eight places that a pixel moves to: array of (label, row, col)."""
    m = F.lit(size - 1)
    at = lambda name, a, b: F.struct(F.lit(name).alias("label"), a.cast("int").alias("row"), b.cast("int").alias("col"))
    return F.array(at("identity", r, c), at("rot90", m - c, r), at("rot180", m - r, m - c), at("rot270", c, m - r), at("flip-lr", r, m - c), at("flip-ud", m - r, c), at("transpose", c, r), at("anti-transpose", m - c, m - r))


def dihedral_correlation(pixels: DataFrame, size: int, a: str = "value", b: str = "ref_value") -> DataFrame:
    """(patch_id, label, r): correlation of ``a``, turned and mirrored in the eight ways, with ``b``."""
    moved = pixels.select("patch_id", F.explode(dihedral(F.col("prow"), F.col("pcol"), size)).alias("t"), F.col(a).alias("a")).select("patch_id", "t.label", F.col("t.row").alias("prow"), F.col("t.col").alias("pcol"), "a")
    both = moved.join(pixels.select("patch_id", "prow", "pcol", F.col(b).alias("b")), ["patch_id", "prow", "pcol"])
    return both.groupBy("patch_id", "label").agg(F.corr("a", "b").alias("r"))


def orientation_verdicts(scores: DataFrame, least: float = 0.1) -> DataFrame:
    """One row: patches checked, those whose identity is best, conclusive ones, conclusive contradictions."""
    per = scores.groupBy("patch_id").agg(F.max_by("label", F.struct("r", F.col("label") == "identity", F.col("label"))).alias("best"), F.max("r").alias("top"))
    return per.agg(F.count("*").alias("checked"), F.count_if(F.col("best") == "identity").alias("identity_best"), F.count_if(F.col("top") >= least).alias("conclusive"), F.count_if((F.col("top") >= least) & (F.col("best") != "identity")).alias("contradictions"))


def bilinear(raster: DataFrame, points: DataFrame, height: int, width: int) -> DataFrame:
    """(id, value): an equirectangular raster (row, col, v) sampled at points (id, lat, lon), wrapping in longitude."""
    col = (F.col("lon") + 180) / 360 * width - 0.5
    row = F.least(F.greatest((90 - F.col("lat")) / 180 * height - 0.5, F.lit(0.0)), F.lit(height - 1.001))
    at = points.withColumns({"_c": col, "_r": row}).withColumns({"fc": F.col("_c") - F.floor("_c"), "fr": F.col("_r") - F.floor("_r")})
    corner = lambda dr, dc, wgt: F.struct((F.floor("_r") + dr).cast("int").alias("row"), F.pmod(F.floor("_c") + dc, F.lit(width)).cast("int").alias("col"), wgt.alias("wgt"))
    fc, fr = F.col("fc"), F.col("fr")
    four = at.select("id", F.explode(F.array(corner(0, 0, (1 - fr) * (1 - fc)), corner(0, 1, (1 - fr) * fc), corner(1, 0, fr * (1 - fc)), corner(1, 1, fr * fc))).alias("n")).select("id", "n.*")
    return four.join(raster.select("row", "col", "v"), ["row", "col"]).groupBy("id").agg(F.sum(F.col("wgt") * F.col("v")).alias("value"))


def seeded_sample(pixels: DataFrame, n: int, seed: int) -> DataFrame:
    """At most n covered pixels of each patch: those with the smallest MD5 of seed, patch, row and column.

    The rank is limited to n, so each task keeps the n smallest of each patch that it reads, and only those are shuffled and ranked.
    """
    order = Window.partitionBy("patch_id").orderBy(F.md5(F.concat_ws("|", F.lit(seed), "patch_id", "prow", "pcol")), "prow", "pcol")
    return pixels.where("covered").withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).drop("_k")


def sample_errors(samples: DataFrame, mosaic: DataFrame, mosaic_prefix: str = "m_", by: tuple[str, ...] = ("mosaic_id", "pole")) -> DataFrame:
    """(patch_id, samples, position_px, geo_m, value_error, reference_error): the largest errors of each patch's sampled pixels.

    ``samples`` have their patch's projection and grid (``x_min``, ``y_max``, ``px``), those of the mosaic with the prefix, and the place
    ``row0``, ``col0`` that the patch has in it. A pixel's centre is taken to coordinates and into the mosaic's pixels: how far from
    its place it comes out, how far the centre of that mosaic pixel is, and by how much ``value`` and ``ref_value`` of ``mosaic``
    (``mrow``, ``mcol``) differ; where the mosaic has no value the error is infinite. A patch without reference has 0.
    """
    own, whole, m = geo.Projection(), geo.Projection(mosaic_prefix), mosaic_prefix
    lat, lon = geo.pixel_to_lonlat(own, F.col("x_min"), F.col("y_max"), F.col("px"), F.col("pcol") + 0.5, F.col("prow") + 0.5)
    rows = samples.withColumns({"_lat": lat, "_lon": lon})
    col, row = geo.lonlat_to_pixel(whole, F.col(m + "x_min"), F.col(m + "y_max"), F.col(m + "px"), F.col("_lat"), F.col("_lon"))
    rows = rows.withColumns({"_col": col, "_row": row}).withColumns({"mcol": F.floor("_col").cast("int"), "mrow": F.floor("_row").cast("int")})
    back_lat, back_lon = geo.pixel_to_lonlat(whole, F.col(m + "x_min"), F.col(m + "y_max"), F.col(m + "px"), F.col("mcol") + 0.5, F.col("mrow") + 0.5)
    shown = mosaic.select(*by, F.col("mrow").cast("int").alias("mrow"), F.col("mcol").cast("int").alias("mcol"), F.col("value").alias("_value"), F.col("ref_value").alias("_ref"))
    both = rows.join(shown, [*by, "mrow", "mcol"], "left")
    error = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)), F.lit(float("inf")))
    far = F.hypot(F.col("_col") - (F.col("col0") + F.col("pcol") + 0.5), F.col("_row") - (F.col("row0") + F.col("prow") + 0.5))
    return both.groupBy("patch_id").agg(F.count("*").alias("samples"), F.max(far).alias("position_px"), F.max(geo.distance_m(F.col("_lat"), F.col("_lon"), back_lat, back_lon)).alias("geo_m"),
                                        F.max(error("_value", "value")).alias("value_error"), F.coalesce(F.max(F.when(F.col("ref_covered"), error("_ref", "ref_value"))), F.lit(0.0)).alias("reference_error"))


def array_profile(arrays: DataFrame, by: tuple[str, ...], value: str) -> DataFrame:
    """Size, non-finite values, and minimum, maximum, mean and population deviation of the finite ones."""
    v = F.when(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value))
    return arrays.groupBy(*by).agg(F.count("*").alias("size"), F.count_if(v.isNull()).alias("non_finite"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))


# --- masks ------------------------------------------------------------------------------------------------------------


def segmented(pixels: DataFrame) -> DataFrame:
    """Pixels with the class of larger logit as ``mask`` and the softmax of class 1."""
    return pixels.withColumns({"mask": F.col("logit1") > F.col("logit0"), "softmax": 1 / (1 + F.exp(F.col("logit0") - F.col("logit1")))})


def mask_records(pixels: DataFrame, area_m2: float, by: tuple[str, ...] = PATCH) -> DataFrame:
    """Pixels, area, share of valid pixels, mean softmax, overlap with the reference and centroid of each mask.

    Mean and centroid are null for an empty mask, the overlap where mask and reference are empty on annotated pixels.
    """
    m, a, r = F.col("mask") & F.col("covered"), F.col("annotated"), F.col("reference")
    rows = pixels.groupBy(*by).agg(F.count_if(m).alias("pixels"), F.count_if("covered").alias("valid"), F.avg(F.when(m, F.col("softmax"))).alias("mean_softmax"), F.count_if(m & r & a).alias("both"), F.count_if((m | r) & a).alias("either"),
                                   F.avg(F.when(m, F.col("prow") + 0.5)).alias("row"), F.avg(F.when(m, F.col("pcol") + 0.5)).alias("col"))
    return rows.select(*by, "pixels", (F.col("pixels") * area_m2).alias("area_m2"), F.try_divide("pixels", "valid").alias("fraction"), "mean_softmax", F.try_divide("both", "either").alias("iou"), "row", "col")


def confusion(pixels: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """True and false positives and false negatives on annotated pixels, with IoU and F1."""
    p, r = F.col("mask"), F.col("reference")
    rows = pixels.where("annotated").groupBy(*by).agg(F.count_if(p & r).alias("tp"), F.count_if(p & ~r).alias("fp"), F.count_if(~p & r).alias("fn"))
    return rows.withColumns({"iou": F.try_divide("tp", F.col("tp") + F.col("fp") + F.col("fn")), "f1": F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})


def geolocated(tiles: DataFrame, pixels: DataFrame, row: str = "prow", col: str = "pcol") -> DataFrame:
    """Pixels (tile_id, row, col) with the latitude and longitude of their centres."""
    p = geo.Projection()
    rows = pixels.join(tiles, "tile_id")
    lat, lon = geo.pixel_to_lonlat(p, F.col("x_min"), F.col("y_max"), F.col("px"), F.col(col) + 0.5, F.col(row) + 0.5)
    return rows.withColumns({"lat": lat, "lon": lon})


# --- records ----------------------------------------------------------------------------------------------------------


def sector_records(pixels: DataFrame, margin: int, by: tuple[str, ...] = PATCH) -> DataFrame:
    """One record per patch with a covered pixel: statistics, clipped and covered pixels, errors, peak and anchor (value,
    prow, pcol). The anchor is null where no pixel is ``margin`` pixels from the valid edge; errors are null where no pixel
    has both values. Pixels are read once and reduced once."""
    v, e = F.when(F.col("covered"), F.col("value")), F.when(F.col("covered") & F.col("ref_covered"), F.col("value") - F.col("ref_value"))
    at = F.struct("value", "prow", "pcol")
    first = lambda c: F.min_by(at, F.when(F.col(c), F.struct(-F.col("value"), "prow", "pcol")))
    rows = eroded(pixels, margin).withColumn("deep", F.col("deep") & F.col("covered")).groupBy(*by).agg(
        F.count(v).alias("covered_pixels"), F.count_if((v < 0) | (v > 1)).alias("clipped_pixels"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"),
        F.percentile(v, F.lit(0.9)).alias("p90"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), first("covered").alias("peak"), first("deep").alias("anchor"))
    return rows.where("covered_pixels > 0")


def mask_regions(tiles: DataFrame, masks: DataFrame) -> DataFrame:
    """Mask records (tile_id, row, col, ...) with their tile's corners and the latitude and longitude of their centroid, null
    for empty masks."""
    rows = masks.join(tiles, "tile_id")
    lat, lon = geo.pixel_to_lonlat(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), F.col("col"), F.col("row"))
    return rows.withColumns({"lat": lat, "lon": lon})
