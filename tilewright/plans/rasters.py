"""Queries over pixel tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.functions import geo
from tilewright.operators import contract, proximity, raster
from tilewright.plans import sphere_sql as q
from tilewright.plans.registry import query
from tilewright.sources import fixtures as fx

PIX = fx.with_sql("pixel")
DEEP = "deep AS (SELECT p.*, (SELECT count_if(q.covered) FROM pixel q WHERE q.patch_id = p.patch_id AND abs(q.prow - p.prow) <= {k} AND abs(q.pcol - p.pcol) <= {k}) = {n} AS deep FROM pixel p)"


def _deep(k: int) -> str:
    return DEEP.format(k=k, n=(2 * k + 1) ** 2)


@query(f"""{PIX} SELECT patch_id, count(*) AS covered_pixels, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90,
round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, count_if(value < 0) AS below0, count_if(value > 1) AS above1, round(100e0 * (count_if(value < 0) + count_if(value > 1)) / count(*), 3) AS clipped_percent FROM pixel WHERE covered GROUP BY patch_id""")
def raster_stats(spark: SparkSession, d: str) -> DataFrame:
    s = raster.stats(fx.pixels(spark, d))
    return s.select("patch_id", "covered_pixels", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "median", "p90", "p95", "p99")), "below0", "above1", F.round("clipped_percent", 3).alias("clipped_percent"))


@query(f"{PIX}, e AS (SELECT patch_id, value - ref_value AS e FROM pixel WHERE covered AND ref_covered) SELECT patch_id, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, count(*) AS n FROM e GROUP BY patch_id")
def raster_error(spark: SparkSession, d: str) -> DataFrame:
    return raster.errors(fx.pixels(spark, d)).select("patch_id", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"), "n")


@query(f"{PIX} SELECT patch_id, round(value, 6) AS value, prow, pcol FROM (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, prow, pcol) AS k FROM pixel WHERE covered) WHERE k = 1")
def raster_peak(spark: SparkSession, d: str) -> DataFrame:
    return raster.peak(fx.pixels(spark, d)).select("patch_id", F.round("value", 6).alias("value"), "prow", "pcol")


@query(f"""{PIX}, {_deep(1)}, a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, prow, pcol) AS k FROM deep WHERE deep) WHERE k = 1)
SELECT i.patch_id, round(a.value, 6) AS value, a.prow, a.pcol, round(a.ref_value, 6) AS at_reference, a.ref_covered AS at_covered FROM (SELECT DISTINCT patch_id FROM pixel) i LEFT JOIN a ON a.patch_id = i.patch_id""")
def edge_safe_anchor(spark: SparkSession, d: str) -> DataFrame:
    p = fx.pixels(spark, d)
    a = raster.at_anchor(raster.anchors(p, 1), p, "ref_value", "ref_covered")
    return a.select("patch_id", F.round("value", 6).alias("value"), "prow", "pcol", F.round("ref_value", 6).alias("at_reference"), F.col("ref_covered").alias("at_covered"))


@query(f"""{PIX}, off AS (SELECT patch_id, prow, pcol FROM pixel WHERE NOT covered)
SELECT patch_id, prow, pcol, CASE WHEN covered THEN least(prow, pcol, 7 - prow, 7 - pcol, coalesce((SELECT min(greatest(abs(o.prow - p.prow), abs(o.pcol - p.pcol))) - 1 FROM off o WHERE o.patch_id = p.patch_id), 99)) END AS edge_distance FROM pixel p""")
def edge_distance(spark: SparkSession, d: str) -> DataFrame:
    return raster.edge_distance(fx.pixels(spark, d)).select("patch_id", "prow", "pcol", "edge_distance")


_RINGS = [(0, 1), (1, 2), (2, 3), (3, 10000)]


@query(f"""{PIX}, off AS (SELECT patch_id, prow, pcol FROM pixel WHERE NOT covered),
dist AS (SELECT *, least(prow, pcol, 7 - prow, 7 - pcol, coalesce((SELECT min(greatest(abs(o.prow - p.prow), abs(o.pcol - p.pcol))) - 1 FROM off o WHERE o.patch_id = p.patch_id), 99)) AS e FROM pixel p WHERE covered),
ring(ring, low, high) AS (VALUES {', '.join(str((i, a, b)) for i, (a, b) in enumerate(_RINGS))}),
per AS (SELECT ring, low, count(*) AS n, count_if(value > 1) AS a, count_if(value < 0) AS b, sum(CASE WHEN ref_covered THEN abs(value - ref_value) END) AS e, count_if(ref_covered) AS m FROM dist JOIN ring ON dist.e >= low AND dist.e < high GROUP BY ring, low)
SELECT ring, low, n, round(n / sum(n) OVER (), 6) AS share, round(a / greatest(sum(a) OVER (), 1) / (n / sum(n) OVER ()), 6) AS above1_enrichment, round(b / greatest(sum(b) OVER (), 1) / (n / sum(n) OVER ()), 6) AS below0_enrichment, round((e / m) / (sum(e) OVER () / sum(m) OVER ()), 6) AS mae_ratio FROM per""")
def edge_rings(spark: SparkSession, d: str) -> DataFrame:
    r = raster.edge_rings(fx.pixels(spark, d), _RINGS)
    return r.select("ring", "low", "n", *(F.round(c, 6).alias(c) for c in ("share", "above1_enrichment", "below0_enrichment", "mae_ratio")))


def _margins(margins: tuple[int, ...]) -> str:
    parts = [f"SELECT {m} AS margin, * FROM (SELECT patch_id, value, prow, pcol, row_number() OVER (PARTITION BY patch_id ORDER BY value DESC, prow, pcol) AS k FROM (WITH {_deep(m)} SELECT * FROM deep WHERE deep AND covered)) WHERE k = 1" for m in margins]
    return f"""picks AS ({' UNION ALL '.join(parts)}), grid AS (SELECT patch_id, margin FROM (SELECT DISTINCT patch_id FROM pixel), (SELECT unnest({list(margins)}) AS margin)),
sens AS (SELECT g.patch_id, g.margin, p.value, p.value - b.value AS delta_value, sqrt(pow(p.prow - b.prow, 2) + pow(p.pcol - b.pcol, 2)) AS shift_px FROM grid g LEFT JOIN picks p ON p.patch_id = g.patch_id AND p.margin = g.margin LEFT JOIN picks b ON b.patch_id = g.patch_id AND b.margin = {margins[0]})"""


@query(f"{PIX}, {_margins((0, 1, 2))} SELECT patch_id, margin, round(value, 6) AS value, round(delta_value, 6) AS delta_value, round(shift_px, 6) AS shift_px FROM sens")
def anchor_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    s = raster.anchor_sensitivity(fx.pixels(spark, d), [0, 1, 2])
    return s.select("patch_id", "margin", *(F.round(c, 6).alias(c) for c in ("value", "delta_value", "shift_px")))


def _located_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of 240 m on each pole's grid, with their coordinates."""
    p = fx.pixels(spark, d).withColumns({"kind": F.lit("ps"), "lat0": F.when(F.col("pole") == "south", -90.0).otherwise(90.0), "lon0": F.lit(0.0), "k0": F.lit(1.0), "fe": F.lit(0.0), "fn": F.lit(0.0)})
    lat, lon = geo.inverse(geo.Projection(), (F.col("cell_col") * 8 + F.col("pcol") + 0.5) * 240, -(F.col("cell_row") * 8 + F.col("prow") + 0.5) * 240)
    return p.withColumns({"lat": lat, "lon": lon})


_X, _Y = "((cell_col * 8 + pcol + 0.5e0) * 240)", "(-(cell_row * 8 + prow + 0.5e0) * 240)"


@query(f"""{PIX}, off AS (SELECT patch_id, prow, pcol FROM pixel WHERE NOT covered), grid AS (SELECT *, 'ps' AS kind, CASE WHEN pole = 'south' THEN -90e0 ELSE 90e0 END AS lat0, 0e0 AS lon0, 1e0 AS k0, 0e0 AS fe, 0e0 AS fn FROM pixel WHERE covered),
dist AS (SELECT *, {q.inverse(_X, _Y)[0]} AS lat, {q.inverse(_X, _Y)[1]} AS lon, least(prow, pcol, 7 - prow, 7 - pcol, coalesce((SELECT min(greatest(abs(o.prow - p.prow), abs(o.pcol - p.pcol))) - 1 FROM off o WHERE o.patch_id = p.patch_id), 99)) AS e FROM grid p),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patch_id, margin ORDER BY value DESC, prow, pcol) AS k FROM dist, (SELECT unnest([0, 1, 2, 3]) AS margin) WHERE e >= margin) WHERE k = 1),
every AS (SELECT patch_id, margin FROM (SELECT DISTINCT patch_id FROM pixel), (SELECT unnest([0, 1, 2, 3]) AS margin))
SELECT v.patch_id, v.margin, p.e AS edge_distance, round(p.value - b.value, 6) AS delta_value, round({q.distance('b.lat', 'b.lon', 'p.lat', 'p.lon')} / 1000, 6) AS shift_km FROM every v LEFT JOIN pick p ON p.patch_id = v.patch_id AND p.margin = v.margin LEFT JOIN pick b ON b.patch_id = v.patch_id AND b.margin = 0""")
def anchor_shifts(spark: SparkSession, d: str) -> DataFrame:
    s = raster.anchor_sensitivity(_located_pixels(spark, d), [0, 1, 2, 3])
    return s.select("patch_id", "margin", "edge_distance", F.round("delta_value", 6).alias("delta_value"), F.round("shift_km", 6).alias("shift_km"))


@query(f"""{PIX}, {_margins((0, 1, 2))} SELECT margin, count(value) AS patches, count_if(shift_px > 0) AS moved, count_if(value IS NULL) AS without, round(max(abs(delta_value)), 6) AS max_delta, round(coalesce(quantile_cont(CASE WHEN shift_px > 0 THEN abs(delta_value) END, 0.5), 0), 6) AS median_delta,
round(max(shift_px), 6) AS max_shift FROM sens GROUP BY margin""")
def sensitivity_summary(spark: SparkSession, d: str) -> DataFrame:
    s = raster.sensitivity_summary(raster.anchor_sensitivity(fx.pixels(spark, d), [0, 1, 2]))
    return s.select("margin", "patches", "moved", "without", *(F.round(c, 6).alias(c) for c in ("max_delta", "median_delta", "max_shift")))


QUANT = f"""{PIX}, r AS (SELECT patch_id, min(value) AS lo, max(value) AS hi FROM pixel WHERE covered GROUP BY patch_id), s AS (SELECT patch_id, lo, CASE WHEN hi > lo THEN (hi - lo) / 65535 ELSE 1e0 END AS scale FROM r),
l AS (SELECT p.patch_id, p.prow, p.pcol, p.value, s.lo, s.scale, CAST(round_even((p.value - s.lo) / s.scale, 0) AS INT) AS level FROM pixel p JOIN s ON s.patch_id = p.patch_id WHERE covered)"""


@query(QUANT + " SELECT patch_id, prow, pcol, level, level // 256 AS high, level % 256 AS low, round(lo + scale * level, 6) AS decoded, CAST(round_even(least(greatest(value, 0), 1) * 255, 0) AS INT) AS gray FROM l")
def quantize_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return raster.quantized(fx.pixels(spark, d)).select("patch_id", "prow", "pcol", "level", "high", "low", F.round("decoded", 6).alias("decoded"), raster.display_level(F.col("value")).alias("gray"))


@query(f"""{PIX}, r AS (SELECT patch_id, quantile_cont(value, 0.005) AS lo, quantile_cont(value, 0.995) AS hi FROM pixel WHERE covered GROUP BY patch_id)
SELECT p.patch_id, prow, pcol, CAST(round_even(least(greatest((value - lo) / greatest(hi - lo, 1e-12), 0), 1) * 255, 0) AS INT) AS gray FROM pixel p JOIN r ON r.patch_id = p.patch_id WHERE covered""")
def display_stretch(spark: SparkSession, d: str) -> DataFrame:
    return raster.stretched(fx.pixels(spark, d)).select("patch_id", "prow", "pcol", "gray")


PATCHES = "patches AS (SELECT DISTINCT patch_id, mosaic_id, pole, cell_row * 8 AS row0, cell_col * 8 AS col0 FROM pixel)"
EXTENT = "extent AS (SELECT mosaic_id, pole, min(row0) AS min_row, min(col0) AS min_col, max(row0) + 8 - min(row0) AS height, max(col0) + 8 - min(col0) AS width, count(*) AS patches FROM patches GROUP BY ALL)"


def _patches(spark: SparkSession, d: str, size: int = 8) -> DataFrame:
    p = fx.pixels(spark, d).select("patch_id", "mosaic_id", "pole", (F.col("cell_row") * 8).alias("row0"), (F.col("cell_col") * 8).alias("col0")).distinct()
    return p.withColumns({"height": F.lit(size), "width": F.lit(size)})


@query(f"{PIX}, {PATCHES}, {EXTENT} SELECT * FROM extent")
def mosaic_extent(spark: SparkSession, d: str) -> DataFrame:
    return raster.mosaic_extent(_patches(spark, d))


@query(f"{PIX}, {PATCHES} SELECT a.mosaic_id, a.pole, a.patch_id AS a, b.patch_id AS b FROM patches a JOIN patches b ON a.mosaic_id = b.mosaic_id AND a.pole = b.pole AND a.patch_id < b.patch_id AND abs(a.row0 - b.row0) < 9 AND abs(a.col0 - b.col0) < 9")
def mosaic_overlap(spark: SparkSession, d: str) -> DataFrame:
    return raster.rectangle_overlaps(_patches(spark, d, 9))


@query(f"""{PIX}, {PATCHES}, {EXTENT}, placed AS (SELECT p.*, p.cell_row * 8 + p.prow - e.min_row AS mrow, p.cell_col * 8 + p.pcol - e.min_col AS mcol FROM pixel p JOIN extent e ON e.mosaic_id = p.mosaic_id AND e.pole = p.pole WHERE covered)
SELECT mosaic_id, pole, mrow, mcol, patch_id, round(value, 6) AS value FROM placed""")
def mosaic_compose(spark: SparkSession, d: str) -> DataFrame:
    return raster.placed(fx.pixels(spark, d), raster.mosaic_extent(_patches(spark, d))).select("mosaic_id", "pole", "mrow", "mcol", "patch_id", F.round("value", 6).alias("value"))


@query(f"{PIX} SELECT mosaic_id, pole, cell_row * 8 + CAST(floor(prow / 2) AS INT) AS mrow, cell_col * 8 + pcol AS mcol, count(*) AS n, min(patch_id) AS first_patch FROM pixel WHERE covered GROUP BY ALL HAVING count(*) > 1")
def mosaic_pixel_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each patch are folded by two, so that pixels do overlap."""
    p = fx.pixels(spark, d).where("covered").withColumns({"mrow": F.col("cell_row") * 8 + F.floor(F.col("prow") / 2).cast("int"), "mcol": F.col("cell_col") * 8 + F.col("pcol")})
    return raster.overlaps(p)


@query(QUANT + """, a AS (SELECT patch_id, prow, pcol, value FROM l WHERE (patch_id + prow) % 11 <> 0), b AS (SELECT patch_id, prow, pcol, lo + scale * level AS value FROM l WHERE (patch_id + pcol) % 13 <> 0),
f AS (SELECT coalesce(a.patch_id, b.patch_id) AS patch_id, a.value AS a, b.value AS b FROM a FULL JOIN b ON a.patch_id = b.patch_id AND a.prow = b.prow AND a.pcol = b.pcol)
SELECT patch_id, count_if(a IS NULL OR b IS NULL) AS coverage_mismatch, count_if(round_even(least(greatest(a, 0), 1) * 255, 0) <> round_even(least(greatest(b, 0), 1) * 255, 0)) AS display_mismatch, round(max(abs(a - b)), 9) AS max_diff FROM f GROUP BY patch_id""")
def patch_vs_mosaic(spark: SparkSession, d: str) -> DataFrame:
    q = raster.quantized(fx.pixels(spark, d)).select("patch_id", F.col("prow").alias("mrow"), F.col("pcol").alias("mcol"), "value", "decoded")
    a, b = q.where("(patch_id + mrow) % 11 <> 0"), q.where("(patch_id + mcol) % 13 <> 0").withColumn("value", F.col("decoded"))
    return raster.window_mismatches(a, b, ["patch_id", "mrow", "mcol"]).select("patch_id", "coverage_mismatch", "display_mismatch", F.round("max_diff", 9).alias("max_diff"))


def _seam(direction: str, dr: int, dc: int, along: str, across: str) -> str:
    return f"""SELECT a.patch_id AS a, b.patch_id AS b, '{direction}' AS direction, round(avg(abs(a.value - b.value)), 6) AS seam, round(avg(abs(a.value - i.value)), 6) AS interior, count(*) AS n
FROM pixel a JOIN pixel b ON b.mosaic_id = a.mosaic_id AND b.pole = a.pole AND b.cell_row = a.cell_row + {dr} AND b.cell_col = a.cell_col + {dc} AND b.{along} = a.{along} AND b.{across} = 0 JOIN pixel i ON i.patch_id = a.patch_id AND i.{along} = a.{along} AND i.{across} = 6
WHERE a.{across} = 7 AND a.covered AND b.covered AND i.covered GROUP BY a.patch_id, b.patch_id"""


@query(f"{PIX} {_seam('east', 0, 1, 'prow', 'pcol')} UNION ALL {_seam('south', 1, 0, 'pcol', 'prow')}")
def seams(spark: SparkSession, d: str) -> DataFrame:
    return raster.seams(fx.pixels(spark, d)).select("a", "b", "direction", F.round("seam", 6).alias("seam"), F.round("interior", 6).alias("interior"), "n")


@query(f"{PIX}, {PATCHES}, kept AS (SELECT * FROM patches WHERE patch_id % 5 <> 0) SELECT mosaic_id, pole, patch_id, count(*) AS outside FROM pixel p WHERE covered AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.mosaic_id = p.mosaic_id AND k.pole = p.pole AND p.cell_row * 8 + p.prow BETWEEN k.row0 AND k.row0 + 7 AND p.cell_col * 8 + p.pcol BETWEEN k.col0 AND k.col0 + 7) GROUP BY ALL")
def mosaic_outside(spark: SparkSession, d: str) -> DataFrame:
    p = fx.pixels(spark, d).where("covered").withColumns({"mrow": F.col("cell_row") * 8 + F.col("prow"), "mcol": F.col("cell_col") * 8 + F.col("pcol")})
    out = raster.outside(p.select("mosaic_id", "pole", "patch_id", "mrow", "mcol"), _patches(spark, d).where("patch_id % 5 <> 0"))
    return out.groupBy("mosaic_id", "pole", "patch_id").agg(F.count("*").alias("outside"))


@query(f"{PIX} SELECT patch_id, CAST(floor(prow / 4) AS INT) AS brow, CAST(floor(pcol / 4) AS INT) AS bcol, round(avg(value), 6) AS mean FROM pixel GROUP BY ALL")
def block_mean(spark: SparkSession, d: str) -> DataFrame:
    return raster.block_mean(fx.pixels(spark, d), 4).select("patch_id", "brow", "bcol", F.round("mean", 6).alias("mean"))


@query(f"""{PIX}, o AS (SELECT unnest(range(-2, 3)) AS k), near AS (SELECT p.patch_id, p.prow, p.pcol, p.value, abs(p.prow + a.k) AS r, abs(p.pcol + b.k) AS c FROM pixel p, o a, o b),
refl AS (SELECT patch_id, prow, pcol, value, CASE WHEN r > 7 THEN 14 - r ELSE r END AS r, CASE WHEN c > 7 THEN 14 - c ELSE c END AS c FROM near)
SELECT n.patch_id, n.prow, n.pcol, round(n.value - sum(q.value) / 25, 6) AS high FROM refl n JOIN pixel q ON q.patch_id = n.patch_id AND q.prow = n.r AND q.pcol = n.c GROUP BY n.patch_id, n.prow, n.pcol, n.value""")
def high_pass(spark: SparkSession, d: str) -> DataFrame:
    return raster.high_pass(fx.pixels(spark, d), 2, 8).select("patch_id", "prow", "pcol", F.round("high", 6).alias("high"))


_TURNS = {"identity": ("prow", "pcol"), "rot90": ("7 - pcol", "prow"), "rot180": ("7 - prow", "7 - pcol"), "rot270": ("pcol", "7 - prow"), "flip-lr": ("prow", "7 - pcol"), "flip-ud": ("7 - prow", "pcol"), "transpose": ("pcol", "prow"), "anti-transpose": ("7 - pcol", "7 - prow")}
TURNED = f"turned AS ({' UNION ALL '.join(f'SELECT patch_id, {chr(39)}{k}{chr(39)} AS label, {r} AS r, {c} AS c, value AS a FROM pixel' for k, (r, c) in _TURNS.items())}), cors AS (SELECT t.patch_id, label, corr(a, q.ref_value) AS r FROM turned t JOIN pixel q ON q.patch_id = t.patch_id AND q.prow = t.r AND q.pcol = t.c GROUP BY ALL)"


@query(f"{PIX}, {TURNED} SELECT patch_id, label, round(r, 6) AS r FROM cors")
def dihedral_corr(spark: SparkSession, d: str) -> DataFrame:
    return raster.dihedral_correlation(fx.pixels(spark, d), 8).select("patch_id", "label", F.round("r", 6).alias("r"))


@query(f"""{PIX}, {TURNED}, per AS (SELECT patch_id, max(r) AS top, arg_max(label, r) AS best FROM cors GROUP BY patch_id)
SELECT count(*) AS checked, count_if(best = 'identity') AS identity_best, count_if(top >= 0.1) AS conclusive, count_if(top >= 0.1 AND best <> 'identity') AS contradictions FROM per""")
def orientation_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return raster.orientation_verdicts(raster.dihedral_correlation(fx.pixels(spark, d), 8))


@query(f"{PIX} SELECT pole, split, count(*) AS size, 0 AS non_finite, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM pixel GROUP BY ALL")
def array_profile(spark: SparkSession, d: str) -> DataFrame:
    return raster.array_profile(fx.pixels(spark, d), ("pole", "split"), "value").select("pole", "split", "size", "non_finite", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")))


MASKED = "m AS (SELECT *, logit1 > logit0 AS mask, 1 / (1 + exp(logit0 - logit1)) AS softmax FROM pixel)"


@query(f"""{PIX}, {MASKED} SELECT patch_id, count_if(mask AND covered) AS pixels, count_if(mask AND covered) * 0.25e0 AS area_m2, round(count_if(mask AND covered) / count_if(covered), 6) AS fraction, round(avg(CASE WHEN mask AND covered THEN softmax END), 6) AS mean_softmax,
round(count_if(mask AND covered AND reference AND annotated) / nullif(count_if(((mask AND covered) OR reference) AND annotated), 0), 6) AS iou, round(avg(CASE WHEN mask AND covered THEN prow + 0.5e0 END), 6) AS row, round(avg(CASE WHEN mask AND covered THEN pcol + 0.5e0 END), 6) AS col FROM m GROUP BY patch_id""")
def softmax_mask(spark: SparkSession, d: str) -> DataFrame:
    r = raster.mask_records(raster.segmented(fx.pixels(spark, d)), 0.25)
    return r.select("patch_id", "pixels", "area_m2", *(F.round(c, 6).alias(c) for c in ("fraction", "mean_softmax", "iou", "row", "col")))


@query(f"""{PIX}, {MASKED}, c AS (SELECT split, count_if(mask AND reference) AS tp, count_if(mask AND NOT reference) AS fp, count_if(NOT mask AND reference) AS fn FROM m WHERE annotated GROUP BY split) SELECT split, tp, fp, fn, round(tp / (tp + fp + fn), 6) AS iou, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def confusion_by_split(spark: SparkSession, d: str) -> DataFrame:
    return raster.confusion(raster.segmented(fx.pixels(spark, d))).select("split", "tp", "fp", "fn", F.round("iou", 6).alias("iou"), F.round("f1", 6).alias("f1"))


@query(f"""{PIX}, c AS (SELECT mosaic_id, pole, CAST(cell_row AS INT) AS r, CAST(cell_col AS INT) AS c, split FROM pixel WHERE prow = 0 AND pcol = 0),
g AS (SELECT mosaic_id, pole, r, c FROM (SELECT DISTINCT mosaic_id, pole FROM c), (SELECT unnest(range(16)) AS r), (SELECT unnest(range(16)) AS c))
SELECT g.mosaic_id, g.pole, g.r AS row, g.c AS col, CASE WHEN c.pole IS NULL THEN 'missing' WHEN c.split = 'validation' THEN 'unlisted' ELSE c.split END AS split FROM g LEFT JOIN c ON c.mosaic_id = g.mosaic_id AND c.pole = g.pole AND c.r = g.r AND c.c = g.c""")
def pole_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of every mosaic and pole."""
    p = fx.pixels(spark, d).where("prow = 0 AND pcol = 0")
    cells = p.select("patch_id", "mosaic_id", "pole", F.col("cell_row").cast("int").alias("row"), F.col("cell_col").cast("int").alias("col"))
    return proximity.cell_matrix(cells, p.where("split <> 'validation'").select("patch_id", "split"), 16, ("mosaic_id", "pole"))


@query(f"""{PIX}, {MASKED}, r AS (SELECT patch_id, count_if(mask AND covered) AS n, count_if(covered) AS valid, avg(CASE WHEN mask AND covered THEN prow + 0.5e0 END) AS row FROM m GROUP BY patch_id)
SELECT 'mask-pixels' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, concat_ws('/', n + 1, n) AS message FROM r WHERE patch_id % 17 = 0 UNION ALL SELECT 'mask-fraction', CAST(patch_id AS VARCHAR), '' FROM r WHERE patch_id % 19 = 0 AND valid > 0
UNION ALL SELECT 'mask-centroid', CAST(patch_id AS VARCHAR), '' FROM r WHERE patch_id % 23 = 0 AND row IS NOT NULL UNION ALL SELECT 'mask-area', CAST(patch_id AS VARCHAR), '' FROM r WHERE patch_id % 29 = 0
UNION ALL SELECT 'mask-fraction', CAST(patch_id AS VARCHAR), '' FROM r WHERE valid = 0""")
def mask_contract(spark: SparkSession, d: str) -> DataFrame:
    """Some counts, shares, areas and centroids are changed, so that the rules have something to find."""
    masks = raster.mask_records(raster.segmented(fx.pixels(spark, d)), 0.25)
    off = lambda n, new, c: F.when(F.col("patch_id") % n == 0, new).otherwise(F.col(c)).alias(c)
    shown = masks.select("patch_id", off(17, F.col("pixels") + 1, "pixels"), off(29, F.lit(-1.0), "area_m2"), off(19, F.col("fraction") + 1.5, "fraction"), "mean_softmax", "iou", off(23, F.col("row") + 100, "row"), "col")
    return contract.mask_rules(shown, masks)


@query(QUANT + ", pub AS (SELECT patch_id, prow, pcol, lo + scale * (level + CASE WHEN (patch_id + prow * 8 + pcol) % 97 = 0 THEN 2 ELSE 0 END) AS decoded, scale, value FROM l) SELECT 'raster-value' AS rule_id, CAST(patch_id AS VARCHAR) AS object_id, concat_ws(',', prow, pcol) AS message FROM pub WHERE abs(decoded - value) > scale / 2 + 1e-12")
def raster_contract(spark: SparkSession, d: str) -> DataFrame:
    """Some levels are moved by two, so that the rule has something to find."""
    p = fx.pixels(spark, d)
    moved = F.when((F.col("patch_id") + F.col("prow") * 8 + F.col("pcol")) % 97 == 0, 2).otherwise(0)
    published = raster.quantized(p).select("patch_id", "prow", "pcol", (F.col("offset") + F.col("scale") * (F.col("level") + moved)).alias("decoded"), "scale")
    return contract.raster_rules(published, p)


@query(f"""{fx.with_sql('tile', 'pixel')}, g AS (SELECT prow AS r, pcol AS c, avg(value) AS v FROM pixel WHERE covered GROUP BY ALL),
p AS (SELECT tile_id AS id, ((tile_id * 37) % 3600) / 10e0 - 180 AS lon, ((tile_id * 53) % 1800) / 10e0 - 90 AS lat FROM tile),
a AS (SELECT id, (lon + 180) / 360 * 8 - 0.5e0 AS c, least(greatest((90 - lat) / 180 * 8 - 0.5e0, 0e0), 6.999e0) AS r FROM p),
n AS (SELECT id, CAST(floor(r) AS INT) + dr AS r, ((CAST(floor(c) AS INT) + dc) % 8 + 8) % 8 AS c, (CASE dr WHEN 0 THEN 1 - (r - floor(r)) ELSE r - floor(r) END) * (CASE dc WHEN 0 THEN 1 - (c - floor(c)) ELSE c - floor(c) END) AS wgt FROM a, (SELECT unnest([0, 1]) AS dr), (SELECT unnest([0, 1]) AS dc))
SELECT id, round(sum(wgt * v), 6) AS value FROM n JOIN g ON g.r = n.r AND g.c = n.c GROUP BY id""")
def bilinear_sample(spark: SparkSession, d: str) -> DataFrame:
    grid = fx.pixels(spark, d).where("covered").groupBy(F.col("prow").alias("row"), F.col("pcol").alias("col")).agg(F.avg("value").alias("v"))
    k = F.col("tile_id")
    points = fx.tiles(spark, d).select(k.alias("id"), ((k * 37) % 3600 / 10.0 - 180).alias("lon"), ((k * 53) % 1800 / 10.0 - 90).alias("lat"))
    return raster.bilinear(grid, points, 8, 8).select("id", F.round("value", 6).alias("value"))


@query(f"""{fx.with_sql('tile')}, m AS (SELECT tile_id, kind AS mosaic_id, x_min + CASE WHEN tile_id % 17 = 0 THEN 30 ELSE 0 END AS x_min, y_max, px FROM tile), b AS (SELECT mosaic_id, min(x_min) AS x, max(y_max) AS y FROM m GROUP BY mosaic_id)
SELECT tile_id, m.mosaic_id FROM m JOIN b ON b.mosaic_id = m.mosaic_id WHERE abs((x_min - x) / px - round_even((x_min - x) / px, 0)) > 1e-6 OR abs((y - y_max) / px - round_even((y - y_max) / px, 0)) > 1e-6""")
def mosaic_off_grid(spark: SparkSession, d: str) -> DataFrame:
    """Some tiles are moved by a part of a pixel."""
    t = fx.tiles(spark, d).select("tile_id", F.col("kind").alias("mosaic_id"), (F.col("x_min") + F.when(F.col("tile_id") % 17 == 0, 30).otherwise(0)).alias("x_min"), "y_max", "px")
    return raster.off_grid(t).select("tile_id", "mosaic_id")


_SAMPLE = "sample AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patch_id ORDER BY md5(concat_ws('|', 5, patch_id, prow, pcol)), prow, pcol) AS k FROM pixel WHERE covered) WHERE k <= 16)"


@query(f"{PIX}, {_SAMPLE} SELECT patch_id, count(*) AS sampled, array_to_string(list(prow * 8 + pcol ORDER BY prow, pcol), ',') AS pixels FROM sample GROUP BY patch_id")
def seeded_samples(spark: SparkSession, d: str) -> DataFrame:
    at = F.transform(F.sort_array(F.collect_list(F.col("prow") * 8 + F.col("pcol"))), lambda x: x.cast("string"))
    return raster.seeded_sample(fx.pixels(spark, d), 16, 5).groupBy("patch_id").agg(F.count("*").alias("sampled"), F.array_join(at, ",").alias("pixels"))


_SHOWN = """shown AS (SELECT mosaic_id, pole, cell_row * 8 + prow - min_row AS mrow, cell_col * 8 + pcol - min_col AS mcol, CASE WHEN patch_id % 37 = 0 AND prow = 3 THEN NULL ELSE value + CASE WHEN patch_id % 29 = 0 THEN 0.25e0 ELSE 0e0 END END AS shown_value,
  CASE WHEN ref_covered THEN ref_value * CASE WHEN patch_id % 41 = 0 THEN 1.5e0 ELSE 1e0 END END AS shown_ref FROM pixel JOIN extent USING (mosaic_id, pole) WHERE covered)"""
_MX, _MY = "(min_col * 240 + (mcol + 0.5e0) * 240)", "(-min_row * 240 - (mrow + 0.5e0) * 240)"


@query(f"""{PIX}, {_SAMPLE}, {PATCHES}, {EXTENT}, {_SHOWN}, s AS (SELECT p.*, min_row, min_col, cell_row * 8 - min_row AS row0, cell_col * 8 - min_col + CASE WHEN patch_id % 31 = 0 THEN 1 ELSE 0 END AS col0, 'ps' AS kind, CASE WHEN pole = 'south' THEN -90e0 ELSE 90e0 END AS lat0, 0e0 AS lon0, 1e0 AS k0, 0e0 AS fe, 0e0 AS fn FROM sample p JOIN extent USING (mosaic_id, pole)),
g AS (SELECT *, {q.inverse(_X, _Y)[0]} AS lat, {q.inverse(_X, _Y)[1]} AS lon FROM s), f AS (SELECT *, ({q.forward('lat', 'lon')[0]} - min_col * 240) / 240 AS fc, (-min_row * 240 - {q.forward('lat', 'lon')[1]}) / 240 AS fr FROM g),
c AS (SELECT *, CAST(floor(fc) AS INT) AS mcol, CAST(floor(fr) AS INT) AS mrow FROM f), e AS (SELECT c.*, {q.inverse(_MX, _MY)[0]} AS blat, {q.inverse(_MX, _MY)[1]} AS blon, shown_value, shown_ref FROM c LEFT JOIN shown w USING (mosaic_id, pole, mrow, mcol))
SELECT patch_id, count(*) AS samples, round(max(sqrt(pow(fc - (col0 + pcol + 0.5e0), 2) + pow(fr - (row0 + prow + 0.5e0), 2))), 5) AS position_px, round(max({q.distance('lat', 'lon', 'blat', 'blon')}), 2) AS geo_m,
CASE WHEN count_if(shown_value IS NULL) > 0 THEN -1 ELSE round(max(abs(shown_value - value)), 6) END AS value_error, CASE WHEN count_if(ref_covered AND shown_ref IS NULL) > 0 THEN -1 ELSE round(coalesce(max(CASE WHEN ref_covered THEN abs(shown_ref - ref_value) END), 0), 6) END AS reference_error FROM e GROUP BY patch_id""")
def sample_errors(spark: SparkSession, d: str) -> DataFrame:
    """Every patch's sample against its mosaic, in which some values are changed or missing and some patches stand a column off."""
    p = fx.pixels(spark, d)
    patches = p.where("prow = 0 AND pcol = 0").select("patch_id", "mosaic_id", "pole", (F.col("cell_row") * 8).alias("row0"), (F.col("cell_col") * 8).alias("col0"), F.lit(8).alias("height"), F.lit(8).alias("width"))
    extent = raster.mosaic_extent(patches)
    placed = raster.placed(p, extent)
    broken = F.when((F.col("patch_id") % 37 == 0) & (F.col("prow") == 3), F.lit(None)).otherwise(F.col("value") + F.when(F.col("patch_id") % 29 == 0, 0.25).otherwise(0.0))
    mosaic = placed.select("mosaic_id", "pole", "mrow", "mcol", broken.alias("value"), F.when(F.col("ref_covered"), F.col("ref_value") * F.when(F.col("patch_id") % 41 == 0, 1.5).otherwise(1.0)).alias("ref_value"))
    grid = {"kind": F.lit("ps"), "lat0": F.when(F.col("pole") == "south", -90.0).otherwise(90.0), "lon0": F.lit(0.0), "k0": F.lit(1.0), "fe": F.lit(0.0), "fn": F.lit(0.0), "px": F.lit(240.0)}
    s = raster.seeded_sample(p, 16, 5).join(extent.select("mosaic_id", "pole", "min_row", "min_col"), ["mosaic_id", "pole"])
    s = s.withColumns({**grid, **{"m_" + k: v for k, v in grid.items()}, "x_min": F.col("cell_col") * 8 * 240.0, "y_max": -F.col("cell_row") * 8 * 240.0, "m_x_min": F.col("min_col") * 240.0, "m_y_max": -F.col("min_row") * 240.0,
                       "row0": F.col("cell_row") * 8 - F.col("min_row"), "col0": F.col("cell_col") * 8 - F.col("min_col") + F.when(F.col("patch_id") % 31 == 0, 1).otherwise(0)})
    e = raster.sample_errors(s, mosaic)
    known = lambda c: F.when(F.col(c) == float("inf"), -1.0).otherwise(F.round(c, 6)).alias(c)
    return e.select("patch_id", "samples", F.round("position_px", 5).alias("position_px"), F.round("geo_m", 2).alias("geo_m"), known("value_error"), known("reference_error"))
