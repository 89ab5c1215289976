"""The distance transform against repeated erosion."""

import random

import numpy as np
from pyspark.sql import functions as F

from tilewright.operators import raster


def erosions(on):
    out, step = np.zeros(on.shape, int), 0
    while on.any():
        out[on] = step
        p = np.pad(on, 1)
        on = np.logical_and.reduce([p[i : i + on.shape[0], j : j + on.shape[1]] for i in range(3) for j in range(3)])
        step += 1
    return out


def test_against_erosion(spark):
    rng = random.Random(8)
    masks = [np.array([[rng.random() > q for _ in range(w)] for _ in range(h)]) for h, w, q in ((1, 1, 0), (1, 9, 0.2), (7, 1, 0.2), (16, 16, 0.0), (31, 20, 0.01), (33, 40, 0.005), (12, 12, 1.0), (20, 20, 0.3))]
    rows = [(k, r, c, None if not m[r, c] and (r + c) % 2 else bool(m[r, c]), r * 0.5, f"{c}") for k, m in enumerate(masks) for r in range(m.shape[0]) for c in range(m.shape[1])]
    px = spark.createDataFrame(rows, "patch_id int, prow int, pcol int, covered boolean, value double, _d string")
    got = raster.edge_distance(px.drop("_d").withColumn("name", F.lit("x")))
    assert got.columns == ["patch_id", "prow", "pcol", "covered", "value", "name", "edge_distance"]
    want = [erosions(m) for m in masks]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        m = masks[r["patch_id"]]
        assert r["edge_distance"] == (want[r["patch_id"]][r["prow"], r["pcol"]] if m[r["prow"], r["pcol"]] else None), r
        assert r["value"] == r["prow"] * 0.5
    assert raster.edge_distance(px, 2).agg(F.max("edge_distance")).first()[0] == 2
    assert raster.edge_distance(px.where("false")).count() == 0


def test_a_patch_of_256(spark):
    px = spark.range(256 * 256).select(F.lit(1).alias("patch_id"), (F.col("id") / 256).cast("int").alias("prow"), (F.col("id") % 256).cast("int").alias("pcol")).withColumn("covered", ~((F.col("prow") == 40) & (F.col("pcol") == 60)))
    m = np.ones((256, 256), bool)
    m[40, 60] = False
    want = erosions(m)
    got = raster.edge_distance(px).where("covered").collect()
    assert len(got) == 65535 and all(want[r["prow"], r["pcol"]] == r["edge_distance"] for r in got)
