"""The span of groups against all pairs."""

import numpy as np
from pyspark.sql import functions as F

from tilewright.functions import geo
from tilewright.operators import proximity


def span(lat, lon):
    p, q = np.radians(lat), np.radians(lon)
    v = np.c_[np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)]
    chord = np.sqrt(max(((v[i] - v) ** 2).sum(axis=1).max() for i in range(len(v))))
    return 2 * geo.RADIUS * np.arcsin(min(1.0, chord / 2))


def test_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    t = np.linspace(0, 2 * np.pi, 700, endpoint=False)
    groups = {
        "cap": (60 + rng.normal(0, 0.3, 800), 179.9 + rng.normal(0, 0.6, 800)), "circle": (-40 + 0.1 * np.sin(t), 20 + 0.1 * np.cos(t) / np.cos(np.radians(40))), "sphere": (np.degrees(np.arcsin(rng.uniform(-1, 1, 600))), rng.uniform(-180, 180, 600)),
        "pole": (90 - rng.uniform(0, 0.01, 500), rng.uniform(-180, 180, 500)), "two": (np.array([1.0, 1.001]), np.array([2.0, 2.0])), "three": (np.array([0.0, 0.0, 0.0]), np.array([179.0, -179.0, 180.0])), "line": (np.linspace(0, 1, 300), np.zeros(300)), "same": (np.ones(50), np.ones(50)),
    }
    rows = [(g, i, float(a), float((b + 180) % 360 - 180)) for g, (lat, lon) in groups.items() for i, (a, b) in enumerate(zip(lat, lon, strict=True))]
    rows += [("alone", 1, 0.0, 0.0), ("null", 1, None, 0.0), ("null", 2, 0.0, 0.0), (None, 1, 0.0, 0.0)]
    got = {r["g"]: r["span_m"] for r in proximity.group_span(spark.createDataFrame(rows, "g string, id int, lat double, lon double")).collect()}
    assert got.keys() == groups.keys()
    for g, (lat, lon) in groups.items():
        assert abs(got[g] - span(lat, lon)) < 0.02, g


def test_a_large_group(spark):
    n = 300_000
    df = spark.range(n).select(F.lit(1).alias("g"), "id", (10 + F.sin(F.col("id") * 0.37) * F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("lat"), (F.cos(F.col("id") * 0.37) * F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("lon"))
    got = proximity.group_span(df).first()["span_m"]
    rows = df.where("(lat - 10) * (lat - 10) + lon * lon > 0.99").select("lat", "lon").toPandas()
    assert len(rows) < 20_000 and abs(got - span(rows["lat"].to_numpy(), rows["lon"].to_numpy())) < 0.02
