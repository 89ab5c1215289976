"""Repeats of every size and place against all pairs."""

import math
import random

from pyspark.sql import functions as F

from tilewright.functions import geo
from tilewright.operators import boxes


def distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * geo.RADIUS * math.asin(math.sqrt(min(1.0, h)))


def test_against_all_pairs(spark):
    rng = random.Random(4)
    places = [(90.0, 0.0), (-89.99, 170.0), (0.0, -180.0), (0.0, 179.999), (60.0, 10.0), (-30.0, -75.0)]
    rows = []
    for i in range(700):
        lat, lon = rng.choice(places)
        d = rng.choice([0.0, 0.2, 1.0, 3.9, 4.0, 20.0, 150.0, 600.0]) * rng.choice([1.0, 0.76, 0.75, 0.74, 1.2])
        far = max(1.0, d / 4) / 30.3 * rng.choice([0.1, 0.5, 0.99, 1.3])
        rows.append((i % 9, i, max(-90.0, min(90.0, lat + rng.uniform(-far, far))), (lon + rng.uniform(-far, far) / max(0.02, math.cos(math.radians(lat))) + 180) % 360 - 180, d))
    want = set()
    for t, i, a, b, d in rows:
        if any(u != t and abs(d - e) <= 0.25 * max(d, e) and distance(a, b, p, q) <= max(1000.0, 250 * d) for u, _, p, q, e in rows):
            want.add((t, i))
    df = spark.createDataFrame(rows + [(None, 1, 0.0, 0.0, 1.0), (1, 9999, None, 0.0, 1.0)], "tile_id int, idx int, lat double, lon double, diameter_km double")
    got = [tuple(r) for r in boxes.repeats_by_reach(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < 690
    assert boxes.repeats_by_reach(df.where("false")).count() == 0


def test_craters_are_computed_once(spark):
    """What makes the craters runs once a row, however many cells and levels they stand in; other reaches and shares against all pairs."""
    rng = random.Random(7)
    rows = [(i % 5, i, rng.choice([-89.9, 0.0, 75.0]) + rng.uniform(-0.1, 0.1), rng.choice([-180.0, 30.0]) + rng.uniform(0, 0.3), rng.choice([0.1, 0.5, 1.0, 8.0, 9.5, 30.0])) for i in range(400)]
    want = {(t, i) for t, i, a, b, d in rows if any(u != t and abs(d - e) <= 0.4 * max(d, e) and distance(a, b, p, q) <= max(300.0, 400 * d) for u, _, p, q, e in rows)}
    seen = spark.sparkContext.accumulator(0)

    def counted(v: float) -> float:
        seen.add(1)
        return v

    df = spark.createDataFrame(rows, "tile_id int, idx int, lat double, lon double, diameter_km double").withColumn("lat", F.udf(counted, "double")("lat"))
    got = [tuple(r) for r in boxes.repeats_by_reach(df, least_km=0.3, share=0.4).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 40 < len(want) < 390
    assert seen.value == len(rows)
