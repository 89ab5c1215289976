"""Points and tiles that share places: as many steps as there are places, and the same results."""

import random

from pyspark.sql import functions as F

from tests.test_repeats import distance
from tilewright.functions import geo
from tilewright.operators import proximity
from tilewright.sources import collections

GRID = dict(kind="'tm'", lat0="0d", lon0="0d", k0="0.999d", fe="250000d", fn="0d", x_min="240000d", y_max="51200d", px="100d", width="512")


def counted(spark, monkeypatch, name, pick):
    """A counter of the rows for which a function of ``geo`` is computed."""
    seen, plain = spark.sparkContext.accumulator(0), getattr(geo, name)

    def once(v):
        seen.add(1)
        return v

    def wrapped(*a):
        out = list(plain(*a))
        out[pick] = F.udf(once, "double")(out[pick])
        return tuple(out)

    monkeypatch.setattr(geo, name, wrapped)
    return seen


def brute(points, km):
    low = {i: i for i, _, _ in points if i is not None}
    near = [(a[0], b[0]) for a in points for b in points if None not in a and None not in b and distance(a[1], a[2], b[1], b[2]) < km * 1000]
    while True:
        new = dict(low)
        for a, b in near:
            new[a] = new[b] = min(new[a], new[b])
        if new == low:
            return low
        low = new


def test_groups_pair_places_alone(spark, monkeypatch):
    rng = random.Random(3)
    places = [(rng.choice([0.0, -0.0, 89.99, 45.0]) + rng.uniform(-1.5, 1.5) * (k % 3), rng.choice([0.0, 179.99, -180.0]) + rng.uniform(0, 0.01)) for k in range(40)]
    places = [(min(90.0, a), b) for a, b in places]
    points = [(i, *rng.choice(places)) for i in rng.sample(range(10_000), 400)] + [(10_001, None, 1.0), (10_002, 1.0, None), (None, *places[0])]
    twice = [(10_003, 10.0, 10.0), (10_003, -40.0, 10.0), (10_004, 10.0, 10.0), (10_005, -40.0, 10.0)]
    edges, plain = [], proximity.connected_components
    monkeypatch.setattr(proximity, "connected_components", lambda e, *a: (edges.append(e.count()), plain(e, *a))[1])
    df = spark.createDataFrame(points + twice, "id long, lat double, lon double")
    got = proximity.point_groups(df, 25.6).collect()
    want = brute(points + twice, 25.6)
    assert len(got) == len(points + twice) and all(r["component"] == want.get(r["id"]) for r in got)
    assert edges[0] <= 40 * 39 // 2 + 4
    nan = spark.createDataFrame([(1, float("nan"), 0.0), (2, float("nan"), 0.0)], "id long, lat double, lon double")
    assert sorted(map(tuple, proximity.point_groups(nan, 25.6).collect())) == [(1, 1), (2, 2)]


def test_containment_is_told_once_for_copies(spark, monkeypatch):
    seen = counted(spark, monkeypatch, "lonlat_to_pixel", 0)
    tiles = spark.range(60).select(F.col("id").alias("tile_id"), *(F.expr(v).alias(k) for k, v in GRID.items()), F.lit(0.84).alias("lat"), F.lit(0.6).alias("lon"), F.lit(3.0).alias("reach_deg"))
    tiles = spark.createDataFrame(tiles.collect(), tiles.schema)
    points = spark.range(90).selectExpr("id AS point_id", "CASE WHEN id % 3 = 0 THEN 0.84d WHEN id % 3 = 1 THEN 40d END AS lat", "0.6d AS lon")
    got = sorted(map(tuple, proximity.points_in_tiles(points, tiles).collect()))
    assert got == [(p, t) for p in range(0, 90, 3) for t in range(60)]
    assert 0 < seen.value < 60


def test_equal_grids_are_projected_once(spark, monkeypatch):
    tiles = spark.range(200).select(F.col("id").alias("tile_id"), *(F.expr(v).alias(k) for k, v in GRID.items()), F.expr("IF(id % 2 = 0, 'train', 'test')").alias("split"))
    want = sorted(map(tuple, proximity.coverage_cells(tiles.where("tile_id < 2")).collect()))
    seen = counted(spark, monkeypatch, "inverse", 0)
    assert sorted(map(tuple, proximity.coverage_cells(tiles).collect())) == want and len(want) > 2
    assert 0 < seen.value <= 4 * 2 * 144


def test_layers_stay_dealt_over_all_tasks(spark):
    layer = lambda v: spark.range(64).selectExpr("id % 4 AS patch_id", "id AS prow", "0 AS pcol", "IF(id % 4 = 3, id, 0) AS grid", f"{v} AS value")
    wide, bad = collections.assembled({"a": layer("CAST(NULL AS DOUBLE)"), "b": layer("double(id)").where("id % 4 <> 2")})
    assert sorted(map(tuple, wide.collect())) == [(i % 4, i, 0, None, float(i)) for i in sorted(range(64), key=lambda i: (i % 4, i)) if i % 4 < 2]
    assert {r["patch_id"] for r in bad.collect()} == {2, 3}
    assert wide.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
