"""Golden values, hand-built cases and properties of the library's operators."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tilewright.functions import geo, scoring
from tilewright.operators import boxes, catalogue, contract, proximity, raster, text
from tilewright.operators.graph import connected_components
from tilewright.sources import collections as src

#: Published pixel centres of two tiles: projection, grid, and (col, row, latitude, longitude).
CENTRES = [
    (("tm", 0.0, -160.0, 0.999, 250000.0, 2500000.0), (57900.0, 904700.0, 100.0), [(0, 0, -52.208816651, -170.360124699), (256, 256, -53.155668954, -169.174392099), (511, 511, -54.088935727, -167.940925518)]),
]
#: Published points of four tiles: bounds and centre, upper left and lower right coordinates; and the zone found for them.
METADATA = [
    ("tm/0/-160/2500000", 57899.99999999956, 904700.0000000002, (-53.15382890435657, -169.1767581231181), (-52.20695843280776, -170.36239141832502), (-54.09075510775035, -167.9384531824178)),
    ("tm/0/-104/0", 185499.9999999997, 442900.0000000007, (13.771920141761159, -105.32202981444279), (14.61021216718391, -106.19988111923357), (12.929982206497655, -104.45046268680528)),
    ("ps/90/0/500000", -321060.6000000001, 688707.4000000003, (63.54045013842536, -101.58775130396306), (62.584822826287734, -102.94371490877114), (64.48437293473515, -100.12700071926722)),
    ("tm/0/72/2500000", 312599.99999999977, 457600.00000000023, (-68.081899216301, 79.8174455134934), (-67.33205255898362, 77.36757991329948), (-68.79182477210976, 82.42701751752782)),
]
PROJ = "kind string, lat0 double, lon0 double, k0 double, fe double, fn double"


def test_pixel_centres(spark):
    rows = [(*p, *g, float(c), float(r), lat, lon) for p, g, pts in CENTRES for c, r, lat, lon in pts]
    df = spark.createDataFrame(rows, PROJ + ", x_min double, y_max double, px double, c double, r double, lat double, lon double")
    lat, lon = geo.pixel_to_lonlat(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), F.col("c") + 0.5, F.col("r") + 0.5)
    col, row = geo.lonlat_to_pixel(geo.Projection(), F.col("x_min"), F.col("y_max"), F.col("px"), lat, lon)
    for x in df.select("lat", "lon", "c", "r", lat.alias("a"), lon.alias("b"), col.alias("d"), row.alias("e")).collect():
        assert abs(x["a"] - x["lat"]) < 1e-8 and abs(x["b"] - x["lon"]) < 1e-8
        assert abs(x["d"] - x["c"] - 0.5) < 1e-6 and abs(x["e"] - x["r"] - 0.5) < 1e-6


def test_projection_recovery_on_published_rows(spark):
    rows = []
    for i, (_, x0, y1, c, ul, lr) in enumerate(METADATA):
        rows += [(i, x0 + 25600, y1 - 25600, *c), (i, x0, y1, *ul), (i, x0 + 51200, y1 - 51200, *lr)]
    rows.append((9, 0.0, 0.0, 10.0, 20.0))
    got = {r["tile_id"]: r for r in proximity.recovered_projection(spark.createDataFrame(rows, "tile_id int, x double, y double, lat double, lon double"), proximity.projection_candidates(spark)).collect()}
    assert [got[i]["candidate"] for i in range(4)] == [m[0] for m in METADATA] and got[9]["candidate"] is None


def test_example_tile_record(spark):
    tile = spark.createDataFrame([(1, "tm", 0.0, -160.0, 0.999, 250000.0, 2500000.0, 57900.0, 904700.0, 100.0, 512, "test")], "tile_id int, " + PROJ + ", x_min double, y_max double, px double, width int, split string")
    det = spark.createDataFrame([(1, i, 10.0, 10.0, 5.0, 5.0, 0.9) for i in range(76)] + [(1, 99, 358.68, 85.11, 34.58, 34.87, 0.2)], "tile_id int, idx int, x double, y double, w double, h double, score double")
    none = spark.createDataFrame([], "tile_id int")
    r = boxes.region_records(tile, boxes.confident(det), none, none).first()
    assert (round(r["lat"], 6), round(r["lon"], 6), round(r["ground_m"], 3), r["size_km"], r["detections"], r["density"], r["score"]) == (-53.153829, -169.176758, 99.641, 51.016, 76, 29.201, 50.0)
    c = boxes.located(tile, det.where("idx = 99")).first()
    assert geo_distance(c["lat"], c["lon"], -52.701559, -168.424937) < 1.0 and abs(c["diameter_km"] - 3.462) < 1e-3 and c["truncated"] == 0


def geo_distance(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * geo.RADIUS * math.asin(math.sqrt(h))


def test_longitudes_and_labels(spark):
    df = spark.createDataFrame([(180.0,), (179.9999999,), (-180.0,), (540.0,), (-190.0,)], "x double")
    assert [r[0] for r in df.select(geo.published_longitude(geo.wrap(F.col("x")))).collect()] == [-180.0, -180.0, -180.0, -180.0, 170.0]
    p = spark.createDataFrame([("+proj=tmerc +lat_0=0 +lon_0=-160 +k=0.999 +x_0=250000 +y_0=2500000 +R=1737400",), ("+proj=longlat",)], "c string").select(geo.projection_of(F.col("c")).alias("p")).collect()
    assert tuple(p[0]["p"]) == ("tm", 0.0, -160.0, 0.999, 250000.0, 2500000.0, 1737400.0) and p[1]["p"] is None


def brute_match(pred, scores, ref, t):
    def iou(a, b):
        w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
        h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
        i = max(0, w) * max(0, h)
        return i / (a[2] * a[3] + b[2] * b[3] - i) if w > 0 and h > 0 else 0.0

    taken, out = set(), set()
    for p in sorted(range(len(pred)), key=lambda i: (-scores[i], i)):
        c = [(iou(pred[p], r), j) for j, r in enumerate(ref) if j not in taken and iou(pred[p], r) >= t]
        if c:
            taken.add(max(c)[1])
            out.add((p, max(c)[1]))
    return out


def test_greedy_matching_with_ties(spark):
    rng = random.Random(3)
    want, d, r = set(), [], []
    for tile in range(12):
        ref = [(rng.randint(0, 30), rng.randint(0, 30), 10, 10) for _ in range(12)]
        pred = [(x + rng.choice([0, 0, 1, 2]), y, 10, 10) for x, y, _, _ in ref for _ in range(2)]
        scores = [rng.choice([0.5, 0.7, 0.9]) for _ in pred]
        want |= {(tile, *m) for m in brute_match(pred, scores, ref, 0.5)}
        d += [(tile, i, *map(float, b), s) for i, (b, s) in enumerate(zip(pred, scores, strict=True))]
        r += [(tile, i, *map(float, b)) for i, b in enumerate(ref)]
    det = spark.createDataFrame(d, "tile_id int, idx int, x double, y double, w double, h double, score double")
    ref = spark.createDataFrame(r, "tile_id int, idx int, x double, y double, w double, h double")
    got = {(x["tile_id"], x["det"], x["ref"]) for x in boxes.greedy_matches(boxes.iou_pairs(det, ref)).collect()}
    assert got == want


def test_percentile_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 2.0, 3.0, None])], "id int, v double")
    got = {r["id"]: r["rank"] for r in scoring.percentile_rank(df, "v").collect()}
    assert got == {0: 12.5, 1: 50.0, 2: 50.0, 3: 87.5, 4: None}
    assert scoring.percentile_rank(df.where("id = 0"), "v").first()["rank"] == 50.0


def raster_of(spark, covered, values):
    rows = [(0, r, c, float(values.get((r, c), 0.0)), bool(covered(r, c))) for r in range(20) for c in range(20)]
    return spark.createDataFrame(rows, "patch_id int, prow int, pcol int, value double, covered boolean")


def test_edge_distance_and_anchor(spark):
    px = raster_of(spark, lambda r, c: c < 15, {(0, 0): 1.05, (10, 13): 0.99, (9, 6): 0.97})
    d = {(r["prow"], r["pcol"]): r["edge_distance"] for r in raster.edge_distance(px, 8).collect()}
    assert (d[0, 0], d[10, 14], d[10, 10], d[9, 6], d[10, 15]) == (0, 0, 4, 6, None)
    assert tuple(raster.peak(px).select("prow", "pcol").first()) == (0, 0)
    assert tuple(raster.anchors(px, 4).select("prow", "pcol").first()) == (9, 6)
    assert raster.anchors(raster_of(spark, lambda r, c: r == 0 and c < 5, {}), 4).first()["value"] is None


def test_quantize_constant_and_round_trip(spark):
    px = spark.createDataFrame([(0, 0, i, v, True) for i, v in enumerate([0.25, 0.5, 1.75])] + [(1, 0, 0, 3.0, True), (1, 0, 1, 9.0, False)], "patch_id int, prow int, pcol int, value double, covered boolean")
    got = raster.quantized(px).collect()
    assert all(abs(r["decoded"] - r["value"]) <= r["scale"] / 2 for r in got) and {r["level"] for r in got if r["patch_id"] == 1} == {0} and len(got) == 4


def test_high_pass_and_bilinear(spark):
    rng = random.Random(1)
    v = [[rng.random() for _ in range(8)] for _ in range(8)]
    px = spark.createDataFrame([(0, r, c, v[r][c]) for r in range(8) for c in range(8)], "patch_id int, prow int, pcol int, value double")
    ref = lambda i: -i if i < 0 else 14 - i if i > 7 else i
    for x in raster.high_pass(px, 3, 8).collect():
        mean = sum(v[ref(x["prow"] + a)][ref(x["pcol"] + b)] for a in range(-3, 4) for b in range(-3, 4)) / 49
        assert abs(x["high"] - (v[x["prow"]][x["pcol"]] - mean)) < 1e-12
    grid = spark.createDataFrame([(r, c, float(r * 10 + c)) for r in range(4) for c in range(8)], "row int, col int, v double")
    pts = spark.createDataFrame([(1, 90 - 45 * 1.5, -180 + 45 * 2.5), (2, 90 - 45 * 1.5, -180.0), (3, 0.0, 0.0)], "id int, lat double, lon double")
    assert {r["id"]: round(r["value"], 9) for r in raster.bilinear(grid, pts, 4, 8).collect()} == {1: 12.0, 2: 13.5, 3: 18.5}


def test_components_against_union_find(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)] + [(5, 5), (400, 401), (400, 401)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_close_pairs_at_poles_and_antimeridian(spark):
    rng = random.Random(2)
    pts = [(i, rng.choice([-1, 1]) * (90 - rng.random()), rng.uniform(-180, 180)) for i in range(60)] + [(100 + i, rng.uniform(-1, 1), rng.choice([-1, 1]) * (180 - rng.random())) for i in range(60)] + [(300, 90.0, 0.0), (301, -90.0, 17.0)]
    want = {(a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and geo_distance(a[1], a[2], b[1], b[2]) < 20000}
    got = {(r["a"], r["b"]) for r in proximity.close_pairs(spark.createDataFrame(pts, "id int, lat double, lon double"), 20.0).collect()}
    assert got == want and want


def test_registry_is_append_only_and_order_free(spark):
    none = spark.createDataFrame([], "id string, type string, key string, first_catalogued string")
    keys = [("CRATER_CANDIDATE", f"a|{i:03d}") for i in range(8)] + [("IMP_CANDIDATE", "b|1")]
    shuffled = keys[:]
    random.Random(1).shuffle(shuffled)
    table = lambda rows: spark.createDataFrame(rows, "type string, key string")
    one = {r["key"]: r["id"] for r in catalogue.registry_assign(none, table(keys[2:]), "2026-01-01").collect()}
    first = spark.createDataFrame([tuple(r) for r in catalogue.registry_assign(none, table(shuffled).where("key >= 'a|002'"), "2026-01-01").collect()], none.schema)
    assert {r["key"]: r["id"] for r in first.collect()} == one and one["a|002"] == "MM-CR-000001"
    second = catalogue.registry_assign(first, table(keys), "2026-02-02")
    ids = {r["key"]: r["id"] for r in second.collect()}
    assert {k: ids[k] for k in one} == one and ids["a|000"] == "MM-CR-000007" and ids["a|001"] == "MM-CR-000008"
    assert catalogue.append_only_violations(first, second).isEmpty() and catalogue.registry_violations(second).isEmpty()
    assert not catalogue.append_only_violations(second, first).isEmpty()


def test_spacing_prefers_held_out(spark):
    rows = [("large", float(-i), 0.0, i, 0, 0.0, 2.0 * i, "train" if i < 3 else "test") for i in range(12)]
    c = spark.createDataFrame(rows, "category string, o1 double, o2 double, tile_id int, idx int, lat double, lon double, split string")
    got = catalogue.curated(c, ["large"], ["o1", "o2", "tile_id", "idx"], 120, 3).collect()
    assert [(r["pass"], r["tile_id"]) for r in got] == [(0, 11), (0, 9), (0, 7), (1, 2), (1, 0)]
    assert len(catalogue.spaced(c, ["o1"], 1, 5, batch=2)) == 5


def test_observation_group_across_the_antimeridian(spark):
    r = spark.createDataFrame([("a", "t", "f", 0.0, 179.9, 5.0, "test"), ("b", "t", "f", 0.0, -179.9, 9.0, "train"), ("c", "u", "f", 0.0, 0.0, 1.0, "test"), ("d", "u", "g", 0.0, 0.0, 1.0, "test")], "region_id string, target string, footprint string, lat double, lon double, area_m2 double, split string")
    groups, bad = proximity.observation_groups(r, 181.02)
    g = groups.collect()
    assert len(g) == 1 and abs(abs(g[0]["g_lon"]) - 180) < 1e-9 and g[0]["observation_ids"] == ["b", "a"] and [x["target"] for x in bad.collect()] == ["u"]


def test_ids_and_claims(spark):
    names = spark.createDataFrame([("M1174144247CE_r5360_c480", "patch_0001_0002_S_80S", "M1126915118RE.ech.cog__target_1980__idx_1980_p0"), ("bad", "patch_1_2", "bad")], "a string, b string, c string")
    got = [tuple(r) for r in names.select(text.crater_region_id(F.col("a")), text.sector_id(F.col("b")), text.imp_region_id(F.col("c")), text.target_id(F.col("c"))).collect()]
    assert got == [("wac-m1174144247ce-r5360-c480", "ice-s-0001-0002", "imp-m1126915118re-t1980-i1980", "1980"), (None, None, None, None)]
    t = spark.createDataFrame([("x", "A new crater. This is not a new crater, but another NEW CRATER far away from any denial in this sentence is a new crater")], "id string, text string")
    assert sorted(r["position"] for r in text.claim_hits(t, ("new crater",), (" not ",)).collect()) == [2, 110]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "val.txt").write_text("a\nb\n\n")
    (tmp_path / "lists" / "train.txt").write_text("b\nc\n")
    rows = src.split_lists(spark, str(tmp_path / "lists"))
    assert sorted(map(tuple, rows.collect())) == [("a", "validation"), ("b", "train"), ("b", "validation"), ("c", "train")]
    assert [r["sample"] for r in src.split_conflicts(rows).collect()] == ["b"]
    (tmp_path / "c.json").write_text(json.dumps({"r1": [[1.5, 2.5, 3.0, 0.9, 0, 1]], "r0": []}))
    assert [tuple(r) for r in src.crater_map(spark, str(tmp_path / "c.json")).collect()] == [("r1", 0, 1.5, 2.5, 3.0, 0.9, 0, 1)]
    doc = {"images": [{"id": 1, "file_name": "x/a.png"}, {"id": 2, "file_name": "z.png"}], "annotations": [{"image_id": 1, "bbox": [1, 2, 3, 4]}, {"image_id": 2, "bbox": [0, 0, 1, 1]}]}
    (tmp_path / "coco.json").write_text(json.dumps(doc))
    images, found, missing = src.coco(spark, str(tmp_path / "coco.json"), spark.createDataFrame([("a",), ("q",)], "sample string"))
    assert images.count() == 1 and found.first()["w"] == 3.0 and [r["sample"] for r in missing.collect()] == ["q"]
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "id string, v double")
    src.write_collection(df, str(tmp_path / "out"), "id")
    assert [r["id"] for r in spark.read.json(str(tmp_path / "out")).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="finite"):
        src.write_collection(df.withColumn("v", F.lit(float("nan"))), str(tmp_path / "out"), "id")
    inv = src.inventory(spark, str(tmp_path / "lists"))
    assert inv.count() == 2 and src.inventory_differences(inv, inv.limit(1)).first()["why"] == "unlisted"
    with pytest.raises(ValueError, match="problems"):
        src.publish(df, str(tmp_path / "pub"), contract.duplicates(df.union(df), "twice", "id"))
    src.publish(df, str(tmp_path / "pub"), contract.duplicates(df, "twice", "id"))
    assert spark.read.parquet(str(tmp_path / "pub")).count() == 2


def test_layers_must_share_a_grid(spark):
    px = lambda g: spark.createDataFrame([(p, 0, 0, g if p else "g", 1.0) for p in (0, 1)], "patch_id int, prow int, pcol int, grid string, value double")
    wide, bad = src.assembled({"slope": px("g"), "tmax": px("h")})
    assert [r["patch_id"] for r in wide.collect()] == [0] and [r["patch_id"] for r in bad.collect()] == [1]


def test_stream_of_upserts(spark, tmp_path):
    from tilewright.streaming.upserts import keep_current

    schema = "id int, v string, n int"
    for k, rows in enumerate([[(1, "a", 1), (2, "b", 1)], [(2, "c", 3), (2, "old", 2), (3, "d", 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
        changes = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        keep_current(changes, str(tmp_path / "out"), "id", "n", str(tmp_path / "cp")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out" / "v=1")).collect())) == [(1, "a", 1), (2, "c", 3), (3, "d", 1)]


def test_contract_rules_on_bad_rows(spark):
    objects = spark.createDataFrame([("1", 91.0, 0.0), ("2", 0.0, 180.0), ("3", None, 0.0), ("4", 0.0, -180.0)], "id string, lat double, lon double")
    assert sorted(r["object_id"] for r in contract.coordinate_rules(objects, "id").collect()) == ["1", "2", "3"]
    runs = spark.createDataFrame([("a", 0, 0, "x", "x", 0, 5, 1.0), ("b", 1, 0, "x", "y", 2, 0, 0.0)], "run_id string, missing_keys int, unexpected_keys int, sha256 string, pinned_sha256 string, non_finite int, size int, std double")
    bad = contract.problems(spark, contract.run_rules(runs), scope="published", raw_rules=("run-strict",)).collect()
    assert sorted(r["rule_id"] for r in bad) == ["run-checkpoint", "run-constant", "run-empty", "run-finite"]


def test_running_total_by_group(spark):
    rows = [("a" if i % 3 else None, i % 7, i % 5) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, k int, n int").groupBy("g", "k").agg(F.sum("n").alias("n"))
    for parts in (1, 3, 64):
        got = {(r["g"], r["k"]): r["t"] for r in scoring.running_total(df, "k", "n", "t", ascending=False, parts=parts, by=("g",)).collect()}
        assert got == {(g, k): sum(m for h, j, m in rows if h == g and j > k) for g, k, _ in rows}
    assert scoring.running_total(df.limit(0), "k", "n", "t", by=("g",)).count() == 0
