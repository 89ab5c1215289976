"""Queries of documents and builds: what is written is what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.operators import contract, differences, proximity
from tilewright.plans import sphere_sql as q
from tilewright.plans.catalogue import REGIONS, _regions
from tilewright.plans.registry import query
from tilewright.plans.spatial import ROUNDED, _published
from tilewright.sources import builds, collections, documents, fixtures as fx, runs
from tilewright.sources.scratch import new_path, written

_BOXES = "coalesce((SELECT list([x, y, w, h] ORDER BY idx) FROM det d WHERE d.tile_id = t.tile_id), [])"


@query(f"""{fx.with_sql('tile', 'det')}, r AS (SELECT 'tile-' || lpad(CAST(tile_id AS VARCHAR), 9, '0') AS id, * FROM tile t),
j AS (SELECT id, CAST(to_json({{'id': id, 'kind': kind, 'grid': {{'xMin': x_min, 'yMax': y_max, 'width': CAST(width AS INT), 'note': CASE WHEN tile_id % 3 > 0 THEN 'a "quoted"\\ note' END}}, 'boxes': {_BOXES.replace('t.tile_id', 'r.tile_id')}}}) AS VARCHAR) AS text FROM r)
SELECT id AS key, sha256(text) AS sha256, octet_length(encode(text)) AS bytes FROM j""")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All tiles as one pretty document, read by ranges, written again as a compact one, and that read by ranges: each record's bytes."""
    held = fx.detections(spark, d).groupBy("tile_id").agg(F.sort_array(F.collect_list(F.struct("idx", F.array("x", "y", "w", "h").alias("b")))).alias("l")).select("tile_id", F.transform("l", lambda s: s["b"]).alias("boxes"))
    rows = fx.tiles(spark, d).join(held.hint("merge"), "tile_id", "left")  # all boxes are no table to broadcast
    note = F.when(F.col("tile_id") % 3 > 0, F.lit('a "quoted"\\ note'))
    rows = rows.select(F.concat(F.lit("tile-"), F.lpad(F.col("tile_id").cast("string"), 9, "0")).alias("id"), "kind", F.struct(F.col("x_min").alias("xMin"), F.col("y_max").alias("yMax"), F.expr("int(width)").alias("width"), note.alias("note")).alias("grid"),
                       F.coalesce("boxes", F.expr("cast(array() as array<array<double>>)")).alias("boxes"))
    first, second = new_path(spark, "pretty"), new_path(spark, "compact")
    documents.write_collection(rows, f"{first}.json", "id", pretty=True)
    documents.copy_collection(documents.read_collection(spark, f"{first}.json", range_bytes=1 << 20), f"{second}.json")
    return documents.read_collection(spark, f"{second}.json", range_bytes=8 << 20).select("key", F.sha2("value", 256).alias("sha256"), F.octet_length("value").cast("long").alias("bytes"))


@query(f"""{fx.with_sql('tile', 'det', 'ref')}, {q.PAIRS.format(where='WHERE d.score >= 0.5')}, {q.matches()}, {q.LOCATED}, {ROUNDED}
SELECT CAST(c.tile_id AS VARCHAR) AS region_id, CAST(row_number() OVER (PARTITION BY c.tile_id ORDER BY c.idx) - 1 AS INT) AS idx, lat, lon, diameter_km, c.score, c.truncated, CASE WHEN m.det IS NULL THEN 0 ELSE 1 END AS matched FROM craters c LEFT JOIN matches m ON m.tile_id = c.tile_id AND m.det = c.idx""")
def map_of_tuples(spark: SparkSession, d: str) -> DataFrame:
    """All craters as one object of arrays of tuples by tile, and read back."""
    c = _published(spark, d)
    tuples = F.array(*(F.col(x).cast("double") for x in ("lat", "lon", "diameter_km", "score", "truncated", "matched")))
    rows = c.groupBy("tile_id").agg(F.sort_array(F.collect_list(F.struct("idx", tuples.alias("t")))).alias("l")).select("tile_id", F.transform("l", lambda s: s["t"]).alias("tuples"))
    path = new_path(spark, "craters")
    documents.write_collection(rows, f"{path}.json", "tile_id", layout="map", pretty=True, value="tuples")
    return collections.crater_map(spark, f"{path}.json", range_bytes=4 << 20)


@query(f"""{fx.with_sql('tile', 'det')} SELECT 'tiles' AS name, 1 AS build, count(*) AS n, CAST(sum(tile_id) AS BIGINT) AS total, (SELECT count(*) FROM tile WHERE tile_id % 7 = 0) + (SELECT count(*) FROM det WHERE tile_id % 7 = 0 AND tile_id <> 0) AS refused FROM tile
UNION ALL SELECT 'detections', 1, count(*), CAST(sum(tile_id) AS BIGINT), (SELECT count(*) FROM tile WHERE tile_id % 7 = 0) + (SELECT count(*) FROM det WHERE tile_id % 7 = 0 AND tile_id <> 0) FROM det""")
def published_build(spark: SparkSession, d: str) -> DataFrame:
    """A build of two tables, then one whose tiles stand twice and whose detections have no tile: it is refused, the first stays."""
    path = new_path(spark, "published")
    tiles, found = fx.tiles(spark, d), fx.detections(spark, d)

    def rules(t: dict[str, DataFrame]) -> DataFrame:
        twice = contract.duplicates(t["tiles"], "tile-twice", "tile_id")
        lost = t["detections"].join(t["tiles"], "tile_id", "left_anti").select(F.lit("detection-tile").alias("rule_id"), F.col("tile_id").cast("string").alias("object_id"), F.lit("").alias("message"))
        return contract.problems(spark, twice, lost)

    builds.publish(spark, path, {"tiles": tiles.withColumn("build", F.lit(1)), "detections": found.withColumn("build", F.lit(1))}, rules)
    bad = {"tiles": tiles.union(tiles.where("tile_id % 7 = 0")).withColumn("build", F.lit(2)), "detections": found.withColumn("build", F.lit(2)).withColumn("tile_id", F.when(F.col("tile_id") % 7 == 0, -F.col("tile_id")).otherwise(F.col("tile_id")))}
    refused = 0
    try:
        builds.publish(spark, path, bad, rules)
    except builds.Refused as e:
        refused = e.problems.count()
    build = builds.current(spark, path)
    both = None
    for name in ("tiles", "detections"):
        one = builds.published(spark, path, name, build).groupBy("build").agg(F.count("*").alias("n"), F.sum("tile_id").alias("total")).select(F.lit(name).alias("name"), "build", "n", "total", F.lit(refused).cast("long").alias("refused"))
        both = one if both is None else both.unionByName(one)
    return both


@query("""WITH e AS (SELECT event_id AS i, event_type AS task, 'run-' || event_id AS sample, round(value, 4) AS seconds FROM events),
s AS (SELECT *, i % 13 = 0 AS cut, i % 17 = 0 AS plain, CASE WHEN i % 11 = 0 THEN '1' ELSE '2' END AS version FROM e), ok AS (SELECT * FROM s WHERE NOT cut AND NOT plain)
SELECT 'run-malformed' AS rule_id, 'r/' || i AS object_id, '' AS message FROM s WHERE cut OR plain UNION ALL SELECT 'run-version', 'r/' || i, version FROM ok WHERE version <> '2' UNION ALL SELECT 'run-outputs', 'r/' || i, '' FROM ok WHERE i % 7 = 0
UNION ALL SELECT 'run-field', 'r/' || i, 'seconds' FROM ok WHERE seconds IS NULL OR i % 19 = 0 UNION ALL SELECT 'run-missing', task || '/' || sample, '' FROM s WHERE task IS NOT NULL AND (cut OR plain OR version <> '2' OR i % 7 = 0)
UNION ALL SELECT 'run-field', 'r/' || i, 'task' FROM ok WHERE task IS NULL""")
def run_records(spark: SparkSession, d: str) -> DataFrame:
    """Run texts of two versions, with some cut off, some no objects, numbers that are text, and without outputs."""
    e = fx.table(spark, d, "events").select(F.col("event_id").alias("i"), F.col("event_type").alias("task"), F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("sample"), F.round("value", 4).alias("seconds"))
    i, text = F.col("i"), lambda *c: F.to_json(F.struct(*c))
    outputs = F.when(i % 7 != 0, F.create_map(F.lit("mask"), F.struct(F.lit(0.5).alias("mean"), F.lit(0.1).alias("std"), F.lit(0).alias("min"), F.lit(1).alias("max"), F.array(F.lit(2), F.lit(2)).alias("shape")))).alias("outputs")
    slow = F.when(i % 19 == 0, F.lit("slow")).otherwise(F.col("seconds").cast("string"))
    new = text("task", "sample", F.lit("2").alias("processingVersion"), F.lit("2024-01-01").alias("createdAt"), F.struct(slow.alias("seconds")).alias("timing"), outputs)
    old = text("task", F.col("sample").alias("sampleId"), F.lit("1").alias("version"), F.lit("2024-01-01").alias("createdAt"), slow.alias("seconds"), outputs)
    value = F.when(i % 11 == 0, old).otherwise(new)
    texts = e.select(F.concat(F.lit("r/"), i.cast("string")).alias("path"), F.when(i % 13 == 0, F.substr(value, F.lit(1), F.length(value) - 3)).when(i % 17 == 0, "[1, 2]").otherwise(value).alias("value"))
    return runs.run_problems(runs.run_table(texts), e.where("task is not null").select("task", "sample"), "2")


@query(REGIONS + """, size AS (SELECT target, count(*) AS n FROM ok GROUP BY target)
SELECT target, '$.train' AS path FROM size WHERE target % 13 = 0 AND target % 17 > 0 UNION ALL SELECT target, '$.observation_ids.size' FROM size WHERE target % 11 = 0 AND n > 1 AND target % 17 > 0
UNION ALL SELECT target, '$' FROM size WHERE target % 17 = 0 UNION ALL SELECT -1 - target, '$' FROM size WHERE target % 19 = 0""")
def regrouped(spark: SparkSession, d: str) -> DataFrame:
    """The groups of observations made again, against published ones of which some are changed, gone or made up."""
    made, _ = proximity.observation_groups(_regions(spark, d), 100.0)
    made = written(made.select("target", "observation_ids", "train", "validation", "test", F.struct(F.round("g_lat", 6).alias("lat"), F.round("g_lon", 6).alias("lon")).alias("center"), "radius_m"), "groups")
    t = F.col("target")
    shown = made.where(t % 17 != 0).withColumns({"train": F.col("train") + F.when(t % 13 == 0, 1).otherwise(0), "observation_ids": F.when((t % 11 == 0) & (F.size("observation_ids") > 1), F.slice("observation_ids", 2, 1000)).otherwise(F.reverse("observation_ids"))})
    more = made.where(t % 19 == 0).withColumn("target", -1 - t)
    mine = made.withColumn("observation_ids", F.reverse("observation_ids"))
    return differences.differences(mine, shown.unionByName(more), "target")


@query(f"""{fx.with_sql('tile')}, f AS (SELECT CASE WHEN tile_id % 3 > 0 THEN 7 ELSE tile_id % 24 END AS bucket, string_agg(tile_id || ' ' || kind || ' ' || split || repeat('.', 200), chr(10) ORDER BY tile_id) || chr(10) AS t FROM tile GROUP BY ALL),
h AS (SELECT 'bucket=' || bucket AS file, octet_length(encode(t)) AS bytes, sha256(t) AS sha256, bucket FROM f)
SELECT file, bytes, sha256, CASE WHEN bucket % 5 = 1 THEN 'unlisted' WHEN bucket % 5 = 2 THEN 'changed' END AS why FROM h UNION ALL SELECT 'bucket=' || (bucket + 100), NULL, NULL, 'missing' FROM h WHERE bucket % 5 = 3""")
def file_checksums(spark: SparkSession, d: str) -> DataFrame:
    """Files of very different sizes, hashed whole or piece by piece, against a list that lacks some, names others, or has other checksums."""
    t = fx.tiles(spark, d)
    bucket = F.when(F.col("tile_id") % 3 > 0, 7).otherwise(F.col("tile_id") % 24).cast("int")
    lines = t.select(bucket.alias("bucket"), "tile_id", F.concat_ws(" ", F.col("tile_id").cast("string"), "kind", F.concat("split", F.lit("." * 200))).alias("line"))
    path = new_path(spark, "files")
    lines.repartition("bucket").sortWithinPartitions("bucket", "tile_id").select("bucket", "line").write.partitionBy("bucket").text(path)
    found = collections.inventory(spark, path, whole=8192)
    found = written(found.where(F.contains("path", F.lit(".txt"))).withColumn("path", F.regexp_extract("path", "bucket=[0-9]+", 0)), "inventory")
    n = F.regexp_extract("path", "[0-9]+", 0).cast("int")
    listed = found.where(n % 5 != 1).withColumn("sha256", F.when(n % 5 == 2, "0").otherwise(F.col("sha256")))
    listed = listed.unionByName(found.where(n % 5 == 3).withColumn("path", F.concat(F.lit("bucket="), (n + 100).cast("string"))))
    return found.join(collections.inventory_differences(found, listed), "path", "full_outer").select(F.col("path").alias("file"), "bytes", "sha256", "why")
