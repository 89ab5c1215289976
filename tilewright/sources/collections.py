"""Sources and sinks of catalogue builds: tile metadata, annotations, split lists, JSON collections, file inventories."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tilewright.sources.documents import read_collection, write_collection  # noqa: F401
from tilewright.sources.shipping import shipped


def tile_metadata(spark: SparkSession, path: str, name: str = "WAC_VIS_TILE") -> DataFrame:
    """Tile metadata with ``sample``, the file name without its folder and ``.nc``."""
    return spark.read.parquet(path).withColumn("sample", F.regexp_replace(F.substring_index(name, "/", -1), r"\.nc$", ""))


def exactly_one(samples: DataFrame, meta: DataFrame) -> DataFrame:
    """(sample, n) of requested samples that have no metadata row, or several."""
    n = samples.select("sample").distinct().join(meta.groupBy("sample").agg(F.count("*").alias("n")), "sample", "left").fillna(0, ["n"])
    return n.where("n <> 1")


def coco(spark: SparkSession, path: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, missing) of an annotation file, for the wanted samples."""
    doc = spark.read.schema("images array<struct<id: long, file_name: string>>, annotations array<struct<image_id: long, bbox: array<double>>>").json(path, multiLine=True)
    images = doc.select(F.explode("images").alias("i")).select(F.col("i.id").alias("image_id"), F.regexp_replace(F.substring_index("i.file_name", "/", -1), r"\.[^.]+$", "").alias("sample")).join(wanted, "sample", "left_semi")
    boxes = doc.select(F.explode("annotations").alias("a")).select("a.image_id", *(F.col("a.bbox")[i].alias(c) for i, c in enumerate("xywh"))).join(images, "image_id", "left_semi")
    return images, boxes, wanted.join(images, "sample", "left_anti")


def split_lists(spark: SparkSession, path: str) -> DataFrame:
    """(sample, split) of a folder of list files, named by the split, with a sample on each line."""
    rows = spark.read.text(path).select(F.trim("value").alias("sample"), normal_split(F.regexp_extract(F.input_file_name(), r"([^/.]+)\.[^/]*$", 1)).alias("split"))
    return rows.where("sample <> ''")


def normal_split(split: Column) -> Column:
    return F.when(split == "val", "validation").otherwise(split)


def split_conflicts(rows: DataFrame) -> DataFrame:
    """(sample, n, splits) of samples that several lists, or one of them twice, have."""
    return rows.groupBy("sample").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("split")).alias("splits")).where("n > 1")


def patch_listing(paths: DataFrame, pattern: str) -> DataFrame:
    """Distinct patch names that the pattern's first group finds in ``path``."""
    return paths.select(F.regexp_extract("path", pattern, 1).alias("patch")).where("patch <> ''").distinct()


def assembled(layers: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(pixels, violations): pixel tables (patch_id, prow, pcol, grid, value) as one column a layer; patches of differing grids are violations."""
    long = None
    for name, df in layers.items():
        part = df.select("patch_id", "prow", "pcol", "grid", "value", F.lit(name).alias("layer"))
        long = part if long is None else long.unionByName(part)
    bad = long.groupBy("patch_id").agg(F.count_distinct("grid").alias("grids"), F.count_distinct("layer").alias("layers")).where((F.col("grids") > 1) | (F.col("layers") < len(layers)))
    # an explicit number of tasks: pixels are few bytes each in a shuffle and many in a task's aggregates and sorts
    place = ("patch_id", "prow", "pcol")
    dealt = long.join(bad, "patch_id", "left_anti").repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), *place)
    wide = dealt.groupBy(*place).agg(*(F.first(F.when(F.col("layer") == name, F.col("value")), ignorenulls=True).alias(name) for name in layers))
    return wide, bad


def crater_map(spark: SparkSession, path: str, range_bytes: int | None = None) -> DataFrame:
    """(region_id, idx, lat, lon, diameter_km, score, truncated, matched) of a JSON object of arrays of number arrays."""
    entries = read_collection(spark, path, **({"range_bytes": range_bytes} if range_bytes else {}))
    rows = entries.select(F.col("key").alias("region_id"), F.posexplode(F.from_json("value", "array<array<double>>")).alias("idx", "v"))
    names = ("lat", "lon", "diameter_km", "score", "truncated", "matched")
    return rows.select("region_id", "idx", *((F.col("v")[i].cast("int") if n in ("truncated", "matched") else F.col("v")[i]).alias(n) for i, n in enumerate(names)))


#: Bytes up to which a file is hashed as one value; larger ones are read by a task, a piece at a time.
WHOLE = 32 << 20


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths with the SHA-256 of their files, of which a task holds one piece at a time."""
    for batch in batches:
        out = []
        for path in batch.column(0).to_pylist():
            files, name = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with files.open_input_stream(name) as file:
                while piece := file.read(1 << 20):
                    digest.update(piece)
            out.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["path", "bytes", "sha256"])


def inventory(spark: SparkSession, path: str, whole: int = WHOLE) -> DataFrame:
    """(path, bytes, sha256) of the files below a folder, each read by the task that hashes it, of any size."""
    files = shipped(spark).read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.where(F.col("length") <= whole).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path", F.col("length").alias("bytes"))  # without content: nothing is read yet
    return small.unionByName(large.repartition("path").mapInArrow(_hashed, "path string, bytes long, sha256 string"))


def inventory_differences(found: DataFrame, listed: DataFrame) -> DataFrame:
    """(path, why): files that the list lacks, listed files that are gone, and those whose checksum differs."""
    both = found.select("path", F.col("sha256").alias("a")).join(listed.select("path", F.col("sha256").alias("b")), "path", "full_outer")
    why = F.when(F.col("b").isNull(), "unlisted").when(F.col("a").isNull(), "missing").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", why.alias("why")).where("why IS NOT NULL")


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def publish(df: DataFrame, path: str, problems: DataFrame) -> None:
    """Replaces one published table, unless there are problems; several at once are the work of ``builds.publish``."""
    if not problems.isEmpty():
        raise ValueError("the build has problems; nothing was published")
    df.write.mode("overwrite").parquet(path)


def display_dropped(sectors: DataFrame, parent: str = "heatmap", field: str = "display_path") -> DataFrame:
    """Sectors whose nested path of the display raster is null, all else as it was."""
    return sectors.withColumn(parent, F.col(parent).withField(field, F.lit(None).cast("string")))
