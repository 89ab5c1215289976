"""Curation, the append-only registry, catalogue statistics, and tables kept by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.functions import geo, scoring, selection
from tilewright.sources.scratch import written

ID_PATTERN = r"^MM-(CR|ICE|IMP)-\d{6}$"
PREFIX = {"CRATER_CANDIDATE": "MM-CR", "HIGH_PROSPECTIVITY_REGION": "MM-ICE", "IMP_CANDIDATE": "MM-IMP"}
MOST_NUMBER = 999_999


def crater_candidates(craters: DataFrame) -> DataFrame:
    """(category, ord, ...): craters (tile_id, idx, lat, lon, diameter_km, score, truncated, matched) in the orders of the three
    categories; ties go by tile and index. Candidates are ranked when they are picked, so no global order is made here."""
    keep = F.col("truncated") == 0
    diameter, score = F.col("diameter_km"), F.col("score")
    zero = F.lit(0.0)
    large = craters.where(keep & (score >= 0.9)).withColumns({"category": F.lit("large"), "o1": -diameter, "o2": -score})
    high = craters.where(keep & (diameter >= 3) & (score >= 0.99)).withColumns({"category": F.lit("high-confidence"), "o1": -score, "o2": zero})
    lone = craters.where(keep & (diameter >= 3) & (score >= 0.9) & (F.col("matched") == 0)).withColumns({"category": F.lit("unmatched-high-confidence"), "o1": -score, "o2": zero})
    return reduce(DataFrame.unionByName, [large, high, lone])


def ranked(candidates: DataFrame, order: list[str], by: str = "category") -> DataFrame:
    """``candidates`` with ``place``, from 1, in the order of their columns ``order`` among those of the same ``by``. The columns tell all
    rows of a ``by`` apart. Places are counted by ranges and added, so that no task sees a whole ``by``."""
    rows = candidates.withColumns({"_key": F.struct(*order), "_n": F.lit(1)})
    placed = scoring.running_total(rows, "_key", "_n", "_below", by=(by,))
    return placed.withColumn("place", F.col("_below") + 1).drop("_key", "_n", "_below")


def spaced(candidates: DataFrame, order: list, km: float, limit: int, taken: list[tuple[float, float]] = (), batch: int = 256) -> list:
    """At most ``limit`` rows, in order: each one at least ``km`` from all rows picked before it and from ``taken``.

    Rows too close to a pick are filtered on the cluster and only the first ``batch`` of what is left comes to the driver,
    where they are picked in turn; a prefix of the ordered rows decides as all of them would. Rounds end with the limit.
    """
    picks, done = [], list(taken)
    import math

    def far(a, b) -> bool:
        p, q = math.radians(a[0]), math.radians(b[0])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * geo.RADIUS * math.asin(math.sqrt(min(1.0, max(0.0, h)))) >= km * 1000

    while len(picks) < limit:
        rows = candidates
        if done:
            near = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in done])
            rows = rows.where(~F.exists(near, lambda t: geo.distance_m(F.col("lat"), F.col("lon"), t["a"], t["b"]) < km * 1000))
        head = rows.orderBy(*order).limit(batch).collect()
        before = len(picks)
        for r in head:
            if len(picks) < limit and all(far((r["lat"], r["lon"]), t) for t in done):
                picks.append(r)
                done.append((r["lat"], r["lon"]))
        if len(head) < batch or len(picks) == before:
            break
    return picks


def curated(candidates: DataFrame, categories: list[str], order: list, km: float, limit: int) -> DataFrame:
    """(pass, category, pick, ...): test candidates of all categories first, then the others, each pass spaced from all picks."""
    candidates = written(candidates, "candidates")  # looked at once for each pass and category
    out, taken = [], []
    for n, held_out in enumerate((F.col("split") == "test", F.col("split") != "test")):
        for c in categories:
            got = spaced(candidates.where((F.col("category") == c) & held_out), order, km, limit, taken)
            taken += [(r["lat"], r["lon"]) for r in got]
            out += [(n, k, *r) for k, r in enumerate(got)]
    schema = candidates.schema
    head = [("pass", "int"), ("pick", "int")]
    ddl = ", ".join(f"{a} {b}" for a, b in head) + ", " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return candidates.sparkSession.createDataFrame(out, ddl)


def diameter_analysis(craters: DataFrame, picks: DataFrame, shares: list[float]) -> DataFrame:
    """One row: whole craters, quantiles of their diameters and how many reach the 99th percentile, and of the curated ``picks``
    their number, the range of their percentile ranks and of their diameters (null without picks). An empty catalogue has nulls."""
    whole = written(craters.where("truncated = 0").select("diameter_km"), "diameters")
    n, q = selection.quantiles(whole, "diameter_km", [*shares, 0.99])
    x = F.col("diameter_km")
    ends = picks.agg(F.count("*").alias("curated"), F.min("diameter_km").alias("d_min"), F.max("diameter_km").alias("d_max")).first()
    rank = lambda d: (100 * (F.count_if(x < d) + 0.5 * F.count_if(x == d)) / F.lit(n)) if n and d is not None else F.lit(None).cast("double")
    number = lambda v, name: F.lit(None if v is None else round(v, 3)).cast("double").alias(name)
    row = whole.agg(F.count("*").alias("population"), F.count_if(x >= F.lit(q[-1])).alias("at_or_above_p99"), rank(ends["d_min"]).alias("rank_min"), rank(ends["d_max"]).alias("rank_max"))
    return row.select("population", *(number(v, f"p{100 * p:g}".replace(".", "_")) for p, v in zip(shares, q[:-1], strict=True)), "at_or_above_p99", F.lit(ends["curated"]).alias("curated"), F.round("rank_min", 2).alias("rank_min"), F.round("rank_max", 2).alias("rank_max"),
                      number(ends["d_min"], "diameter_min"), number(ends["d_max"], "diameter_max"))


def primaries(groups: DataFrame, regions: DataFrame) -> DataFrame:
    """(target, region_id, area_m2): of each observation group the first region, in the group's order, that has a score."""
    each = groups.select("target", F.posexplode("observation_ids").alias("k", "region_id")).join(regions.where("score IS NOT NULL").select("region_id", "area_m2"), "region_id")
    return each.groupBy("target").agg(F.min_by(F.struct("region_id", "area_m2"), "k").alias("p")).select("target", "p.*")


def crater_key(dataset: Column, tile: Column, checkpoint: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """The identity of a detection: where it was found, by what, and its box's centre and size in whole pixels."""
    box = F.concat_ws(",", *[F.rint(v).cast("int").cast("string") for v in (x + w / 2, y + h / 2, w, h)])
    return F.concat(F.concat_ws("|", F.lit("crater-detection"), dataset, tile.cast("string"), checkpoint), F.lit("|box="), box)


def region_key(task: Column, dataset: Column, tile: Column) -> Column:
    """The identity of a fixed region: its values may change with a model, its key does not."""
    return F.concat_ws("|", task, dataset, tile.cast("string"))


def box_of(key: Column) -> Column:
    return F.transform(F.split(F.substring_index(key, "box=", -1), ","), lambda v: v.cast("int"))


def _prefix() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv]), F.col("type"))


def _numbered(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """(type, key, prefix, number) of the requested keys that the registry lacks, in key order after the largest of their prefix."""
    top = registry.groupBy(F.regexp_extract("id", r"^(.*)-\d+$", 1).alias("prefix")).agg(F.max(F.regexp_extract("id", r"(\d+)$", 1).cast("int")).alias("top"))
    asked = requests.select("type", "key").distinct().withColumn("prefix", _prefix()).where("prefix IS NOT NULL AND key IS NOT NULL")
    one = asked.groupBy("key").agg(F.min("type").alias("type"), F.min("prefix").alias("prefix"))  # of a key with several types the first; the rest is a conflict
    new = one.join(registry.select("key"), "key", "left_anti")
    new = ranked(new, ["key"], by="prefix").join(top, "prefix", "left")  # by ranges of keys: a prefix is no task
    return new.select("type", "key", "prefix", (F.coalesce("top", F.lit(0)) + F.col("place")).alias("number"))


def registry_assign(registry: DataFrame, requests: DataFrame, date: str) -> DataFrame:
    """The registry (id, type, key, first_catalogued) with an entry for each requested (type, key) that it lacks.

    Known keys keep their ids. New keys get, in key order, the numbers after the largest of their prefix. Requests of unknown
    types, and those beyond the largest number, get no entry; ``request_violations`` lists them.
    """
    new = _numbered(registry, requests).where(F.col("number") <= MOST_NUMBER)
    entries = new.select(F.format_string("%s-%06d", "prefix", "number").alias("id"), "type", "key", F.lit(date).alias("first_catalogued"))
    return registry.select("id", "type", "key", "first_catalogued").unionByName(entries)


def request_violations(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests that cannot be met: of an unknown type, of a key that is registered or also requested as another type, and those for
    which a prefix has no number left."""
    asked = requests.select("type", "key").distinct()
    known = registry.select("key", F.col("type").alias("registered"))
    several = asked.where(_prefix().isNotNull()).groupBy("key").agg(F.countDistinct("type").alias("n"), F.array_join(F.sort_array(F.collect_set("type")), ",").alias("types")).where("n > 1")
    return reduce(DataFrame.unionByName, [
        _rule(asked.where(_prefix().isNull()), "registry-unknown-type", "key", F.coalesce("type", F.lit(""))),
        _rule(asked.where(_prefix().isNotNull()).join(known, "key").where("type <> registered"), "registry-type-conflict", "key", F.concat_ws("/", "registered", "type")),
        _rule(several, "registry-type-conflict", "key", F.col("types")),
        _rule(_numbered(registry, requests).where(F.col("number") > MOST_NUMBER), "registry-full", "key", F.col("prefix")),
    ])


def _rule(df: DataFrame, rule: str, object_: str = "id", message: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule_id"), F.col(object_).cast("string").alias("object_id"), (message if message is not None else F.lit("")).alias("message"))


def registry_violations(registry: DataFrame) -> DataFrame:
    """Entries whose id, type or date is malformed, and ids or keys that stand twice."""
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv]), F.col("type"))
    twice = lambda c: registry.groupBy(c).agg(F.count("*").alias("n")).where("n > 1")
    return reduce(DataFrame.unionByName, [
        _rule(registry.where(~F.col("id").rlike(ID_PATTERN)), "registry-id"),
        _rule(registry.where(prefix.isNull() | ~F.col("id").startswith(F.coalesce(prefix, F.lit("?")))), "registry-type", message=F.coalesce("type", F.lit(""))),
        _rule(registry.where(F.try_to_timestamp("first_catalogued", F.lit("yyyy-MM-dd")).isNull()), "registry-date"),
        _rule(twice("id"), "registry-id-unique"), _rule(twice("key"), "registry-key-unique", "key"),
    ])


def append_only_violations(old: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of the old registry that the new one has changed or lost."""
    return _rule(old.join(new, ["id", "type", "key", "first_catalogued"], "left_anti"), "registry-append-only", message=F.col("key"))


def registry_entries(registry: DataFrame, prefix: str) -> DataFrame:
    return registry.where(F.col("key").startswith(prefix))


def identity_drift(registry: DataFrame, current: DataFrame, px: int = 2) -> DataFrame:
    """Registered box keys that are gone while a current box of the same tile is within ``px`` on all four numbers."""
    tile = lambda c: F.substring_index(c, "box=", 1)
    gone = registry.join(current.select("key").distinct(), "key", "left_anti").where(F.col("key").contains("box=")).select("id", "key", tile(F.col("key")).alias("tile"), box_of(F.col("key")).alias("o"))
    now = current.select(F.col("key").alias("now"), tile(F.col("key")).alias("tile"), box_of(F.col("key")).alias("b")).distinct()
    near = reduce(lambda a, b: a & b, [F.abs(F.col("o")[i] - F.col("b")[i]) <= px for i in range(4)])
    return gone.join(now, "tile").where(near).groupBy("id", "key").agg(F.min("now").alias("near"))


def upsert(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``base`` with the rows of ``delta`` in place of those of the same key."""
    return base.join(delta.select(key), key, "left_anti").unionByName(delta)


def describe(craters: DataFrame) -> DataFrame:
    """Craters with the name of their quarter of the Moon and a sentence on what was found there."""
    side = F.when(F.abs("lon") <= 90, "NEARSIDE").otherwise("FARSIDE")
    half = F.when(F.col("lat") >= 0, "NORTHERN").otherwise("SOUTHERN")
    text = F.concat(F.format_string("Model detection of a crater-like feature, %s km across, at confidence %s.", F.format_number("diameter_km", 2), F.format_number("score", 2)),
                    F.when(F.col("matched") == 0, " No reference annotation overlaps it.").otherwise(""), F.when(F.col("split") != "test", " The tile was part of the training or validation data.").otherwise(""))
    return craters.withColumns({"region": F.concat(side, F.lit(" · "), half, F.lit(" HEMISPHERE")), "description": text})


def discoveries(picks: DataFrame) -> DataFrame:
    """Picked craters as records with their metrics; ``featured`` if of the test split. A metric has a number or a flag."""
    none, number = F.lit(None), lambda c: F.col(c).cast("double")

    def metric(key: str, label: str, value, flag, unit: str | None, origin: str):
        return F.struct(F.lit(key).alias("key"), F.lit(label).alias("label"), value.cast("double").alias("value"), flag.cast("boolean").alias("value_bool"), F.lit(unit).cast("string").alias("unit"), F.lit(origin).alias("origin"))

    metrics = F.array(metric("confidence", "CONFIDENCE", number("score"), none, None, "model_prediction"), metric("diameter", "DIAMETER", number("diameter_km"), none, "km", "model_prediction"),
                      metric("referenceMatch", "REFERENCE MATCH", none, F.col("matched") == 1, None, "derived_metric"))
    return describe(picks).withColumns({"featured": F.col("split") == "test", "metrics": metrics})


def polar_candidates(sectors: DataFrame) -> DataFrame:
    """Sectors (region_id, pole, score, lat, lon of their anchor, split) in curation order; those without an anchor are left out."""
    return sectors.where("lat IS NOT NULL AND lon IS NOT NULL").withColumns({"category": F.col("pole"), "o1": -F.col("score"), "o2": F.lit(0.0)})


def duplicate_keys(rows: DataFrame, key: str = "key") -> DataFrame:
    return _rule(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1"), "duplicate-identity", key, F.col("n").cast("string"))


def global_stats(objects: DataFrame) -> DataFrame:
    """(task, split, objects, predictions, high_interest) for each task and split, each of them, and all: grouping sets."""
    rows = objects.cube("task", "split").agg(F.count("*").alias("objects"), F.sum("predictions").alias("predictions"), F.count_if(F.col("score") >= 80).alias("high_interest"), F.grouping_id().alias("level"))
    return rows.fillna("all", ["task", "split"])


SPLITS = ("train", "validation", "test", "external")
#: The tasks of objects and the types of discoveries, with their names in the statistics.
TASKS = {"crater-detection": "crater", "ice-prospectivity": "ice", "imp-segmentation": "imp"}
TYPES = {"CRATER_CANDIDATE": "crater", "HIGH_PROSPECTIVITY_REGION": "ice", "IMP_CANDIDATE": "imp"}


def build_stats(objects: DataFrame, discoveries: DataFrame, groups: DataFrame, references: DataFrame, sources: DataFrame) -> DataFrame:
    """One row of what a build holds, from objects (task, split, pole, predictions, area_m2, score, dataset, model), discoveries (type,
    featured), observation groups, reference boxes and sources (id, kind): objects in all and by task, pole and split, what models
    predicted, regions of high interest (a score of 80 or more), discoveries by type, references, and the datasets and models in use.

    Each table is aggregated once; empty tables count as 0.
    """
    task = lambda t: F.col("task") == t
    crater, ice, imp = map(task, TASKS)
    amount = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = objects.agg(
        F.count("*").alias("regions_analyzed"), F.count_if(crater).alias("crater_regions"), amount(F.when(crater, F.col("predictions"))).alias("crater_detections"), F.count_if(ice & (F.col("pole") == "north")).alias("patches_north"),
        F.count_if(ice & (F.col("pole") == "south")).alias("patches_south"), F.count_if(imp).alias("imp_tiles"), F.count_if(imp & (F.col("area_m2") > 0)).alias("imp_candidates"),
        (amount(F.when(crater, F.col("predictions"))) + F.count_if(~crater)).alias("model_predictions"), F.count_if(F.col("score") >= 80).alias("high_interest"), *[F.count_if(F.col("split") == s).alias(f"split_{s}") for s in SPLITS],
        F.count_if(ice).alias("reference_maps"), F.count_if(imp).alias("reference_masks"))
    found = discoveries.agg(F.count("*").alias("discoveries"), *[F.count_if(F.col("type") == t).alias(f"discoveries_{n}") for t, n in TYPES.items()], F.count_if("featured").alias("featured"))
    used = objects.select(F.explode(F.array("dataset", "model")).alias("id")).where("id IS NOT NULL").distinct()
    known = sources.join(used, "id", "left_semi").agg(F.count_if(F.col("kind") == "dataset").alias("datasets"), F.count_if(F.col("kind") == "model").alias("models"))
    for other in (found, groups.agg(F.count("*").alias("imp_groups")), references.agg(F.count("*").alias("reference_boxes")), known):
        one = one.crossJoin(F.broadcast(other))  # one row each
    return one


def manifest_counts(objects: DataFrame) -> DataFrame:
    """(task, objects, train, validation, test, external): objects of each task, in all and by split."""
    return objects.groupBy("task").agg(F.count("*").alias("objects"), *[F.count_if(F.col("split") == s).alias(s) for s in SPLITS])


def sources_used(objects: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_id, kind, revision, objects) of each model and dataset that objects (model, dataset) name; the revision is null
    for sources that are not listed."""
    named = F.explode(F.array(F.struct(F.lit("model").alias("kind"), F.col("model").alias("source_id")), F.struct(F.lit("dataset").alias("kind"), F.col("dataset").alias("source_id")))).alias("s")
    used = objects.select(named).where("s.source_id IS NOT NULL").groupBy("s.kind", "s.source_id").agg(F.count("*").alias("objects"))
    return used.join(sources.select("kind", "source_id", "revision"), ["kind", "source_id"], "left")


def decision_inputs(items: DataFrame, kilobytes: dict[str, float]) -> DataFrame:
    """(task, added, test_places, places, storage_mb) of items (task, split, place): what publishing the train and validation
    splits too would add, in items, in places beyond those of the test split, and in storage."""
    size = F.element_at(F.create_map(*[F.lit(x) for kv in kilobytes.items() for x in kv]), F.col("task"))
    rows = items.groupBy("task").agg(F.count_if(F.col("split").isin("train", "validation")).alias("added"), F.count_distinct(F.when(F.col("split") == "test", F.col("place"))).alias("test_places"), F.count_distinct("place").alias("places"))
    return rows.withColumn("storage_mb", F.round(F.col("added") * size / 1024, 1))


def with_provenance(objects: DataFrame, runs: DataFrame, pins: DataFrame, version: str) -> DataFrame:
    """Objects (task, sample) with ``provenance`` from their run (task, sample, split, checkpoint, revision) and the pinned
    names (task, model, dataset, reference) of their task; null without a run. The split ``val`` is ``validation``."""
    rows = objects.join(runs.withColumn("_run", F.lit(True)), ["task", "sample"], "left").join(pins, "task", "left")
    fields = F.struct("task", F.col("dataset").alias("source_dataset"), F.col("sample").alias("source_tile"), F.when(F.col("split") == "val", "validation").otherwise(F.col("split")).alias("dataset_split"),
                      "model", "checkpoint", F.col("revision").alias("model_revision"), F.col("reference").alias("reference_source"), F.lit(version).alias("processing_version"))
    return rows.select(*objects.columns, F.when(F.col("_run"), fields).alias("provenance"))
