"""Identifiers and texts: ids from names, claim lint, mock markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: The forms of public ids.
ID_PATTERN = {"crater-detection": r"^wac-[a-z0-9]+-r\d+-c\d+$", "ice-prospectivity": r"^ice-[ns]-\d{4}-\d{4}$", "imp-segmentation": r"^imp-[a-z0-9]+-t\d+-i\d+$"}


def crater_region_id(sample: Column) -> Column:
    """``wac-product-row-col`` of ``PRODUCT_row_col``; null for names of other parts."""
    p = F.split(sample, "_")
    return F.when(F.size(p) == 3, F.concat_ws("-", F.lit("wac"), F.lower(F.get(p, F.lit(0))), F.get(p, F.lit(1)), F.get(p, F.lit(2))))


def pole_of_name(sample: Column) -> Column:
    """The pole that a polar patch's name tells by its end; null where it does not."""
    return F.when(sample.endswith("_S_80S"), "south").when(sample.endswith("_80N") & ~sample.contains("_S_"), "north")


def sector_id(sample: Column) -> Column:
    """``ice-n-row-col`` or ``ice-s-row-col``; null where the name does not tell the pole."""
    p = F.split(sample, "_")
    return F.concat(F.lit("ice-"), F.substring(pole_of_name(sample), 1, 1), F.lit("-"), F.get(p, F.lit(1)), F.lit("-"), F.get(p, F.lit(2)))


#: Fixed value: the form of the names of segmentation samples.
IMP_SAMPLE = r"^(M\d+[LR]E)\.ech\.cog__target_(\d+)__idx_(\d+)_p0$"


def imp_region_id(sample: Column) -> Column:
    """``imp-product-tN-iN``; null where the name does not match as a whole."""
    part = lambda i: F.regexp_extract(sample, IMP_SAMPLE, i)
    return F.when(F.regexp_like(sample, F.lit(IMP_SAMPLE)), F.concat(F.lit("imp-"), F.lower(part(1)), F.lit("-t"), part(2), F.lit("-i"), part(3)))


def target_id(tile: Column) -> Column:
    """The target number in a source tile's name; null where it has none."""
    return F.nullif(F.regexp_extract(tile, r"target_(\d+)", 1), F.lit(""))


def sample_of(tile: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(tile, r"\.tif$", ""), r"_img$", "")


def product_id(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def pole_violations(rows: DataFrame, *poles: str) -> DataFrame:
    """Rows whose sources of the hemisphere do not all say the same."""
    first = F.col(poles[0])
    same = F.lit(True)
    for p in poles[1:]:
        same = same & first.eqNullSafe(F.col(p))
    return rows.where(~same | first.isNull())


def id_violations(rows: DataFrame) -> DataFrame:
    """(task, id) that break their task's pattern; unknown tasks do."""
    ok = F.lit(False)
    for task, pattern in ID_PATTERN.items():
        ok = F.when(F.col("task") == task, F.col("id").rlike(pattern)).otherwise(ok)
    return rows.where(~F.coalesce(ok, F.lit(False)))


def is_synthetic(id_: Column, tile: Column, version: Column, revision: Column) -> Column:
    """Whether an object carries a mock marker in its id or its provenance."""
    marks = (id_.startswith("mock-"), F.upper(tile).startswith("MOCK"), version.startswith("mock"), revision == "mock")
    out = F.lit(False)
    for m in marks:
        out = out | F.coalesce(m, F.lit(False))
    return out


#: Phrases that may stand only where they are denied, and the words that deny them.
CLAIMS = ("confirmed crater", "discovered crater", "new crater", "verified crater", "probability of ice", "ice probability", "active volcano", "measurement of ice")
NEGATIONS = ("not", "never", "no", "isn't", "rather than", "instead of")


def claim_hits(texts: DataFrame, phrases: tuple[str, ...] = CLAIMS, negations: tuple[str, ...] = NEGATIONS, reach: int = 40, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, phrase, position): forbidden phrases in a text that no negation precedes within ``reach`` characters; positions from 0.

    Every place of a phrase is looked at, in the lower-cased whole text. The texts are cut at the phrase, so a text is scanned once a phrase.
    """
    low = texts.select(F.col(id_col).alias("id"), F.lower(text_col).alias("t"))
    each = low.select("id", "t", F.explode(F.array(*[F.lit(p) for p in phrases])).alias("phrase")).where(F.instr(F.col("t"), F.col("phrase")) > 0)
    parts = F.call_function("split", F.col("t"), F.concat(F.lit(r"\Q"), F.col("phrase"), F.lit(r"\E")))
    ends = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda n: F.aggregate(F.slice("parts", 1, n), F.lit(0), lambda a, x: a + F.length(x)) + (n - 1) * F.length("phrase"))
    hits = each.withColumn("parts", parts).select("id", "phrase", "t", F.explode(ends).alias("position"))
    before = F.substring(F.col("t"), F.greatest(F.col("position") - reach + 1, F.lit(1)), F.least(F.lit(reach), F.col("position")))
    negated = F.lit(False)
    for n in negations:
        negated = negated | before.contains(n)
    return hits.where(~negated).select("id", "phrase", "position")
