"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.llm import decontaminate, forest, jaccard, languages, licenses, media, merkle, packing, pii, prefixes, quality, sql, suffixes, urlrules
from tilewright.sources.scratch import written
from tilewright.sources.shipping import shipped


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), depth=50)


#: host, path, action
URL_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlrules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_media(_table(spark, sf_dir, "documents"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = languages.remainder(F.col("doc_id"), 3) == 1
    model = languages.fit(docs.where(~held_out))
    return languages.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "langs", "shares")


def pseudonym_key(spark: SparkSession) -> str:
    """The setting ``spark.tilewright.pii.key``; without it a key for trials, which keeps nothing secret."""
    return spark.conf.get("spark.tilewright.pii.key", "trial key")


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, pseudonym_key(spark)).select("doc_id", "text", F.size("pii").alias("n_pii"), "pii")


def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), size=1024)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; labels of held-out documents are not learnt from.

    A document with several labels counts as labelled by the larger one. Rows with a null id are scored but not learnt from.
    """
    x = written(quality.features(docs), "statistics")
    held_out = languages.remainder(F.col("doc_id"), 5) == 0
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    trees = quality.fit(x.where(~held_out).join(known, "doc_id"))
    return quality.score(x, trees).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op11_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.forest_groups(_table(spark, sf_dir, "documents"), k=4, num=80, den=100)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = written(prefixes.encoded(_table(spark, sf_dir, "conversations")), "sequences")
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % 6
    return prefixes.prefix_nodes(prefixes.rebuilt(own, base=c - c % 100, head=head.cast("int"), most=5))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", sql.UPPER, sql.LOWER)).otherwise(F.col("text"))
    return merkle.manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], presented={"text": text})


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_suffix_dedup, op3_url_rules, op4_media_columns, op5_language_mixture, op6_pseudonyms, op7_jaccard_groups, op8_packing, op9_quality_trees, op10_license_templates, op11_lsh_forest, op12_prefix_trie, op13_merkle_manifest)}

SQL: dict[str, str] = {
    "op2_suffix_dedup": sql.SUFFIX_DEDUP,
    "op7_jaccard_groups": sql.JACCARD_GROUPS,
    "op11_lsh_forest": f"SELECT *, doc_id = component_id AS kept FROM ({sql.groups(4, 80)})",
    "op12_prefix_trie": sql.PREFIX_TRIE,
    "op13_merkle_manifest": sql.MERKLE_MANIFEST,
    "op3_url_rules": f"""
WITH rules(host, path, action) AS (VALUES {', '.join(str(r) for r in URL_RULES)}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, '{urlrules.UPPER}', '{urlrules.LOWER}') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path, row_number() OVER () AS n FROM hosts),
fits AS (SELECT p.n, r.host || r.path AS rule, r.action, row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) AS k
         FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.n = p.n AND f.k = 1
""",
}
