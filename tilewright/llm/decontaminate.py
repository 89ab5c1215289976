"""Benchmark decontamination with DataFrame functions only: SimHash of item-sized windows and multi-index Hamming blocks.

An item of m shingles is looked for in windows of m shingles; a text of fewer shingles is one window. Windows are laid at every
place where at least half as many shingles of items of that size stand as a match needs; a window with fewer cannot match. Each
window's 64-bit SimHash is cut into blocks. Two fingerprints that differ in at most ``RADIUS`` bits differ in at most ``NEAR``
bits in some block, so joining each block with all values within ``NEAR`` bits of each block of the other side, the smaller of
the two, yields every pair within the radius. A block of 16 bits has 2,517 such values of 65,536, so four blocks emit about 15 of
100 pairs of unlike fingerprints. Pairs within the radius are verified by the exact similarity of their weighted shingles: the sum
of the smaller counts over the sum of the larger ones.

A pair just at the similarity asked for (0.8) differs in about 10 bits of 64, with a deviation of 3; the radius is 19. Fingerprints
of few shingles spread wider: items of fewer than ``FEW`` shingles are compared with every window that holds one of their rarest
shingles, so many that no match can do without all of them, and lose nothing to the radius.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from tilewright.llm.keys import row_key
from tilewright.sources.scratch import written

#: A SimHash has 64 bits in BLOCKS blocks; each is joined within NEAR bits, which finds all within RADIUS bits.
BLOCKS, NEAR = 4, 4
BITS = 64 // BLOCKS
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Items of fewer shingles are compared without regard to the distance of fingerprints.
FEW = 32
#: Rows up to which the benchmark's shingles, or the ids of documents with windows, are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000


def with_words(rows: DataFrame, text: str, *kept: str) -> DataFrame:
    """The kept columns and ``words``: the hashes of the text's lower-cased runs of ASCII letters and digits and of other
    than ASCII characters. A step of its own, so that what follows does not split the text anew for each word."""
    found = F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return rows.select(*kept, F.transform(F.filter(found, lambda w: w != ""), lambda w: F.xxhash64(w)).alias("words"))


def shingle_hashes(k: int) -> Column:
    """The hash of each k consecutive ``words``; none if there are fewer."""
    n = F.size("words")
    return F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice("words", i, k)))).otherwise(F.array().cast("array<bigint>"))


def _majority(grams: Column, width: int) -> Column:
    """The bits that more than half of the numbers have, counted at once in lanes of ``width`` bits of one number."""
    lanes, most = sum(1 << (width * i) for i in range(64 // width)), 2**width - 1
    out = F.lit(0).cast("long")

    def add(b: int):
        return lambda a, g: a + F.shiftrightunsigned(g, b).bitwiseAND(F.lit(lanes))

    for b in range(width):
        counts = F.aggregate(grams, F.lit(0).cast("long"), add(b))
        for lane in range(64 // width):
            count = F.shiftrightunsigned(counts, width * lane).bitwiseAND(F.lit(most))
            out = out.bitwiseOR(F.shiftleft((count * 2 > F.size(grams)).cast("long"), width * lane + b))
    return out


def simhash(grams: Column) -> Column:
    """64 bits, each set if more than half of the shingles, repeated ones counted anew, have it set."""
    return F.when(F.size(grams) < 2**16, _majority(grams, 16)).otherwise(_majority(grams, 32))


def _masks() -> list[int]:
    return [sum(1 << i for i in c) for n in range(NEAR + 1) for c in itertools.combinations(range(BITS), n)]


def _block(fingerprint: Column, i: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, i * BITS).bitwiseAND(F.lit(2**BITS - 1))


def _blocks(df: DataFrame, fp: str) -> DataFrame:
    return df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))).withColumn("v", _block(F.col(fp), F.col("i")))


def _repeated(grams: Column) -> Column:
    """The distinct values that an array has more than once."""
    after = lambda o: F.filter(o, lambda x, i: (i > 0) & (F.get(o, i - 1) == x))
    return F.array_distinct(F.get(F.transform(F.array(F.array_sort(grams)), after), F.lit(0)))


def weighted_common(a: Column, b: Column) -> Column:
    """The sum of the smaller counts of the values of two arrays."""
    count = lambda c, g: F.size(F.filter(c, lambda x: x == g))
    more = F.aggregate(F.array_intersect(_repeated(a), _repeated(b)), F.lit(0), lambda s, g: s + F.least(count(a, g), count(b, g)) - 1)
    return F.size(F.array_intersect(a, b)) + more


def windows_of(docs: DataFrame, items: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, m, size, p): the windows of ``size`` shingles from shingle ``p`` on that are compared with items of m shingles."""
    known = items.select("m", F.explode("grams").alias("g")).groupBy("g").agg(F.collect_set("m").alias("ms"))
    n_known = items.agg(F.sum("m")).first()[0] or 0
    counted = with_words(docs, "text", "doc_id").withColumn("n", F.greatest(F.size("words") - (k - 1), F.lit(0)))
    placed = counted.select("doc_id", "n", F.posexplode(shingle_hashes(k)).alias("p", "g"))
    hits = placed.join(F.broadcast(known) if n_known <= BROADCAST_ROWS else known, "g").select("doc_id", "n", F.explode("ms").alias("m"), "p")
    # common * (100 + percent) >= percent * (size + m): half of the hits that this asks for
    need = F.expr(f"cast(greatest(1, ceil({percent} * (size + m) / {2 * (100 + percent)})) as int)")
    rows = hits.groupBy("doc_id", "n", "m").agg(F.sort_array(F.collect_set("p")).alias("at")).withColumn("size", F.least("n", "m")).withColumn("need", need).where(F.size("at") >= F.col("need"))
    at = lambda i: F.get("at", i)
    # the windows whose first hit is hit i: they begin after the hit before it, and hold the need-th hit from it on
    low = lambda i: F.greatest(F.coalesce(at(i - 1) + 1, F.lit(0)), at(i + F.col("need") - 1) - F.col("size") + 1, F.lit(0))
    high = lambda i: F.least(at(i), F.col("n") - F.col("size"))
    firsts = F.filter(F.sequence(F.lit(0), F.size("at") - F.col("need")), lambda i: low(i) <= high(i))
    return rows.select("doc_id", "m", "size", F.explode(F.flatten(F.transform(firsts, lambda i: F.sequence(low(i), high(i))))).alias("p")).distinct()


def _rarest(items: DataFrame, percent: int) -> DataFrame:
    """(m, g, item_id, item_fp): of each item so many of its rarest shingles that a window without any of them cannot match it."""
    listed = items.select("item_id", "m", "fp", F.explode("grams").alias("g"))
    often = listed.groupBy("g").agg(F.count("*").alias("n"))
    held = listed.join(often, "g").groupBy("item_id", "m", "fp").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("by"))
    # a match shares percent of the m shingles at least, repeated ones counted anew
    first = F.slice("by", F.lit(1), F.col("m") - F.expr(f"cast(ceil({percent} * m / 100) as int)") + 1)
    return held.select("m", F.explode(F.array_distinct(F.transform(first, lambda x: x["g"]))).alias("g"), "item_id", F.col("fp").alias("item_fp"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, similarity, distance, first_word): each document and item with a window at least so similar.

    The best window stands for the pair, of equals the first. Shingles have ``k`` words; items of fewer than ``k`` words are
    too short to be told apart and match nothing, as do null and empty texts. Rows with null ids are left out; repeated rows
    give one row per pair of ids. Empty tables give an empty result. Other columns are not looked at. Documents or items
    that share an id count as one with several texts. Texts and items may be of any length; an item of m words that stands
    in a document costs about m windows of m shingles there.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    items = with_words(benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("item_id is not null"), "text", "item_id")
    items = items.select("item_id", shingle_hashes(k).alias("grams")).where("size(grams) > 0")
    items = written(items.select("item_id", "grams", F.size("grams").alias("m"), simhash(F.col("grams")).alias("fp")), "items")
    starts = written(windows_of(docs, items, k, percent), "windows")

    def cut(places: DataFrame) -> DataFrame:
        """The places with ``own``, the shingles of their windows, taken from the texts anew."""
        of = places.select("doc_id").distinct()
        near = docs.join(F.broadcast(of) if of.count() <= BROADCAST_ROWS else of, "doc_id", "left_semi")
        near = with_words(near, "text", "doc_id").select("doc_id", shingle_hashes(k).alias("all"))
        return near.join(places, "doc_id").withColumn("own", F.slice("all", F.col("p") + 1, F.col("m"))).drop("all").where("size(own) = size")

    windows = written(cut(starts).select("doc_id", "m", "p", "size", simhash(F.col("own")).alias("fp"), F.when(F.col("m") < FEW, F.array_distinct("own")).alias("own")), "fingerprints")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    small = windows.where(F.col("m") < FEW).select("doc_id", "m", "p", "size", "fp", F.explode("own").alias("g"))
    direct = small.join(_rarest(items.where(F.col("m") < FEW), percent), ["m", "g"]).select("doc_id", "m", "p", "size", "item_id", apart.alias("distance"))
    few, many = items.where(F.col("m") >= FEW).select("item_id", "m", F.col("fp").alias("item_fp")), windows.where(F.col("m") >= FEW).drop("own")
    spread = lambda rows, fp: _blocks(rows, fp).withColumn("v", F.explode(F.transform(F.array(*[F.lit(x) for x in _masks()]), lambda x: F.col("v").bitwiseXOR(x))))
    # the spread side has thousands of rows for each of its fingerprints: shuffled, never broadcast
    if few.count() <= many.count():
        pairs = _blocks(many, "fp").join(spread(few, "item_fp").hint("merge"), ["m", "i", "v"])
    else:
        pairs = spread(many, "fp").hint("merge").join(_blocks(few, "item_fp"), ["m", "i", "v"])
    pairs = pairs.withColumn("distance", apart).where(F.col("distance") <= RADIUS).select("doc_id", "m", "p", "size", "item_id", "distance")
    pairs = written(pairs.union(direct).distinct(), "pairs")

    # exact similarity of the weighted shingles
    both = cut(pairs).join(items.select("item_id", "m", "grams"), ["item_id", "m"])
    both = both.withColumn("common", weighted_common(F.col("own"), F.col("grams"))).where(F.col("common") * 100 >= percent * (F.size("own") + F.col("m") - F.col("common")))
    found = both.select("doc_id", "item_id", (F.col("common") / (F.size("own") + F.col("m") - F.col("common"))).alias("similarity"), "distance", F.col("p").alias("first_word"))
    best = F.max_by(F.struct("similarity", "distance", "first_word"), F.struct("similarity", -F.col("first_word"), -F.col("distance")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.similarity", F.col("b.distance").cast("int").alias("distance"), "b.first_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose document no item is found, with all their columns; a row with a null id is judged by its text."""
    key = row_key(id_col, text_col)
    found = leaks(docs.select(key.alias("key"), F.col(text_col).alias("text")), benchmark, "key").select(F.col("doc_id").alias("_key")).distinct()
    return docs.withColumn("_key", key).join(found, "_key", "left_anti").drop("_key")
