"""Exact Jaccard join of shingle sets: a size-aware heavy-light join.

Light sets (few shingles) enumerate their fixed-size subsets: two sets link when they share a subset of the size that
their sizes demand, so a shared subset *is* the link and nothing has to be verified. Heavy sets scan inverted lists: only
the lists of a set's rarest shingles have to be scanned, for two similar sets must share one of them. The boundary is the
size at which enumerating subsets begins to cost more than scanning lists, taken from the histogram of set sizes.

Sets that are equal are one class from the start. Lists do not emit pairs: they only say which sets must meet. Groups of sets
that meet are cut into blocks, and blocks are compared; only a spanning tree of what links is emitted. In a group of few blocks
all blocks meet. In a larger one the first block meets all others first, which links most of a group of near copies; only
sets that it has left apart are then compared with the rest, and if they are many, only with those blocks that one of their
lists reaches. So a group of near copies costs copies and edges in proportion to its size, a long chain of sets that meet only
their neighbours costs copies in proportion to its lists, and no link between different texts is lost.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.llm import bytetext as bt
from tilewright.llm.keys import own_id
from tilewright.operators.graph import connected_components
from tilewright.sources.scratch import written

#: Sets up to this size may be light; the boundary itself is found by cost.
LIGHT_MOST = 40
#: Sets compared at once in a task, and bytes of their texts, about; larger groups meet block by block.
BLOCK = 768
BLOCK_BYTES = 32 << 20
#: Groups of at most so many blocks compare all their blocks at once: further passes over the texts would cost more.
FEW_BLOCKS = 32
#: Lists are cut into classes of size, each reaching to so many times its smallest size.
STEP = 1.03

U64 = np.uint64
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False


def least_overlap(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of sets of sizes a and b with den * intersection >= num * union."""
    return -(-num * (a + b) // (num + den))


def prefix_length(n, num: int, den: int):
    """So many of a set's first shingles, in any order common to all sets, hold one of each similar set's."""
    return n + (-num * n // den) + 1


def _sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted 63-bit shingle set of each text of a slice."""
    start, end, text = bt.words(data, off, WORD)
    h, of = bt.shingles(bt.spans_hash(bt.prefix_sums(data, bt.byte_table(True)), start, end), text, k)
    h >>= U64(1)
    at = np.searchsorted(of, np.arange(len(off)))
    for i in range(len(off) - 1):
        yield np.unique(h[at[i] : at[i + 1]])


_PROFILE = "doc_id long, n long, h1 long, h2 long, bytes long, tier array<long>, small array<long>"


def _profiler(k: int, num: int, den: int):
    """Per document: set size, fingerprint of the set, its shingles in the sampled tier, all of them if it is small."""
    bound = U64(min(0.999, 1.3 * (1 - num / den) + 0.01) * 2**63)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bt.column_bytes(batch.column(1))
            for i, j, d, o in bt.slices(data, off):
                rows: list[list] = [[], [], [], [], []]
                for s in _sets(d, o, k):
                    n = len(s)
                    rows[0].append(n)
                    rows[1].append(int(np.bitwise_xor.reduce(bt.mix(s)).view(np.int64)) if n else 0)
                    rows[2].append(int(np.add.reduce(bt.mix(s * U64(5))).view(np.int64)) if n else 0)
                    tier = max(int(np.searchsorted(s, bound)), prefix_length(n, num, den)) if n else 0
                    rows[3].append(s[:tier].view(np.int64))
                    rows[4].append(s.view(np.int64) if n <= LIGHT_MOST else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *(pa.array(x, pa.int64()) for x in rows[:3]), pa.array(np.diff(o), pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in rows[3:])],
                    ["doc_id", "n", "h1", "h2", "bytes", "tier", "small"])

    return profile, int(bound)


# --- light sets -------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=256)
def _left_out(n: int, d: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(n), d)), np.int64).reshape(math.comb(n, d), d)


def subset_sizes(n: int, most: int, num: int, den: int) -> list[int]:
    """The subset sizes that a set of n shingles shares with light sets it may link to."""
    sizes = {least_overlap(n, b, num, den) for b in range(-(-num * n // den), min(most, n * den // num) + 1)}
    return sorted(o for o in sizes if 0 < o <= n)


def subset_count(n: int, most: int, num: int, den: int) -> int:
    return sum(math.comb(n, o) for o in subset_sizes(n, most, num, den))


def boundary(histogram: dict[int, int], num: int, den: int) -> int:
    """The size up to which sets are light, by cost: subsets to enumerate against list entries to move and scan."""
    share = min(1.0, 1.3 * (1 - num / den) + 0.01)
    best, at = None, 0
    for x in range(0, LIGHT_MOST + 1):
        light = sum(c * subset_count(n, x, num, den) for n, c in histogram.items() if n <= x)
        heavy = sum(c * (20 + 4 * (share * n + prefix_length(n, num, den)) + n) for n, c in histogram.items() if den * n >= num * (x + 1))
        if best is None or light + heavy < best:
            best, at = light + heavy, x
    return at


def _light_links(light: DataFrame, most: int, num: int, den: int) -> DataFrame:
    """Links by shared subsets, which are told apart by two sums of 64 bits each."""

    def subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.array(s, np.int64).view(U64)
                sums = [bt.mix(x * U64(7)), bt.mix(x * U64(11))]
                for o in subset_sizes(len(s), most, num, den):
                    out = _left_out(len(s), len(s) - o)
                    a, b = (np.add.reduce(h) - h[out].sum(axis=1, dtype=U64) for h in sums)
                    m = len(a)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, node)), pa.array(np.full(m, len(s))), pa.array(np.full(m, o)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["node", "n", "o", "sig", "more"])

    made = light.select("node", "small").mapInArrow(subsets, "node long, n long, o long, sig long, more long")
    first = made.groupBy("o", "sig", "more").agg(F.min(F.struct("n", "node")).alias("f"), F.count("*").alias("c")).where("c > 1")
    # every pair of the group that links by this subset also links, by it, to the group's smallest set
    return (made.join(first, ["o", "sig", "more"]).where(f"node <> f.node and {num} * (n + f.n) <= {num + den} * o")
            .select(F.col("node").alias("u"), F.col("f.node").alias("v")).distinct())


# --- heavy sets -------------------------------------------------------------------------------------------------------


def _postings(reps: DataFrame, bound: int, num: int, den: int) -> DataFrame:
    """(h, node, n, place): list entries of the shingles that must be scanned, without those that no other set has.

    The common order of shingles: those of the sampled tier by the number of sets that have them, then the rest. ``place``
    is the shingle's place in the set by that order, or less.
    """
    own = F.size(F.filter("tier", lambda x: x < bound))
    listed = reps.select("node", "n", own.alias("m"), F.explode("tier").alias("h"))
    often = listed.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    held = listed.join(often, "h").withColumn("late", F.col("h") >= F.lit(bound))
    mine = Window.partitionBy("node")
    # the shingles that no other set has come first among the tier's
    alone = F.when(F.col("late"), 0).otherwise(F.col("m") - F.count_if(~F.col("late")).over(mine))
    place = F.row_number().over(mine.orderBy("late", "df", "h")) + alone
    return held.select("h", "node", "n", place.alias("place")).where(f"place <= n - ceil({num} * n / {den}) + 1")


def _keyed(lists: DataFrame, num: int, den: int) -> DataFrame:
    """(h, a, b, node): each list cut by size. A set stands under the classes of sizes a and b if it is of one of them and
    may, by the place that the shingle has in it, link to a set of the other."""
    step = math.log(STEP)
    reach = math.ceil(math.log(den / num) / step) + 1
    size = F.floor(F.log("n") / F.lit(step))
    other = F.explode(F.sequence(F.greatest(F.col("c") - reach, F.lit(0)), F.col("c") + reach))
    lists = lists.withColumn("c", size).withColumn("o", other)
    least, most = F.floor(F.exp(F.col("o") * step) - 1e-6), F.ceil(F.exp((F.col("o") + 1) * step) + 1e-6)
    lists = lists.withColumn("least", F.greatest(least, F.expr(f"ceil({num} * n / {den})"))).where((F.col("least") <= most) & (least * num <= F.col("n") * den))
    lists = lists.where(f"place <= n - ceil({num} * (n + least) / {num + den}) + 1")
    return lists.select("h", F.least("c", "o").alias("a"), F.greatest("c", "o").alias("b"), "node")


def _tree(sizes: np.ndarray, values: np.ndarray, first: int, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the link graph of the sets given one after the other in ``values``.

    With ``first`` > 0 only sets before it are compared with the sets from it on.
    """
    n = len(sizes)
    left = np.arange(n) if not first else np.arange(first)
    right = np.arange(n) if not first else np.arange(first, n)
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    many = count[code] > 1
    column = np.full(len(count), -1)
    column[count > 1] = np.arange((count > 1).sum())
    code, owner = column[code[many]], owner[many]
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(left), len(right)), np.float32)
    shift = right[0] if len(right) else 0
    width = int(code[-1]) + 1 if len(code) else 0
    for c in range(0, width, 2048):
        i, j = np.searchsorted(code, [c, c + 2048])
        grid = np.zeros((n, 2048), np.float32)
        grid[owner[i:j], code[i:j] - c] = 1
        rows, cols = np.flatnonzero(grid[left].any(axis=1)), np.flatnonzero(grid[right].any(axis=1))
        both[np.ix_(rows, cols)] += grid[left[rows]] @ grid[right[cols]].T
    link = (num + den) * both.astype(np.int64) >= num * (sizes[left][:, None] + sizes[right][None, :])
    seen = np.zeros(n, bool)
    for start in range(n):
        if seen[start]:
            continue
        seen[start], wave = True, [start]
        while wave:
            a = wave.pop()
            near = np.zeros(n, bool)
            if a < len(left):
                near[shift : shift + len(right)] |= link[a]
            if a >= shift and a - shift < len(right):
                near[: len(left)] |= link[:, a - shift]
            fresh = np.flatnonzero(near & ~seen)
            seen[fresh] = True
            for b in fresh:
                yield a, int(b)
            wave.extend(fresh.tolist())


def _meet(k: int, num: int, den: int):
    def compare(table: pa.Table) -> pa.Table:
        """One group: the texts of block i, or those of blocks i and j. A text whose set is not the one meant, of an id that
        several texts share, is left out."""
        table = table.sort_by([("side", "ascending"), ("node", "ascending")])
        node, side, meant = (table.column(c).to_numpy() for c in ("node", "side", "h1"))
        sets = []
        for chunk in table.column("text").chunks:
            data, off = bt.column_bytes(chunk)
            for _, _, d, o in bt.slices(data, off):
                sets += list(_sets(d, o, k))
        keep = np.array([len(s) > 0 and int(np.bitwise_xor.reduce(bt.mix(s)).view(np.int64)) == h for s, h in zip(sets, meant, strict=True)], bool)
        keep[1:] &= (node[1:] != node[:-1]) | ~keep[:-1]
        sets, node, side = [s for s, ok in zip(sets, keep, strict=True) if ok], node[keep], side[keep]
        sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate(sets) if sets else np.zeros(0, U64)
        pairs = [] if len(sets) < 2 or (side.any() and side.all()) else list(_tree(sizes, values, int((side == 0).sum()) if side.any() else 0, num, den))
        u, v = [node[a] for a, _ in pairs], [node[b] for _, b in pairs]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return compare


def _spot(b: Column, o: Column) -> Column:
    """The comparison of blocks b and o, for a set of block b: the lower block is the left side."""
    return F.struct(F.least(b, o).alias("i"), F.greatest(b, o).alias("j"), (b > o).cast("int").alias("side"))


def _cut(groups: DataFrame, name: str = "b") -> DataFrame:
    """(node, component, bytes, blocks, b): the sets of each group dealt to blocks of about ``BLOCK`` sets or ``BLOCK_BYTES``."""
    if "bytes" not in groups.columns:
        groups = groups.withColumn("bytes", F.lit(0).cast("long"))
    many = groups.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("bytes") / F.lit(BLOCK_BYTES))).alias("blocks"))
    return groups.join(many, "component").select("node", "component", "bytes", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias(name))


def _first_spots(placed: DataFrame) -> DataFrame:
    """(node, component, spots): all comparisons of small groups, and those of the first block of large ones."""
    zero, others = F.lit(0).cast("long"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    all_ = (F.col("blocks") <= FEW_BLOCKS) | (F.col("b") == 0)
    return placed.select("node", "component", F.when(all_, F.transform(others, lambda o: _spot(F.col("b"), o))).otherwise(F.array(_spot(F.col("b"), zero))).alias("spots"))


def _rest_spots(keyed: DataFrame, large: DataFrame, linked: DataFrame) -> DataFrame:
    """(node, component, spots) of the comparisons that ``large`` groups still need, given what is ``linked`` already.

    Of each group the largest part that is linked is settled; the sets apart from it meet one another and the settled ones.
    """
    parts = large.select("node", "component", "bytes").join(linked.select("node", F.col("component").alias("part")), "node", "left").select("node", "component", "bytes", F.coalesce("part", "node").alias("part"))
    size = parts.groupBy("component", "part").agg(F.count("*").alias("n"))
    most = size.groupBy("component").agg(F.max_by("part", F.struct("n", "part")).alias("settled"))
    parts = written(parts.join(most, "component").select("node", "component", "bytes", (F.col("part") == F.col("settled")).alias("settled")), "parts")
    apart = _cut(parts.where("not settled").select("node", "component", "bytes")).withColumnRenamed("blocks", "apart")
    few = apart.groupBy("component").agg(F.first("apart").alias("apart"))
    rest = _cut(parts.where("settled").select("node", "component", "bytes")).join(few, "component").select("node", "component", "apart", (F.col("apart") + F.col("b")).alias("b"), F.col("blocks").alias("rest"))
    counts = rest.groupBy("component").agg(F.first("rest").alias("rest"))
    both = written(apart.join(counts, "component").select("node", "component", "apart", "rest", "b").unionByName(rest.select("node", "component", "apart", "rest", "b")), "apart")
    # few sets apart: they meet all; the settled ones meet them
    end = F.when(F.col("b") < F.col("apart"), F.col("apart") + F.col("rest")).otherwise(F.col("apart"))
    near = both.where(F.col("apart") <= FEW_BLOCKS).select("node", "component", F.transform(F.sequence(F.lit(0).cast("long"), end - 1), lambda o: _spot(F.col("b"), o)).alias("spots"))
    # many: they meet the blocks that their lists reach
    far = both.where(F.col("apart") > FEW_BLOCKS)
    listed = keyed.withColumnRenamed("b", "c").join(far, "node")
    blocks = listed.groupBy("h", "a", "c").agg(F.collect_set("b").alias("os"))
    met = listed.join(blocks, ["h", "a", "c"]).select("node", "component", "apart", "b", F.explode("os").alias("o")).where("b < apart OR o < apart").distinct()
    return near.unionByName(met.groupBy("node", "component").agg(F.collect_list(_spot(F.col("b"), F.col("o"))).alias("spots")))


def _compared(texts: DataFrame, reps: DataFrame, spots: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Edges (u, v) of the comparisons, each text brought once and copied to its spots."""
    named = spots.join(reps.select("node", "rid", "h1"), "node")
    held = texts.join(named.hint("merge"), "rid").select("node", "h1", "text", "component", F.explode("spots").alias("s"))
    return held.select("node", "h1", "text", "component", "s.i", "s.j", "s.side").groupBy("component", "i", "j").applyInArrow(_meet(k, num, den), "u long, v long")


def links_among(keyed: DataFrame, docs: DataFrame, reps: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Edges (u, v) that span the links among sets that meet: those on a list (h, a, b, node) together, and by way of others.

    ``docs`` (doc_id, text) holds the texts, ``reps`` (node, rid, h1, bytes) says which text is which set's. Every link between sets of one
    list is found on the whole sets, whatever the list's length.
    """
    lead = keyed.groupBy("h", "a", "b").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v < w").drop("w")
    meets = keyed.join(lead, ["h", "a", "b"]).where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    placed = written(_cut(connected_components(meets).join(reps.select("node", "bytes"), "node")), "placed")
    texts = docs.select(F.col("doc_id").alias("rid"), "text")
    links = _compared(texts, reps, _first_spots(placed), k, num, den)
    large = placed.where(F.col("blocks") > FEW_BLOCKS)
    if large.limit(1).count():
        links = written(links, "links")
        rest = _rest_spots(keyed, large, connected_components(links.join(large.select(F.col("node").alias("u")), "u", "left_semi")))
        links = links.union(_compared(texts, reps, rest, k, num, den))
    return links


# --- the operator -----------------------------------------------------------------------------------------------------


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id): the groups that links of Jaccard similarity >= num / den form.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles
    of ``k`` words, or its whole sequence if it has fewer. ``component_id`` is the smallest id reachable by links. A null
    or empty text has an empty set, links with nothing and is its own component; rows with a null id are left out; each row
    of an id that stands on several rows is judged by its own text. Repeated rows stay. Texts may be of any length. An empty
    table gives an empty result. Other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    profile, bound = _profiler(k, num, den)
    seen = written(docs.mapInArrow(profile, _PROFILE), "profiles")
    reps = classes(seen, "bytes", "tier", "small")
    sizes = {r["n"]: r["c"] for r in reps.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").agg(F.count("*").alias("c")).collect()}
    x = boundary(sizes, num, den)
    light = _light_links(reps.where(F.col("n") <= x), x, num, den)
    heavy = reps.where(F.col("n") * den >= num * (x + 1))
    lists = written(_postings(heavy, bound, num, den), "lists")
    return grouped(seen, reps, light.union(links_among(_keyed(lists, num, den), docs, heavy, k, num, den)))


_CLASS = ["h1", "h2", "n"]


def classes(seen: DataFrame, *columns: str) -> DataFrame:
    """One row for each distinct set of ``seen`` (doc_id, n, h1, h2, columns), written: its smallest id ``rid`` with that row's columns,
    and its node, which is that id or, if a class before has that id too, a negative digest."""
    found = seen.where("n > 0").groupBy(*_CLASS).agg(F.min("doc_id").alias("rid"), F.min_by(F.struct(*columns), "doc_id").alias("s"))
    turn = F.row_number().over(Window.partitionBy("rid").orderBy(*_CLASS))
    node = F.when(turn == 1, F.col("rid")).otherwise(-1 - F.pmod(F.xxhash64(*_CLASS), F.lit(2**62)))
    return written(found.select("rid", *_CLASS, *(F.col(f"s.{c}").alias(c) for c in columns), node.alias("node")), "classes")


def grouped(seen: DataFrame, reps: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of all rows of ``seen``, given the links between their classes."""
    of_class = reps.join(connected_components(links), "node", "left").select(*_CLASS, "rid", F.coalesce("component", "node").alias("component"))
    if reps.where("node <> rid").limit(1).count():  # the smallest id of a component is not that of its node
        least = of_class.groupBy("component").agg(F.min("rid").alias("component_id"))
        of_class = of_class.join(least, "component")
    else:
        of_class = of_class.withColumnRenamed("component", "component_id")
    out = seen.select("doc_id", *_CLASS).join(of_class.select(*_CLASS, "component_id"), _CLASS, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest id of its group, with all their columns.

    Rows with a null id come after all others: such a row stays if no row with an id, and none of a smaller digest of its
    text, is in its group. Rows that share an id and a group stay together.
    """
    keyed = docs.withColumn("_own", own_id(id_col, text_col))
    groups = jaccard_groups(keyed, "_own", text_col, k, num, den).where("doc_id = component_id")
    return keyed.join(groups.select(F.col("doc_id").alias("_own")).distinct(), "_own", "left_semi").select(docs.columns)
