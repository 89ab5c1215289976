"""A Merkle manifest of a dataset: a digest of every row, a tree of digests per dataset part, proofs, and their verification.

Rows are leaves. Each part of the dataset (a language, say) has a tree of ``FAN`` children a node over its leaves in order; the
parts' roots are the leaves of one tree more. Work is dealt by superblock, 4096 consecutive nodes of a level: a superblock is
reduced to its top in one group; the tops are nodes of the next level and are treated alike, so that no task sees more than one
superblock. On the way back, each superblock is cogrouped with the path that its top has to the root. That group finishes its
local reduction, joins local and outer siblings to proofs and folds the leaf that is presented up to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.sources.scratch import written

FAN = 8
#: Levels that a superblock reduces: it has 8**4 nodes.
HEIGHT = 4

_PATH = "path array<struct<place:int, siblings:array<string>>>"


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(c: str) -> Column:
    text = F.col(c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(row: str, fields: list[str]) -> Column:
    """The 32 bytes of a row's digest: SHA-256 of its fields, each ``-`` if null, else its length in bytes, ``:`` and itself."""
    return F.unhex(F.sha2(F.concat(*[_field(f"{row}.{c}") for c in fields]), 256))


def numbered(rows: DataFrame, by: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``_at``, parts): the rows sorted over all tasks and written, and where each value of ``by`` begins in each file.

    The place of a row among those of its ``by`` is ``_at - first + before`` of its part (``_at >> 33``); ``n`` counts them. ``rows``
    is a written table, and ``order`` ends with a column that tells all its rows apart, so that a hot value of ``by`` or of an id
    is dealt to several tasks.
    """
    dealt = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt, "dealt")
    parts = dealt.groupBy(by, F.shiftright("_at", 33).alias("part")).agg(F.min("_at").alias("first"), F.count("*").alias("here"))
    mine = Window.partitionBy(by)  # one row for each file at most
    before = F.coalesce(F.sum("here").over(mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt, parts.select(by, "part", "first", "here", before.alias("before"), F.sum("here").over(mine).alias("n"))


def _keys(tree: str, block: Column, alone: Column, pools: int) -> list[Column]:
    """The group of a superblock; trees that one superblock holds share groups."""
    return [F.when(alone, F.lit(-1)).otherwise(F.col(tree)).alias("k1"), F.when(alone, F.pmod(F.xxhash64(tree), F.lit(pools))).otherwise(block).alias("k2")]


def _by_block(nodes: DataFrame, pools: int, height: int) -> DataFrame:
    block = F.floor(F.col("p") / FAN**height)
    return nodes.withColumn("s", block).select("*", *_keys("tree", block, F.col("n") <= FAN**height, pools))


def _levels(nodes: list[str], n: int, height: int) -> list[list[str]]:
    """The levels of a superblock, from its nodes to its top, in a tree of ``n`` nodes."""
    out, left = [nodes], n
    while left > 1 and len(out) <= height:
        out.append([_hash(*out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
        left = -(-left // FAN)
    return out


def _blocks(rows: pd.DataFrame) -> Iterator[tuple[int, int, pd.DataFrame]]:
    for (tree, s), own in rows.groupby(["tree", "s"], sort=False):
        yield tree, s, own.sort_values("p")


def _tops(nodes: DataFrame, pools: int, height: int) -> DataFrame:
    """The tops of all superblocks: nodes of the level ``height`` further up."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, s, own in _blocks(rows):
            n = int(own["n"].iloc[0])
            out.append((tree, s, -(-n // FAN**height), bytes.fromhex(_levels([x.hex() for x in own["node"]], n, height)[-1][0])))
        return pd.DataFrame(out, columns=["tree", "p", "n", "node"])

    return _by_block(nodes.select("tree", "p", "n", "node"), pools, height).groupBy("k1", "k2").applyInPandas(reduce, "tree long, p long, n long, node binary")


def _exchange(nodes: DataFrame, outer: DataFrame, pools: int, height: int, finish, schema: str) -> DataFrame:
    """``finish`` for each superblock: its rows, its levels, and the row of ``outer`` that belongs to its top."""

    def meet(rows: pd.DataFrame, tops: pd.DataFrame) -> pd.DataFrame:
        above = {(t.tree, t.p): t for t in tops.itertuples()}
        out = [finish(own, _levels([x.hex() for x in own["node"]], int(own["n"].iloc[0]), height), above[tree, s]) for tree, s, own in _blocks(rows)]
        return pd.concat(out)

    keyed = outer.select("*", *_keys("tree", F.col("p"), F.col("n") <= 1, pools))
    return _by_block(nodes, pools, height).groupBy("k1", "k2").cogroup(keyed.groupBy("k1", "k2")).applyInPandas(meet, schema)


def _local_path(levels: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    path = []
    for level in levels[:-1]:
        run = i - i % FAN
        path.append((i % FAN, level[run:i] + level[i + 1 : run + FAN]))
        i //= FAN
    return path


def _pairs(path) -> list[tuple[int, list[str]]]:
    return [(int(x["place"]), list(x["siblings"])) for x in path]


def _as_structs(path: list[tuple[int, list[str]]]) -> list[dict]:
    return [{"place": a, "siblings": b} for a, b in path]


def paths(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(tree, p, n, path, top): the way of every node (tree, p, n, node) to its tree's top, level by level: its place and its
    siblings. ``nodes`` is a written table with places from 0 and ``n`` nodes in its tree."""
    size = nodes.agg(F.max("n").alias("most"), F.count("*").alias("rows")).first()
    if (size["most"] or 0) <= 1:
        return nodes.select("tree", "p", "n", F.expr(f"cast(array() as {_PATH[5:]})").alias("path"), F.lower(F.hex("node")).alias("top"))
    pools = -(-size["rows"] // FAN**height)

    def finish(own: pd.DataFrame, levels: list[list[str]], above) -> pd.DataFrame:
        outer = _pairs(above.path)
        out = own[["tree", "p", "n"]].copy()
        out["path"] = [_as_structs(_local_path(levels, i) + outer) for i in range(len(own))]
        out["top"] = above.top
        return out

    outer = paths(written(_tops(nodes, pools, height), "tops"), height)
    return written(_exchange(nodes, outer, pools, height, finish, f"tree long, p long, n long, {_PATH}, top string"), "paths")


def _prover(proofs: bool):
    def finish(own: pd.DataFrame, levels: list[list[str]], above) -> pd.DataFrame:
        """Proofs of all leaves of a superblock, and what their presented leaves fold to."""
        outer = _pairs(above.path)
        beyond = "".join(x for _, siblings in outer for x in siblings)
        # what the proofs of a level's nodes have from there on, from the top down
        rest = [beyond]
        for level in reversed(levels[:-1]):
            rest = ["".join(level[i - i % FAN : i]) + "".join(level[i + 1 : i - i % FAN + FAN]) + rest[i // FAN] for i in range(len(level))]
        folded = []
        for i, (first, told) in enumerate(zip(levels[0], own["told"], strict=True)):
            now, j = first if told is None else told.hex(), i
            for level in levels[:-1]:
                run = j - j % FAN
                now = _hash(*level[run:j], now, *level[j + 1 : run + FAN])
                j //= FAN
            for place, siblings in outer:
                now = _hash(*siblings[:place], now, *siblings[place:])
            folded.append(now)
        out = own[["id"]].copy()
        out["leaf"], out["subroot"], out["root"] = levels[0], above.top, above.root
        out["proof_sha256"] = [_hash(x) for x in rest]
        out["folded_root"] = folded
        out["verified"] = out["folded_root"] == above.root
        if proofs:
            out["proof"] = [_as_structs(_local_path(levels, i) + outer) for i in range(len(own))]
        return out

    return finish


def manifest(docs: DataFrame, fields: list[str], tree: str = "lang", order: str = "doc_id", presented: dict[str, Column] | None = None, proofs: bool = False, height: int = HEIGHT) -> DataFrame:
    """(order column, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]) of every row of ``docs``.

    ``fields`` are the columns that a leaf covers, in this order; each distinct value of ``tree``, null first, then by bytes, has a
    tree over its rows ascending by ``order``, null first. Rows of equal ``order`` are taken by their leaf; repeated rows stay and
    each is a leaf. ``presented`` replaces columns by what somebody shows in their stead: the leaf of that is folded with the
    original siblings, and ``verified`` says whether the original root comes out. ``proof`` lists for each level, from the leaf up,
    the place among its siblings and their digests; ``proof_sha256`` is the digest of all siblings in that order. An empty table
    gives an empty result. Texts may be of any length; columns that ``fields`` doesn't name are not looked at.
    """
    row = lambda other: F.struct(*[other.get(c, F.col(c)).alias(c) for c in fields])
    both = docs.select(F.col(order).alias("id"), F.col(tree).alias("name"), row({}).alias("own"), row(presented or {}).alias("shown"))
    rows = both.select("id", "name", _leaf("own", fields).alias("node"), (_leaf("shown", fields) if presented else F.lit(None).cast("binary")).alias("told"))
    rows = rows.withColumn("told", F.when(F.col("told") != F.col("node"), F.col("told"))).withColumn("row", F.monotonically_increasing_id())
    dealt, parts = numbered(written(rows, "leaves"), "name", ["id", "node", "row"])
    parts = written(parts, "parts")
    names = written(parts.groupBy("name").agg(F.lit(0).alias("all"), F.first("n").alias("size")), "names")
    named, runs = numbered(names, "all", ["name"])
    trees = named.join(runs.withColumnRenamed("n", "trees"), F.shiftright("_at", 33) == F.col("part")).select("name", "trees", (F.col("_at") - F.col("first") + F.col("before")).alias("tree"))
    trees = written(trees, "trees")
    parts = written(parts.alias("a").join(trees.alias("b"), F.col("a.name").eqNullSafe(F.col("b.name"))).select("a.*", "tree"), "parts")
    at = dealt.alias("d").join(parts.alias("a"), F.col("d.name").eqNullSafe(F.col("a.name")) & (F.shiftright("d._at", 33) == F.col("a.part")))
    leaves = at.select("d.id", "d.node", "d.told", "a.tree", "a.n", (F.col("d._at") - F.col("a.first") + F.col("a.before")).alias("p"))

    pools = -(-(parts.agg(F.sum("here")).first()[0] or 0) // FAN**height) or 1
    tops = paths(written(_tops(leaves, pools, height), "tops"), height)
    heads = tops.where("p = 0").join(trees.select("tree", "trees"), "tree")
    heads = heads.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("p"), F.col("trees").alias("n"), F.unhex("top").alias("node"))
    over = paths(written(heads, "heads"), height).select(F.col("p").alias("tree"), F.col("path").alias("way"), F.col("top").alias("root"))
    outer = tops.join(over, "tree").select("tree", "p", "n", F.concat("path", "way").alias("path"), "top", "root")
    kind = docs.schema[order].dataType.simpleString()
    schema = f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + f", proof {_PATH[5:]}" * proofs
    return _exchange(leaves, outer, pools, height, _prover(proofs), schema).withColumnRenamed("id", order)

