"""Prefix trie of conversations: which beginnings are shared, by how many, and what sharing them saves.

Turns are encoded by a dictionary of whole numbers, conversations become sequences of them, and the sequences are sorted over all
tasks, so that a task holds a range of them. A task reads its range in shards of about ``SHARD`` turns. Each shard is a ternary
search tree, built by inserting its sequences median first, halves likewise, which keeps it balanced; an iterative traversal then
sums members, leaves and savings from the last nodes up. Nodes whose members all lie in the shard are finished and leave the task.
Nodes that a neighbouring shard may have too are a prefix of the shard's first or last sequence: what they have gathered so far goes,
as a path, into a further pass over all such paths, until one shard holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tilewright.sources.scratch import written

#: Turns of a shard, about; a shard has ``LEAST`` sequences at least, however long, so that each pass leaves fewer paths.
SHARD, LEAST = 100_000, 16
#: Members written in one piece of text.
PIECE = 512

_SEQUENCE = "ids array<long>, chars array<int>"
#: What a path carries, for each node from the root on: members that end there, the smallest of them, the digest of their ids; of finished
#: nodes below it: members, the smallest, leaves, savings, children.
_CARRIED = ["ends", "least", "convs", "low", "leaves", "saved", "children"]
_PATHS = f"{_SEQUENCE}, {', '.join(f'{c} array<long>' for c in _CARRIED)}, sha array<string>"
_NODES = "depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, own_key string, parent_key string"
NONE = 2**63 - 1
EMPTY = hashlib.sha256().hexdigest()


# --- sequences --------------------------------------------------------------------------------------------------------


def turn_key(role: str = "role", text: str = "text") -> Column:
    """16 bytes that stand for a turn."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def encoded(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, chars): each conversation's turns as numbers of the dictionary, with the code points of their texts.

    Texts never leave the task that reads them: they are told apart by 128 bits of SHA-256. Turns of one number are ordered by
    role, then by that digest. A conversation's encoded turns, some 40 bytes each, must fit a task; rows without a conv_id are left out.
    """
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                                                     turn_key().alias("key"), F.coalesce(F.char_length("text"), F.lit(0)).alias("chars"))
    rows = written(rows, "turns")
    words = written(rows.groupBy("key").agg(F.max("chars").alias("chars")).withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = rows.drop("chars").join(words, "key")
    one = F.sort_array(F.collect_list(F.struct("turn", "role", "key", "id", "chars")))
    return coded.groupBy("conv_id").agg(one.alias("t")).select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def rebuilt(own: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """(conv_id, ids, chars): the first ``head`` turns (at most ``most``) of the conversation ``base``, then the own ones after as many."""
    firsts = own.select(F.col("conv_id").alias("_base"), F.slice("ids", 1, most).alias("_i"), F.slice("chars", 1, most).alias("_c"))
    both = own.withColumn("_base", base).withColumn("_head", head).join(firsts, "_base", "left")
    cut = lambda new, old: F.concat(F.coalesce(F.slice(new, F.lit(1), F.col("_head")), F.slice(old, 1, 0)), F.slice(old, F.col("_head") + 1, F.size(old)))
    return both.select("conv_id", cut("_i", "ids").alias("ids"), cut("_c", "chars").alias("chars"))


# --- members of equal sequences ---------------------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (ids, chars, conv_id) to (ids, chars, least, n, members): runs of equal ids, their members as text of ``PIECE`` at most."""
    ids, chars, members, out = None, None, [], []

    def close() -> None:
        if members:
            out.append({"ids": ids, "chars": chars, "least": members[0], "n": len(members), "members": ",".join(map(str, members))})

    schema = pa.schema([("ids", pa.list_(pa.int64())), ("chars", pa.list_(pa.int32())), ("least", pa.int64()), ("n", pa.int64()), ("members", pa.string())])
    for batch in batches:
        for i, c, m in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if i != ids or len(members) == PIECE:
                close()
                ids, chars, members = i, c, []
            members.append(m)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """[ids, chars, members, smallest member, digest of members] of each distinct sequence; pieces are hashed one after the other."""
    now, sha = None, None
    for batch in batches:
        for i, c, low, n, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if now is not None and i == now[0]:
                sha.update(b"," + text.encode())
                now[2] += n
                continue
            if now is not None:
                yield [*now, sha.hexdigest()]
            now, sha = [i, c, n, low], hashlib.sha256(text.encode())
    if now is not None:
        yield [*now, sha.hexdigest()]


# --- tries ------------------------------------------------------------------------------------------------------------


class Trie:
    """A ternary search tree over sequences of numbers; node 0 is the root, the textless beginning."""

    def __init__(self) -> None:
        self.split, self.low, self.next, self.high, self.chars = [-1], [0], [0], [0], [0]
        self.ends, self.least, self.convs, self.lows, self.leaves, self.saved, self.children, self.sha = [0], [NONE], [0], [NONE], [0], [0], [0], [None]

    def _new(self, x: int, chars: int) -> int:
        for column, v in ((self.split, x), (self.low, 0), (self.next, 0), (self.high, 0), (self.chars, chars), (self.ends, 0), (self.least, NONE), (self.convs, 0), (self.lows, NONE), (self.leaves, 0), (self.saved, 0), (self.children, 0), (self.sha, None)):
            column.append(v)
        return len(self.split) - 1

    def insert(self, ids: list[int], chars: list[int]) -> list[int]:
        """The nodes of a sequence, from the root to its end."""
        split, low, next_, high, at = self.split, self.low, self.next, self.high, [0]
        for x, c in zip(ids, chars, strict=True):
            up = at[-1]
            node = next_[up]
            if not node:
                node = next_[up] = self._new(x, c)
            while split[node] != x:
                side = low if x < split[node] else high
                if not side[node]:
                    side[node] = self._new(x, c)
                node = side[node]
            at.append(node)
        return at

    def order(self) -> tuple[list[int], list[int], list[int]]:
        """(nodes, parents, depths), every node after its parent."""
        nodes, parents, depths, stack = [0], [-1], [0], [(self.next[0], 0, 1)]
        while stack:
            node, parent, depth = stack.pop()
            if not node:
                continue
            nodes.append(node)
            parents.append(parent)
            depths.append(depth)
            stack += ((self.low[node], parent, depth), (self.high[node], parent, depth), (self.next[node], node, depth + 1))
        return nodes, parents, depths


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    wave = [(0, n)]
    while wave:
        further = []
        for a, b in wave:
            if a < b:
                m = (a + b) // 2
                yield m
                further += ((a, m), (m + 1, b))
        wave = further


def _common(a: list[int], b: list[int]) -> int:
    n = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        n += 1
    return n


def _names(ids: list[int]) -> list[str]:
    """A digest of each beginning of ``ids``, the empty one first."""
    out = [""]
    for x in ids:
        out.append(hashlib.blake2b(f"{out[-1]} {x}".encode(), digest_size=16).hexdigest())
    return out


def _shard(rows: list[tuple[list[int], list[int], list[tuple]]], before: int, after: int, again: bool) -> tuple[list[dict], list[dict]]:
    """(finished nodes, paths) of sorted rows: ids, chars, and what each node of the path carries.

    Nodes to depth ``before`` on the first path and ``after`` on the last may be in other shards too (-1: none may).
    """
    t = Trie()
    ends, names = {}, {}
    for k in medians(len(rows)):
        ids, chars, carried = rows[k]
        at = t.insert(ids, chars)
        if k in (0, len(rows) - 1):
            ends[k] = at
        if again or k in (0, len(rows) - 1):  # nodes that others may name as their parent
            names |= zip(at, _names(ids), strict=True)
        for i, (n, least, convs, low, leaves, saved, children, sha) in carried:
            v = at[i]
            t.ends[v] += n
            t.least[v] = min(t.least[v], least)
            t.convs[v] += convs
            t.lows[v] = min(t.lows[v], low)
            t.leaves[v] += leaves
            t.saved[v] += saved
            t.children[v] += children
            t.sha[v] = sha or t.sha[v]
    first, last = ends[0], ends[len(rows) - 1]
    open_ = dict.fromkeys(first[: before + 1]) | dict.fromkeys(last[: after + 1])
    nodes, parents, depths = t.order()
    convs, lows = t.convs, t.lows
    for v, up in zip(reversed(nodes), reversed(parents), strict=True):
        if v in open_:
            continue
        convs[v] += t.ends[v]
        lows[v] = min(lows[v], t.least[v])
        t.saved[v] += (convs[v] - 1) * t.chars[v]
        if not t.children[v]:
            t.leaves[v] = 1
        if up >= 0:
            convs[up] += convs[v]
            lows[up] = min(lows[up], lows[v])
            t.leaves[up] += t.leaves[v]
            t.saved[up] += t.saved[v]
            t.children[up] += 1
    done = []
    for v, up, depth in zip(nodes, parents, depths, strict=True):
        if v not in open_:
            closed = up not in open_
            done.append({"depth": depth, "conv_id": lows[v], "parent_conv_id": lows[up] if up >= 0 and closed else None, "n_convs": convs[v], "n_children": t.children[v], "n_leaves": t.leaves[v], "saved_tokens": t.saved[v],
                         "ends_sha256": t.sha[v] or EMPTY, "own_key": names[v] if again else None, "parent_key": None if closed else names[up]})
    paths, told = [], set()
    for at, (ids, chars, _), most in ((first, rows[0], before), (last, rows[-1], after)):
        if most < 0 or all(v in told for v in at[: most + 1]):
            continue
        path = {"ids": ids[:most], "chars": chars[:most]} | {c: [] for c in [*_CARRIED, "sha"]}
        for v in at[: most + 1]:
            new = v not in told
            told.add(v)
            for c, x in zip([*_CARRIED, "sha"], (t.ends[v], t.least[v], convs[v], lows[v], t.leaves[v], t.saved[v], t.children[v], t.sha[v]) if new else (0, NONE, 0, NONE, 0, 0, 0, None), strict=True):
                path[c].append(x)
        paths.append(path)
    return done, paths


def _pass(read, again: bool, whole: bool, shard: int):
    """A task: its sorted rows in shards. ``whole``: this task has all rows, so that no node is left open."""
    node, path = (pa.struct([(x.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[x.split()[1]]) for x in _NODES.split(", ")]),
                  pa.struct([("ids", pa.list_(pa.int64())), ("chars", pa.list_(pa.int32())), *((c, pa.list_(pa.int64())) for c in _CARRIED), ("sha", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, turns, shared = [], 0, None  # shared: nodes that the shard's first sequence may share with what stands before it

        def flush(after: int) -> Iterator[pa.RecordBatch]:
            before = shared if shared is not None else -1 if whole else len(rows[0][0])
            done, paths = _shard(rows, before, after, again)
            both = [(d, None) for d in done] + [(None, p) for p in paths]
            for i in range(0, len(both), 5000):
                part = both[i : i + 5000]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in part], node), pa.array([p for _, p in part], path)], ["node", "path"])

        for row in read(batches):
            if turns >= shard and len(rows) >= LEAST:
                after = _common(rows[-1][0], row[0])
                yield from flush(after)
                rows, turns, shared = [], 0, after
            rows.append(row)
            turns += len(row[0]) + 1
        if rows:
            yield from flush(-1 if whole else len(rows[-1][0]))

    return run


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for ids, chars, n, low, sha in _weighted(batches):
        yield ids, chars, [(len(ids), (n, low, 0, NONE, 0, 0, 0, sha))]


def _path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for r in batch.to_pylist():
            yield r["ids"], r["chars"], list(enumerate(zip(*(r[c] for c in [*_CARRIED, "sha"]), strict=True)))


def prefix_nodes(sequences: DataFrame, shard: int = SHARD) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each distinct beginning of
    the ``sequences`` (conv_id, ids, chars), the textless one at depth 0 included.

    ``conv_id`` is the smallest member and, with the depth, tells nodes apart. ``saved_tokens`` adds, over the node and all below it,
    (members - 1) times the code points of its last turn; ``ends_sha256`` is the digest of the ids of members that end there, in
    numerical order, with commas. Members of one id count as often as they stand there. No sequences give no nodes.
    """
    spark = sequences.sparkSession
    out = f"node struct<{', '.join(':'.join(x.split()) for x in _NODES.split(', '))}>, path struct<{', '.join(':'.join(x.split(' ', 1)) for x in _PATHS.split(', '))}>"
    spread = sequences.select("ids", "chars", "conv_id").repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    pieces = written(spread.mapInArrow(_pieces, f"{_SEQUENCE}, least long, n long, members string"), "pieces")
    def parts(df: DataFrame) -> int:
        """Tasks of eight shards each; with so many sequences in a task that it leaves fewer paths, however long they are. 0 without rows."""
        seen = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("ids") + 1), F.lit(0)).alias("turns")).first()
        return min(-(-seen["turns"] // (8 * shard)), -(-seen["n"] // (2 * LEAST)))

    n = parts(pieces)
    if not n:
        return spark.createDataFrame([], _NODES).drop("own_key", "parent_key")
    step = pieces.repartitionByRange(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "ids").sortWithinPartitions("ids", "least").mapInArrow(_pass(_first_rows, False, False, shard), out)
    found = []
    while True:
        step = written(step, "tries")
        found.append(step.where("node is not null").select("node.*"))
        paths = step.where("path is not null").select("path.*")
        n = parts(paths)
        if not n:
            break
        whole = n == 1
        dealt = paths.coalesce(1) if whole else paths.repartitionByRange(n, "ids")
        step = dealt.sortWithinPartitions("ids").mapInArrow(_pass(_path_rows, True, whole, shard if not whole else 1 << 62), out)
    nodes = found[0]
    for x in found[1:]:
        nodes = nodes.unionByName(x)
    parents = [x.where("own_key is not null").select(F.col("own_key").alias("parent_key"), F.col("conv_id").alias("up"), (F.col("depth") + 1).alias("depth")) for x in found[1:]]
    return _with_parents(nodes, parents)


def _with_parents(nodes: DataFrame, parents: list[DataFrame]) -> DataFrame:
    """Nodes that left the task before their parent was finished get its smallest member by its key."""
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    if not parents:
        return nodes.select(columns)
    known = parents[0]
    for x in parents[1:]:
        known = known.unionByName(x)
    late = nodes.where("parent_key is not null").join(known, ["parent_key", "depth"]).withColumn("parent_conv_id", F.col("up"))
    return nodes.where("parent_key is null").select(columns).unionByName(late.select(columns))
