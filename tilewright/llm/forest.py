"""Near-duplicate documents by an LSH forest of MinHash signatures, confirmed on whole shingle sets.

Each of ``TREES`` orders sorts all distinct sets by their own ``DEPTH`` MinHash values. Sets that share a prefix stand together in such
an order, so the longest common prefix of neighbours cuts it into regions. A region shares ``LEAST`` values; where more than ``REGION``
sets do, it is cut again where neighbours share one value less than the next depth asks, and so on: dense regions go deep, others
stay shallow. Two sets of similarity s share a region of depth d in one order with probability s ** d, so at 0.8, in regions of depth
``LEAST``, all ``TREES`` orders part them in about 3 of 100,000 cases. What a region holds only meets: links come from whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tilewright.llm import bytetext as bt
from tilewright.llm import jaccard
from tilewright.sources.scratch import written

TREES, LEAST, DEPTH = 20, 4, 8
#: Sets of a region, unless it is as deep as the signatures.
REGION = 2048
#: Rows of an order that a task cuts.
ROWS = 500_000

U64 = np.uint64
_MULTIPLIERS = bt.mix(np.arange(1, TREES * DEPTH + 1, dtype=U64) * U64(0xD6E8FEB86659FD93)) | U64(1)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of TREES * DEPTH smallest hashes (32 bits) for each set of ``values``; sets begin at ``starts`` and are not empty."""
    out = np.empty((len(starts), len(_MULTIPLIERS)), np.uint32)
    for i, m in enumerate(_MULTIPLIERS):
        out[:, i] = np.minimum.reduceat(((values * m) >> U64(32)).astype(np.uint32), starts)
    return out


def _profiler(k: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bt.column_bytes(batch.column(1))
            for i, j, d, o in bt.slices(data, off):
                sets = list(jaccard._sets(d, o, k))
                n = np.array([len(s) for s in sets], np.int64)
                h1, h2 = (np.array([int(op.reduce(bt.mix(s * U64(m))).view(np.int64)) if len(s) else 0 for s in sets], np.int64) for op, m in ((np.bitwise_xor, 1), (np.add, 5)))
                full = np.flatnonzero(n)
                sig: list[bytes | None] = [None] * len(sets)
                if len(full):
                    rows = signatures(np.concatenate([sets[x] for x in full]), np.r_[0, np.cumsum(n[full])[:-1]]).astype(">u4")
                    for x, row in zip(full, rows, strict=True):
                        sig[x] = row.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n), pa.array(h1), pa.array(h2), pa.array(np.diff(o), pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "n", "h1", "h2", "bytes", "sig"])

    return profile


def regions(order: np.ndarray, most: int, edge: tuple[bool, bool] = (True, True)) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, rows, label of each) of the regions that a sorted piece of orders holds: rows of a tree's number and DEPTH values.

    A piece may begin or end within a region (``edge``), whose other part another task has: the runs at its ends are labelled
    at all further depths too, since the other part may be cut deeper. Labels depend on tree, depth and prefix alone.
    """
    n = len(order)
    same = np.zeros(n, np.int64)
    if n > 1:
        same[1:] = np.cumprod(order[1:] == order[:-1], axis=1).sum(axis=1) - 1  # of the values, -1 where the tree changes
    if n:
        same[0] = -1
    label = order[:, 0].astype(U64) + U64(1)
    rows, inner = np.arange(n), np.ones(n, bool)  # rows whose region is not settled yet
    for depth in range(1, DEPTH + 1):
        label = bt.mix(label * U64(0x9E3779B97F4A7C15) + order[:, depth].astype(U64) + U64(depth))
        if depth < LEAST or not len(rows):
            continue
        new = np.flatnonzero(same[rows] < depth)
        if not len(new) or new[0] != 0:
            new = np.r_[0, new]
        size = np.diff(np.r_[new, len(rows)])
        run = np.repeat(np.arange(len(size)), size)
        at_edge = np.zeros(len(size), bool)
        if edge[0] and rows[0] == 0:
            at_edge[0] = True
        if edge[1] and rows[-1] == n - 1:
            at_edge[-1] = True
        small = (size <= most) | (depth == DEPTH)
        told = (small & ((size > 1) | at_edge))[run]
        told &= inner[rows] | at_edge[run]
        if told.any():
            yield depth, rows[told], label[rows[told]]
        go = ~small | at_edge
        inner[rows[(small)[run]]] = False
        rows = rows[go[run]]


def _cutter(most: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        all_ = pa.Table.from_batches(tables).combine_chunks()
        node = all_.column("node").to_numpy()
        sig = np.frombuffer(bt.column_bytes(all_.column("sig").chunk(0))[0], ">u4").reshape(-1, DEPTH)
        order = np.column_stack([all_.column("tree").to_numpy().astype(np.uint32), sig.astype(np.uint32)])
        for _, rows, label in regions(order, most):
            yield pa.RecordBatch.from_arrays([pa.array(label.view(np.int64)), pa.array(node[rows])], ["h", "node"])

    return cut


def met(reps: DataFrame, most: int = REGION) -> DataFrame:
    """(h, node): the regions of all orders and the sets (node, sig) in them, regions of one set left out only where that is known."""
    spark = reps.sparkSession
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda i: F.struct(i.alias("tree"), F.substring(F.col("sig"), i * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("sig")))
    rows = reps.select("node", F.explode(trees).alias("t")).select("node", "t.tree", "t.sig")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-reps.count() * TREES // ROWS))
    dealt = rows.repartitionByRange(parts, "tree", "sig", "node").sortWithinPartitions("tree", "sig", "node")
    return dealt.mapInArrow(_cutter(most), "h long, node long")


def forest_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 80, den: int = 100, most: int = REGION) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): groups of documents whose shingle sets have a Jaccard similarity >= num / den.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles of ``k``
    words, or its whole sequence if it has fewer. ``component_id`` is the smallest id reachable by links, and the document of that
    id is kept. A null or empty text has an empty set, links with nothing and is kept; rows with a null id are left out; each row
    of an id that stands on several rows is judged by its own text, and repeated rows stay. Equal sets are one class from the
    start. Texts may be of any length. An empty table gives an empty result; other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    seen = written(docs.mapInArrow(_profiler(k), "doc_id long, n long, h1 long, h2 long, bytes long, sig binary"), "signatures")
    reps = jaccard.classes(seen, "bytes", "sig")
    zero = F.lit(0).cast("long")
    lists = written(met(reps, most).select("h", zero.alias("a"), zero.alias("b"), "node"), "regions")
    links = jaccard.links_among(lists, docs, reps, k, num, den)
    return jaccard.grouped(seen, reps, links).withColumn("kept", F.col("doc_id") == F.col("component_id"))
