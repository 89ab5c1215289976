"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

A chromosome is a set of bins. Crossover injects whole well-filled bins of one parent into the other and removes the bins that
then hold a document twice; mutation empties the least filled bins and some others. Displaced documents first take the place of
one or two documents of a bin where they fill it better, which then are displaced in turn, and what is left goes by best fit. Pieces are dealt into shards of bounded size;
each shard evolves on several islands, which are rows of a Spark table, and between epochs each island's elite moves to
the next island. The best chromosome of a shard's islands wins. Pieces of bins that stay underfilled are pooled over all
shards and packed again, level by level, until one shard is left.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tilewright.sources.scratch import written

#: Pieces of a shard, about.
SHARD = 8192
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 3, 2, 4, 24
#: Bins of a generation that displaced pieces are tried in.
TRIED = 96
#: Bins filled less than this share are packed again with those of other shards.
FULL = 0.98

#: Characters that both encoders split into words alike.
PLAIN = re.compile("[\t\n\r -~\xa1-ʯͰ-ͳΆ-ϿА-я‐-‧]*")


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes for themselves, the others, in order,
    for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary by bytes, if its ids follow the order of its merges, as a rank encoder takes it; else None."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte, vocab = _letters(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    words = {*map("".join, merges), *byte}
    return {bytes(byte[c] for c in w): vocab[w] for w in words if w in vocab}


@functools.cache
def _encoder(path: str):
    """Text to ids as little-endian 32-bit numbers, the ids of ``tokenizers`` for the file.

    Texts of usual characters go through a faster encoder over the same file's vocabulary, which gives the same ids; texts
    with others, or with a special token's name in them, go through ``tokenizers`` itself.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]
    ranks = _ranks(path)
    quick = tiktoken.Encoding("quick", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if ranks else None

    def encode(text: str) -> bytes:
        if quick and PLAIN.fullmatch(text) and not any(s in text for s in special):
            return np.array(quick(text), "<u4").tobytes()
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return encode


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, size: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids with ``end_id`` after them, cut where they exceed ``size``."""
    path = tokenizer or default_tokenizer()
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                ids, text = batch.column(0).slice(at, 1000), batch.column(1).slice(at, 1000)
                take, rows = [], [[], [], [], []]
                for i, t in enumerate(text.to_pylist()):
                    b = encode(t or "") + tail
                    n = len(b) // 4
                    edges = [0, *range(n % size or size, n + 1, size)]
                    for p, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        take.append(i)
                        for out, v in zip(rows, (p, s, e - s, zlib.crc32(memoryview(b)[4 * s : 4 * e])), strict=True):
                            out.append(v)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(take, pa.int64())), pa.array(rows[0], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


# --- one shard --------------------------------------------------------------------------------------------------------


def _best_fit(length: np.ndarray, order: list[int], bin_of: np.ndarray, fill: list[int], size: int) -> None:
    """Puts the pieces of ``order`` one after the other into the fullest bin that takes them, else into a new one."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0
    for b, f in enumerate(fill):
        by_room[size - f].append(b)
        rooms |= 1 << (size - f)
    for i in order:
        n = int(length[i])
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), size
            fill.append(0)
        bin_of[i] = b
        fill[b] += n
        by_room[room - n].append(b)
        rooms |= 1 << (room - n)


def _packed(length: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    bin_of = np.zeros(len(length), np.int32)
    _best_fit(length, order.tolist(), bin_of, [], size)
    return bin_of


def _worth(length: np.ndarray, bin_of: np.ndarray, size: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, those that are full and empty rather than even."""
    fill = np.bincount(bin_of, length)
    return -len(fill), float(((fill / size) ** 2).sum())


def _exchange(length: np.ndarray, bin_of: np.ndarray, loose: np.ndarray, rng: np.random.Generator, size: int) -> np.ndarray:
    """Puts one or two loose pieces in the place of one or two of a bin that they fill better; the pieces that are loose then."""
    placed = np.ones(len(length), bool)
    placed[loose] = False
    order = np.flatnonzero(placed)
    order = order[np.argsort(bin_of[order], kind="stable")]
    held_in = bin_of[order]  # a bin is tried once, so its pieces are those that it had
    fill = np.bincount(held_in, length[order]).astype(np.int64)
    open_ = np.flatnonzero((fill < size) & (fill > 0))
    free = loose[np.argsort(length[loose], kind="stable")]
    n = length[free]
    for b in rng.permutation(open_)[:TRIED]:
        if not len(n):
            break
        own = order[np.searchsorted(held_in, b) : np.searchsorted(held_in, b, side="right")][:8]
        out = [(int(i),) for i in own] + [(int(i), int(j)) for x, i in enumerate(own) for j in own[x + 1 :]]
        room = size - int(fill[b])
        best, move = 0, None
        for o in out:
            held = int(length[list(o)].sum())
            k = int(np.searchsorted(n, held + room, side="right")) - 1
            if k >= 0 and n[k] - held > best:
                best, move = int(n[k]) - held, (o, [k])
            if best < room and len(n) > 1:
                first = np.arange(len(n))
                second = np.searchsorted(n, held + room - n, side="right") - 1
                ok = second > first
                if ok.any():
                    total = n[first[ok]] + n[second[ok]]
                    x = int(total.argmax())
                    if total[x] - held > best:
                        best, move = int(total[x]) - held, (o, [int(first[ok][x]), int(second[ok][x])])
            if best == room:
                break
        if move:
            o, ks = move
            bin_of[free[ks]] = b
            back = np.array(o)
            free = np.r_[np.delete(free, ks), back]
            free = free[np.argsort(length[free], kind="stable")]
            n = length[free]
    return free


def _settled(length: np.ndarray, bin_of: np.ndarray, loose: np.ndarray, rng: np.random.Generator, size: int) -> np.ndarray:
    """The chromosome with its loose pieces placed: exchanged for others, then by best fit, the longest first."""
    loose = _exchange(length, bin_of, loose, rng, size)
    placed = np.ones(len(length), bool)
    placed[loose] = False
    child = np.zeros(len(length), np.int32)
    _, child[placed] = np.unique(bin_of[placed], return_inverse=True)
    fill = np.bincount(child[placed], length[placed]).astype(int).tolist() if placed.any() else []
    _best_fit(length, loose[np.argsort(-length[loose], kind="stable")].tolist(), child, fill, size)
    return child


def _cross(length: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator, size: int) -> np.ndarray:
    """``a`` with some of the well-filled bins of ``b``."""
    fill_b = np.bincount(b, length)
    good = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.5))
    chosen = np.zeros(len(fill_b), bool)
    chosen[rng.choice(good, max(1, len(good) // int(rng.integers(2, 8))), replace=False)] = True
    new = chosen[b]
    broken = np.zeros(a.max() + 1, bool)
    broken[a[new]] = True
    child = a.astype(np.int64)
    child[new] = len(broken) + b[new]
    return _settled(length, child, np.flatnonzero(broken[a] & ~new), rng, size)


def _mutated(length: np.ndarray, a: np.ndarray, rng: np.random.Generator, size: int) -> np.ndarray:
    """``a`` with its least filled bins and some others emptied."""
    fill = np.bincount(a, length)
    some = max(2, min(40, len(fill) // 8))
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill, kind="stable")[:some]] = True
    gone[rng.choice(len(fill), min(len(fill), some), replace=False)] = True
    return _settled(length, a.astype(np.int64), np.flatnonzero(gone[a]), rng, size)


def _evolve(length: np.ndarray, known: list[np.ndarray], seed: int, size: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    people = list(known)
    while len(people) < POPULATION:
        noise = rng.normal(0, 0 if not people else 8, len(length))
        people.append(_packed(length, np.argsort(-(length + noise), kind="stable"), size))
    least = -(-int(length.sum()) // size)
    worth = lambda x: _worth(length, x, size)
    people = sorted(((worth(x), i, x) for i, x in enumerate(people)), key=lambda p: (p[0], -p[1]), reverse=True)[:POPULATION]
    for g in range(GENERATIONS):
        if -people[0][0][0] <= least:
            break
        i, j = rng.choice(len(people), 2, replace=False)
        child = _cross(length, people[i][2], people[j][2], rng, size) if g % 4 == 3 else _mutated(length, people[min(i, j)][2], rng, size)
        people = sorted([*people, (worth(child), POPULATION + g, child)], key=lambda p: (p[0], -p[1]), reverse=True)[:POPULATION]
    return [x for _, _, x in people[:2]]


def _epoch(epoch: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                length = np.frombuffer(r["lengths"], "<i4")
                known = [np.frombuffer(x, "<i4") for x in r["elite"] or []]
                best = _evolve(length, known, hash((r["shard"], r["island"], epoch)) & 0xFFFFFFFF, size)
                bins, even = _worth(length, best[0], size)
                yield pa.RecordBatch.from_pylist([{"shard": r["shard"], "island": r["island"], "lengths": r["lengths"], "elite": [x.astype("<i4").tobytes() for x in best], "bins": -bins, "worth": even}], _ISLAND)

    return run


_ISLAND = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("elite", pa.list_(pa.binary())), ("bins", pa.int64()), ("worth", pa.float64())])
_ISLAND_DDL = "shard long, island int, lengths binary, elite array<binary>, bins long, worth double"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.array(x, "<i4").tobytes() for x in batch.column(1).to_pylist()], pa.binary())], ["shard", "lengths"])


def _level(loose: DataFrame, level: int, shards: int, size: int) -> DataFrame:
    """(uid, length, bin, fill) of each piece of ``loose`` (uid, length), packed shard by shard."""
    n = int(loose.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = loose.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)).alias("shard"))
    held = written(dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("own")), "shards")
    lengths = held.select("shard", F.col("own.length").alias("l")).mapInArrow(_gather, "shard long, lengths binary")
    islands = lengths.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "lengths", F.lit(None).cast("array<binary>").alias("elite"))
    for epoch in range(EPOCHS):
        islands = islands.repartition(n, "shard", "island").mapInArrow(_epoch(epoch, size), _ISLAND_DDL)
        if epoch + 1 < EPOCHS:
            islands = written(islands, "islands")
            guests = islands.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("elite", 1, 1).alias("guest"))
            islands = islands.join(guests, ["shard", "island"]).select("shard", "island", "lengths", F.concat("elite", "guest").alias("elite"))
    best = islands.groupBy("shard").agg(F.max_by(F.element_at("elite", 1), F.struct(-F.col("bins"), "worth", -F.col("island"))).alias("won"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, own, won in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                bin_of, length = np.frombuffer(won, "<i4").astype(np.int64), np.array([x["length"] for x in own], np.int64)
                fill = np.bincount(bin_of, length).astype(np.int64)
                order = np.argsort(bin_of, kind="stable")
                place = np.empty(len(length), np.int64)
                ends = np.cumsum(length[order])
                first = np.r_[True, np.diff(bin_of[order]) > 0]
                place[order] = ends - length[order] - np.repeat((ends - length[order])[first], np.diff(np.r_[np.flatnonzero(first), len(order)]))
                yield pa.RecordBatch.from_arrays([pa.array([x["uid"] for x in own], pa.int64()), pa.array(length), pa.array((level << 52) + (shard << 16) + bin_of), pa.array(fill[bin_of]), pa.array(place)],
                                                 ["uid", "length", "sequence_id", "fill", "offset"])

    return held.join(best, "shard").select("shard", "own", "won").mapInArrow(spread, "uid long, length long, sequence_id long, fill long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, size: int = 1024) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces, packed into sequences.

    A null or empty text is the end id alone. Documents of more than ``size`` ids are cut so that only the first piece may
    be shorter. Repeated rows and ids are packed row by row; an empty table gives an empty result. Other columns are not
    looked at. Sequence ids are unique and otherwise arbitrary; offsets in a sequence are gapless from 0.
    """
    cut = written(pieces(docs, id_col, text_col, tokenizer, size).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    loose, level, before, done = cut.where(F.col("length") < size).select("uid", "length"), 0, None, []
    while True:
        count = loose.count()
        if not count:
            break
        shards = -(-count // SHARD)
        got = written(_level(loose, level, shards, size), "packed")
        open_ = got.where(F.col("fill") < FULL * size)
        left = open_.agg(F.countDistinct("sequence_id").alias("bins"), F.sum("length").alias("ids"), F.count_if(F.col("length") * 2 > size).alias("large")).first()
        bins = got.agg(F.countDistinct("sequence_id")).first()[0]
        # the rest is dealt anew while it could do with fewer bins, of which no two large pieces share one, and while that gains
        gains = before is None or before - bins >= max(1, before // 1000)
        if shards == 1 or not gains or not left["bins"] or left["bins"] <= max(-(-left["ids"] // size), left["large"]):
            done.append(got)
            break
        before = left["bins"]
        done.append(got.where(F.col("fill") >= FULL * size))
        loose, level = open_.select("uid", "length"), level + 1
    place = cut.where(F.col("length") == size).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for d in done:
        place = place.union(d.select("uid", "sequence_id", "offset"))
    return cut.join(place, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
