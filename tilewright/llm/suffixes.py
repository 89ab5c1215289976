"""Removal of byte strings that an earlier document has: a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``depth`` bytes, most significant digit first, and a group of suffixes is dropped from
further passes as soon as one document alone is left in it; the groups that are equal after the last digit are exactly the
repeated windows. Three digits are used.

1. The anchor: of the grams of a window the one with the smallest fingerprint, the leftmost of equals. Equal windows have
   equal anchors at equal places. Neighbouring windows mostly share one, so a run of them travels as one record (its
   first window and the bytes that follow). This digit deals the suffixes out to Spark's partitions; anchors that only one
   document has end here, and only their fingerprints were sent. The windows of a hot anchor, one that stands in ``HOT`` or more
   different runs, are dealt out one by one, by their whole bytes, so that no task holds all of them.
2. The whole run of windows with its bytes. Runs that are equal stay together from here on, with their smallest document.
3. Eight bytes at a time to ``depth``, for the windows of runs that differ but share an anchor.

The first two digits are fingerprints of bytes: any function of a window's bytes may be a digit, for equal windows have equal
digits. A digit may also put unlike windows together; the second is therefore compared byte by byte, and the third is bytes.

Documents are dealt to blocks by id. A block asks the partitions (``buckets``) of the anchors, and the answers come back
to the block, where the documents' texts are. What a block sends holds each anchor or run once, however often the block
has it, so a passage that every document has costs each bucket one record per block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tilewright.llm import bytetext as bt

U64 = np.uint64
GRAM = 20
PLACE = 20  # bits of a slice's positions
STEP = (1 << PLACE) - 4096
#: Windows sorted at once, besides those of one anchor.
WINDOWS = 200_000
#: Different runs with one anchor, summed over blocks, from which on its windows are dealt out one by one.
HOT = 20_000


class Runs:
    """The runs of windows of a slice: first window, number of windows, anchor's fingerprint, document's index."""

    def __init__(self, data: np.ndarray, off: np.ndarray, depth: int):
        n, span = len(data), depth - GRAM + 1
        none = np.zeros(0, np.int64)
        self.start = self.count = self.doc = none
        self.anchor = np.zeros(0, U64)
        if n < depth:
            return
        sums = bt.prefix_sums(data, bt.byte_table(False))
        m = n - GRAM + 1
        gram = bt.mix((sums[GRAM : GRAM + m] - sums[:m]) * bt.powers(n + 1)[1][:m])
        key = (gram >> U64(PLACE) << U64(PLACE)) | np.arange(m, dtype=U64)
        least, width = key, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: n - depth + 1], least[span - width : span - width + n - depth + 1])
        size = np.diff(off)
        doc = np.repeat(np.arange(len(size)), size)[: n - depth + 1]
        fits = off[doc + 1] - np.arange(n - depth + 1) >= depth
        window = np.flatnonzero(fits)
        if not len(window):
            return
        at = (least[window] & U64((1 << PLACE) - 1)).astype(np.int64)
        new = np.r_[True, (np.diff(window) != 1) | (at[1:] != at[:-1]) | (doc[window[1:]] != doc[window[:-1]])]
        first = np.flatnonzero(new)
        self.start, self.count = window[first], np.diff(np.r_[first, len(window)])
        self.anchor, self.doc = gram[at[first]], doc[window[first]]
        self.sums = sums


def _chunks(text: pa.Array, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first document, bytes, offsets, place of the first byte in its document) of slices; longer texts come in steps."""
    data, off = bt.column_bytes(text)
    for i, _, d, o in bt.slices(data, off, STEP):
        if len(d) <= STEP:
            yield i, d, o, 0
        else:
            for c in range(0, max(1, len(d) - depth + 1), STEP - depth + 1):
                piece = d[c : c + STEP]
                yield i, piece, np.array([0, len(piece)]), c


def _cuts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, end) of each bucket that sorted rows have."""
    if len(bucket):
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        yield from zip(bucket[first].tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True)


def _same_bytes(data: np.ndarray, start: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[start : start + size] and data[other : other + size] are the same, for each of the rows."""
    out = np.ones(len(start), bool)
    cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) >> 22)) + 1, len(start)]  # some megabytes at a time
    for i, j in zip(cut[:-1], cut[1:], strict=True):
        if i < j:
            n = size[i:j]
            within, row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(i, j), n)
            out[row[data[start[row] + within] != data[other[row] + within]]] = False
    return out


def _bucket(anchor: np.ndarray, n: int) -> np.ndarray:
    return ((anchor >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


_ASK = "bucket int, block int, anchors binary, several binary, runs binary"
_FOUND = "block int, bucket int, anchors binary, hot binary"
_RUNS = "bucket int, block int, part long, anchors binary, docs binary, counts binary, bytes binary"
_BITS = "block int, bucket int, part long, gone binary"


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.Table.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _ask(depth: int, n_buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        """The anchors of a block, each once, by bucket, with whether several of its documents have it, and its different runs."""
        block = table.column("block")[0].as_py()
        held = []
        for chunk in table.column("text").chunks:
            for _, d, o, _ in _chunks(chunk, depth):
                r = Runs(d, o, depth)
                if not len(r.anchor):
                    continue
                what = bt.spans_hash(r.sums, r.start, r.start + r.count + depth - 1)
                order = np.lexsort((what, r.anchor))
                a, w, doc = r.anchor[order], what[order], r.doc[order]
                other = np.r_[True, a[1:] != a[:-1]]
                first = np.flatnonzero(other)
                held.append((a[first], np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first), np.add.reduceat((other | np.r_[True, w[1:] != w[:-1]]).astype(np.int64), first)))
        anchors, several, runs = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, U64), np.zeros(0, bool), np.zeros(0, np.int64))
        # several slices hold different documents, but for a text of more than one slice, where asking too much does no harm
        anchors, place, count = np.unique(anchors, return_inverse=True, return_counts=True)
        more = count > 1
        more |= np.bincount(place, several, len(anchors)) > 0
        runs = np.minimum(np.bincount(place, runs, len(anchors)), 65535).astype(np.uint16)
        return _table([(b, block, anchors[i:j].tobytes(), np.packbits(more[i:j]).tobytes(), pa.compress(runs[i:j].tobytes(), codec="zstd", asbytes=True)) for b, i, j in _cuts(_bucket(anchors, n_buckets))], _ASK)

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors those that several documents have, for each block that asked for them, and whether they are hot."""
    asked = [np.frombuffer(x, U64) for x in table.column("anchors").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)).astype(bool) for x, a in zip(table.column("several").to_pylist(), asked, strict=True)]
    runs = [np.frombuffer(pa.decompress(x, decompressed_size=2 * len(a), codec="zstd", asbytes=True), np.uint16) for x, a in zip(table.column("runs").to_pylist(), asked, strict=True)]
    every = np.concatenate(asked)
    order = np.argsort(every, kind="stable")
    every, n = every[order], np.concatenate(runs)[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    blocks, total = np.diff(np.r_[first, len(every)]), np.add.reduceat(n, first)
    often, hot = every[first][blocks > 1], every[first][total >= HOT]
    rows = []
    for block, a, s in zip(table.column("block").to_pylist(), asked, several, strict=True):
        hit = s | _among(a, often)
        if hit.any():
            rows.append((block, table.column("bucket")[0].as_py(), a[hit].tobytes(), np.packbits(_among(a[hit], hot)).tobytes()))
    return _table(rows, _FOUND)


def _among(a: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(a), bool)
    at = np.searchsorted(known, a)
    at[at == len(known)] = 0
    return known[at] == a


def _known(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The found anchors of a block in their order, and whether each is hot."""
    if not answers.num_rows:
        return np.zeros(0, U64), np.zeros(0, bool)
    found = [np.frombuffer(x, U64) for x in answers.column("anchors").to_pylist()]
    hot = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(a)).astype(bool) for x, a in zip(answers.column("hot").to_pylist(), found, strict=True)]
    found, hot = np.concatenate(found), np.concatenate(hot)
    order = np.argsort(found, kind="stable")
    return found[order], hot[order]


class Sent:
    """What a slice sends: runs, or single windows of hot anchors, in the order of anchor, content and document. ``new`` marks
    the first of those that are equal; only it is sent, the others share its answer."""

    def __init__(self, d: np.ndarray, r: Runs, ids: np.ndarray, found: np.ndarray, hot: np.ndarray, depth: int):
        take = np.flatnonzero(_among(r.anchor, found))
        warm = hot[np.searchsorted(found, r.anchor[take])] if len(take) else np.zeros(0, bool)
        single, whole = take[warm], take[~warm]
        n = r.count[single]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.r_[r.start[whole], np.repeat(r.start[single], n) + within]
        count = np.r_[r.count[whole], np.ones(len(within), np.int64)]
        index = np.r_[r.doc[whole], np.repeat(r.doc[single], n)]
        what = bt.spans_hash(r.sums, start, start + count + depth - 1) if len(start) else np.zeros(0, U64)
        # a window of a hot anchor has a digit of its own: its bytes, salted so that it meets no anchor
        anchor = np.r_[r.anchor[whole], bt.mix(what[len(whole) :] ^ U64(0xA0761D6478BD642F))]
        doc = ids[index]
        order = np.lexsort((doc, what, anchor))
        self.start, self.count, self.index, self.anchor, self.doc = start[order], count[order], index[order], anchor[order], doc[order]
        what = what[order]
        self.new = np.ones(len(order), bool)
        if len(order) > 1:
            before = np.arange(len(order) - 1)
            alike = (self.anchor[1:] == self.anchor[:-1]) & (what[1:] == what[:-1]) & (self.count[1:] == self.count[:-1])
            at = before[alike]
            same = _same_bytes(d, self.start[at], self.start[at + 1], self.count[at] + depth - 1)
            self.new[at[same] + 1] = False


def _in_order(docs: pa.Table) -> pa.Table:
    """A block's documents in an order that does not depend on how they arrived."""
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _sent(text: pa.ChunkedArray, ids: np.ndarray, answers: pa.Table, depth: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int, Sent]]:
    """(number, first document, bytes, offsets, place in the document) of each slice that sends something, and what it sends."""
    found, hot = _known(answers)
    base, part = 0, 0
    for chunk in text.chunks:
        for i, d, o, c in _chunks(chunk, depth):
            r = Runs(d, o, depth)
            if len(r.anchor) and len(found):
                sent = Sent(d, r, ids[base + i :], found, hot, depth)
                if len(sent.new):
                    yield part, base + i, d, o, c, sent
            part += 1
        base += len(chunk)


def _send(depth: int, n_buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The runs of a block that go on to the next digits, by bucket."""
        rows = []
        if docs.num_rows and answers.num_rows:
            block = docs.column("block")[0].as_py()
            docs = _in_order(docs)
            for part, _, d, _, _, sent in _sent(docs.column("text"), docs.column("doc_id").to_numpy(), answers, depth):
                anchor, doc, count, start = (x[sent.new] for x in (sent.anchor, sent.doc, sent.count, sent.start))
                size = count + depth - 1
                ends = np.cumsum(size)
                index = np.repeat(start - (ends - size), size) + np.arange(ends[-1])
                data, ends = d[index], np.r_[0, ends]
                rows += [(b, block, part, anchor[i:j].tobytes(), doc[i:j].tobytes(), count[i:j].astype(np.uint8).tobytes(), pa.compress(data[ends[i] : ends[j]].tobytes(), codec="zstd", asbytes=True))
                         for b, i, j in _cuts(_bucket(anchor, n_buckets))]
        return _table(rows, _RUNS)

    return send


def _words_at(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each place, as one number."""
    out = data[place].astype(U64)
    for i in range(1, 8):
        out = (out << U64(8)) | data[place + i]
    return out


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group of each in that order) by the keys, the first of them the most significant."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def _least(order: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest document of each row's group, and whether the group has another, in the order of the rows."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    small, large = np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)
    least, more = np.empty_like(doc), np.empty(len(doc), bool)
    least[order], more[order] = small[group], (small != large)[group]
    return least, more


def _run_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The fingerprints of runs that lie one behind the other, some of them at a time."""
    out, table = [], bt.byte_table(False)
    for i in range(0, len(start), 10_000):
        s, n = start[i : i + 10_000], size[i : i + 10_000]
        piece = data[s[0] : s[-1] + n[-1]]
        out.append(bt.spans_hash(bt.prefix_sums(piece, table), s - s[0], s - s[0] + n))
    return np.concatenate(out) if out else np.zeros(0, U64)


def _by_bytes(data, start, n, group, doc, kinds, depth, bits) -> None:
    """Third digit: sets in ``bits`` (of each kind of run) the windows that a run of a smaller document has too.

    Passes of eight bytes; a window leaves as soon as it is alone with its document.
    """
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place, owner = np.repeat(start, n) + within, np.repeat(np.arange(len(n)), n)
    of, alive, group = doc[owner], np.arange(len(place)), group[owner]
    for d in [*range(0, depth - 8, 8), depth - 8]:
        order, g = _groups(group, _words_at(data, place[alive] + d))
        small, more = _least(order, g, of[alive])
        group = np.empty(len(alive), np.int64)
        group[order] = g
        alive, group, small = alive[more], group[more], small[more]
        if not len(alive):
            return
    gone = alive[small < of[alive]]
    np.bitwise_or.at(bits, kinds[owner[gone]], U64(1) << within[gone].astype(U64))


def _sorted(depth: int):
    def radix(table: pa.Table) -> pa.Table:
        """For each window of the runs of a bucket, whether a smaller document has it (a bit), the document of its run aside."""
        table = table.sort_by([("block", "ascending"), ("part", "ascending")])
        load = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        per = [len(x) for x in table.column("counts").to_pylist()]
        anchor, doc = np.concatenate(load("anchors", U64)), np.concatenate(load("docs", np.int64))
        counts = [x.astype(np.int64) for x in load("counts", np.uint8)]
        data = np.concatenate([np.frombuffer(pa.decompress(x, decompressed_size=int((n + depth - 1).sum()), codec="zstd", asbytes=True), np.uint8) for x, n in zip(table.column("bytes").to_pylist(), counts, strict=True)])
        count = np.concatenate(counts)
        size = count + depth - 1
        start = np.cumsum(size) - size
        # second digit: whole runs, by fingerprint; what then differs byte by byte gets another one
        digit = _run_hashes(data, start, size)
        while True:
            order, group = _groups(anchor, size.astype(U64), digit)
            lead = order[np.flatnonzero(np.r_[True, group[1:] != group[:-1]])][group]
            same = _same_bytes(data, start[order], start[lead], size[order])
            if same.all():
                break
            digit[order[~same]] += U64(1)
        least, _ = _least(order, group, doc)
        one = order[np.r_[True, group[1:] != group[:-1]]]  # of each kind of run one
        kind = np.empty(len(anchor), np.int64)
        kind[order] = group
        # whole: every window of the run is removed from all documents but the smallest that has the run; the rest is by window
        _, alike, n_kinds = np.unique(anchor[one], return_inverse=True, return_counts=True)
        hard = n_kinds[alike] > 1
        kinds = len(one)
        bits = np.zeros(kinds, U64)
        which = np.flatnonzero(hard)
        which = which[np.argsort(alike[which], kind="stable")]
        edge = np.flatnonzero(np.r_[True, np.diff(alike[which]) > 0, True]) if len(which) else np.zeros(1, np.int64)
        ends_at = np.r_[0, np.cumsum(count[one[which]])][edge]
        i = 0
        while i + 1 < len(edge):
            # as many anchors as have WINDOWS windows, or one
            j = max(i + 1, int(np.searchsorted(ends_at, ends_at[i] + WINDOWS, side="right")) - 1)
            kinds_here = which[edge[i] : edge[j]]
            _by_bytes(data, start[one[kinds_here]], count[one[kinds_here]], alike[kinds_here], least[one[kinds_here]], kinds_here, depth, bits)
            i = j
        # a window's bit counts for every document; without it, for all but the smallest that has the run
        mine = bits[kind]
        rest = doc != least
        full = (U64(1) << count.astype(U64)) - U64(1)
        mine = np.where(rest, full, mine)
        cut = np.r_[0, np.cumsum(per)]
        return pa.Table.from_arrays(
            [table.column("block").combine_chunks(), table.column("bucket").combine_chunks(), table.column("part").combine_chunks(), pa.array([mine[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
            ["block", "bucket", "part", "gone"])

    return radix


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(depth: int, n_buckets: int, with_kept: bool):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = _in_order(docs)
        ids, text = docs.column("doc_id").to_numpy(), docs.column("text")
        known = answers.filter(pc.is_null(answers.column("part")))
        parts, buckets, gone = (answers.column(x).to_pylist() for x in ("part", "bucket", "gone"))
        bits = {(p, b): np.frombuffer(g, U64) for p, b, g in zip(parts, buckets, gone, strict=True) if p is not None}
        starts: dict[int, list[np.ndarray]] = {}
        for part, base, _, o, c, sent in _sent(text, ids, known, depth):
            new, doc = sent.new, sent.doc
            mine = np.concatenate([bits[part, b] for b, _, _ in _cuts(_bucket(sent.anchor[new], n_buckets))])
            group = np.cumsum(new) - 1
            least = doc[new]  # of equal runs of the slice, the smallest document comes first
            full = (U64(1) << sent.count.astype(U64)) - U64(1)
            mask = np.where(doc != least[group], full, mine[group])
            k = np.flatnonzero(mask)
            n = sent.count[k]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            on = (np.repeat(mask[k], n) >> within.astype(U64)) & U64(1) == 1
            place, who = (np.repeat(sent.start[k], n) + within)[on], np.repeat(sent.index[k], n)[on]
            by = np.argsort(who, kind="stable")
            place, who = place[by], who[by]
            if not len(who):
                continue
            edge = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            for i, j in zip(edge, [*edge[1:], len(who)], strict=True):
                starts.setdefault(base + int(who[i]), []).append(place[i:j] - o[who[i]] + c)
        rows, at = [[], [], [], [], [], []], 0
        for chunk in text.chunks:
            data, off = bt.column_bytes(chunk)
            for i in range(len(chunk)):
                d, hit = data[off[i] : off[i + 1]], starts.get(at)
                removed = spans = 0
                if hit:
                    cover = np.zeros(len(d) + 1, np.int32)
                    s = np.unique(np.concatenate(hit))
                    cover[s] += 1
                    np.add.at(cover, s + depth, -1)
                    off_ = np.cumsum(cover[:-1]) > 0
                    removed, spans = int(off_.sum()), int((off_[1:] & ~off_[:-1]).sum() + off_[0])
                    d = d[~off_]
                kept = d.tobytes()
                for out, x in zip(rows, (int(ids[at]), int(off[i + 1] - off[i]), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None), strict=True):
                    out.append(x)
                at += 1
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return remove


def _block_bytes(total: int) -> int:
    """Bytes of a block: so many that a block's records for a bucket hold 16 anchors or more as long as the blocks fit a task."""
    return min(32 << 20, max(4 << 20, math.isqrt(480 * total)))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 50, block_bytes: int | None = None, with_kept: bool = False) -> DataFrame:
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256), and with ``with_kept`` the ``kept`` bytes.

    Each byte covered by a ``depth``-byte string that also starts in a document with a smaller id is removed; strings are
    judged on the input, overlaps count, and no string crosses documents. A null or empty text has no bytes and loses
    none; rows with a null id are left out; rows that share an id are judged as one document and come back row by row.
    Texts may be of any length. An empty table gives an empty result. Other columns are not looked at. ``depth`` lies between
    28 and 82.
    """
    if not GRAM + 8 <= depth <= GRAM + 62:
        raise ValueError(f"depth must lie between {GRAM + 8} and {GRAM + 62}")
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text")).where("doc_id is not null")
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    block_bytes, usual = block_bytes or _block_bytes(total), int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = n_blocks = max(usual, -(-total // block_bytes))
    tasks = -(-total // (64 << 20))
    by = lambda df, key: (df.repartition(tasks, key) if tasks > usual else df).groupBy(key)
    texts = by(docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")), "block")
    asked = texts.applyInArrow(_ask(depth, n_buckets), _ASK)
    found = by(asked, "bucket").applyInArrow(_answer, _FOUND)
    runs = texts.cogroup(by(found, "block")).applyInArrow(_send(depth, n_buckets), _RUNS)
    bits = by(runs, "bucket").applyInArrow(_sorted(depth), _BITS)
    back = found.select("block", "bucket", F.lit(None).cast("long").alias("part"), "anchors", "hot", F.lit(None).cast("binary").alias("gone")).unionByName(
        bits.select("block", "bucket", "part", F.lit(None).cast("binary").alias("anchors"), F.lit(None).cast("binary").alias("hot"), "gone"))
    out = texts.cogroup(by(back, "block")).applyInArrow(_removed(depth, n_buckets, with_kept), _RESULT)
    return out if with_kept else out.drop("kept")
