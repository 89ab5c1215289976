import hashlib
import random

import pytest

from tilewright.llm.suffixes import remove_repeats


def brute(rows, depth=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            w = b[p : p + depth]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        off = [False] * len(b)
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < i:
                off[p : p + depth] = [True] * depth
        spans = sum(1 for k, x in enumerate(off) if x and not (k and off[k - 1]))
        kept = bytes(x for x, o in zip(b, off) if not o)
        out[i] = (len(b), sum(off), spans, hashlib.sha256(kept).hexdigest())
    return out


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 60))))
        t = " ".join(parts)
        if rows and rng.random() < 0.15:
            t = rng.choice(rows)[1] or ""
        rows.append((rng.randrange(10**9), t))
    return rows + [(3, None), (4, ""), (5, "x" * 49), (6, "x" * 50), (7, "x" * 300), (8, "ab" * 100), (9, "ba" * 100), (10, "y" + "x" * 49), (11, "ab" * 24 + "q")]


@pytest.mark.parametrize("seed,block", [(1, 1 << 22), (2, 2000)])
def test_against_brute_force(spark, seed, block):
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(docs, block_bytes=block).collect()}
    assert got == brute(rows)


def test_long_text_in_steps(spark, monkeypatch):
    from tilewright.llm import suffixes

    rows = made(3)
    rows.append((2, " ".join(t or "" for _, t in rows)))
    rows.append((10**10, " ".join(t or "" for _, t in rows[::-1])))
    monkeypatch.setattr(suffixes, "STEP", 700)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("hot", [1, 3])
def test_windows_of_hot_anchors_one_by_one(spark, monkeypatch, hot):
    from tilewright.llm import suffixes

    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(6)
    line = "a line that stands in many documents with other words around"
    rows = made(5) + [(20_000 + i, f"{rng.random()} {rng.random()} {line} {rng.random()} {rng.random()}") for i in range(60)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2000).collect()}
    assert got == brute(rows)


def test_equal_fingerprints_of_unlike_runs(spark, monkeypatch):
    """Fingerprints of few bits put unlike runs together; the bytes tell them apart."""
    from tilewright.llm import bytetext, suffixes

    real = bytetext.spans_hash
    monkeypatch.setattr(suffixes.bt, "spans_hash", lambda *a: real(*a) & suffixes.U64(7))
    rows = made(7)
    docs = [(i, (t or "").encode()) for i, t in rows]
    want = brute(rows)
    import pyarrow as pa

    table = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.binary()), "block": pa.array([0] * len(docs), pa.int32())})
    asked = suffixes._ask(50, 1)(table)
    found = suffixes._answer(asked)
    bits = suffixes._sorted(50)(suffixes._send(50, 1)(table, found))
    none = lambda t, **k: pa.table({c: t.column(c) if c in t.column_names else pa.nulls(len(t), k[c]) for c in ("block", "bucket", "part", "anchors", "hot", "gone")})
    back = pa.concat_tables([none(found, part=pa.int64(), gone=pa.binary()), none(bits, anchors=pa.binary(), hot=pa.binary())])
    got = suffixes._removed(50, 1, False)(table, back).to_pylist()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_empty_table_and_kept_bytes(spark):
    schema = "doc_id long, text string, block int, bucket int, kept string"
    assert remove_repeats(spark.createDataFrame([], schema)).count() == 0
    t = "the quick brown fox jumps over the lazy dog and then sleeps for hours"
    rows = [(1, t, 0, 0, ""), (2, "A " + t + " B", 0, 0, ""), (None, t, 0, 0, "")]
    got = {r["doc_id"]: bytes(r["kept"]) for r in remove_repeats(spark.createDataFrame(rows, schema), with_kept=True).collect()}
    assert got == {1: t.encode(), 2: b"A  B"}
