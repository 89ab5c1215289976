"""The prefix trie against plain Python."""

import hashlib
import random
import zlib

import pytest

from tilewright.llm import prefixes, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Rows (conv_id, turn, role, text), told apart within a turn number by role and digest as the operator states."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.sha256(f"{len((r or '').encode())}:{r or ''}{x or ''}".encode()).digest(), x or ""))
    own = {c: [(r, x) for *_, r, _, x in sorted(v)] for c, v in own.items()}
    members = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        seq = own.get(base, [])[:h] + v[h:]
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append((c, len(seq) == d))
    kids = {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    saved, leaves = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        own_ = (len(m) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            saved[p[:d]] += own_
            leaves[p[:d]] += p not in kids
    least = {p: min(c for c, _ in m) for p, m in members.items()}
    return sorted((least[p], len(p), least[p[:-1]] if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(c for c, end in m if end))).encode()).hexdigest()) for p, m in members.items())


def rows_of(seed, n=400):
    rng = random.Random(seed)
    texts = ["a", "b", "c, d", "é" * 7, "", None, "longer text"]
    rows = []
    for c in range(-120, n - 120):
        if rng.random() < 0.1:
            continue
        same = rng.random() < 0.3  # one conversation that many repeat
        for t in range(4 if same else rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t if rng.random() < 0.95 else None, *(("user", "hello") if same or rng.random() < 0.5 else (rng.choice(["user", "assistant", None]), rng.choice(texts)))))
    return rows


def asked(spark, tmp_path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op12_prefix_trie(spark, str(tmp_path))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("shard", [4, 100_000])
def test_against_brute_force(spark, tmp_path, monkeypatch, shard):
    """Shards so small that most nodes have members in several, in two passes and more."""
    real = prefixes.prefix_nodes
    monkeypatch.setattr(prefixes, "prefix_nodes", lambda s: real(s, shard=shard))
    asked(spark, tmp_path, rows_of(shard) + [(None, 0, "user", "hello"), (7, 3, "user", "a"), (7, 3, "user", "a")])


def test_many_members_and_long_conversations(spark, tmp_path, monkeypatch):
    """Members of one sequence over many pieces; a conversation of thousands of turns beside short ones."""
    rows = [(c, 0, "user", "same") for c in range(100_000, 103_000)] + [(1, t, "user", f"t{t % 50}") for t in range(3000)] + [(2, t, "user", f"t{t % 50}") for t in range(3000)] + [(3, 0, "user", "x" * 300_000)]
    real = prefixes.prefix_nodes
    monkeypatch.setattr(prefixes, "prefix_nodes", lambda s: real(s, shard=500))
    short = [r for r in rows if r[0] > 2 or r[1] < 60]
    asked(spark, tmp_path, short)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "long" / "conversations.parquet"))
    got = queries.op12_prefix_trie(spark, str(tmp_path / "long")).agg({"depth": "max", "n_leaves": "max"}).first()
    assert got["max(depth)"] == max(3000 - zlib.crc32(c) % 6 for c in (b"1", b"2")) and got["max(n_leaves)"] >= 3


def test_empty_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, key string, ids string, path string"
    assert prefixes.prefix_nodes(prefixes.encoded(spark.createDataFrame([], schema))).count() == 0
    got = prefixes.prefix_nodes(prefixes.encoded(spark.createDataFrame([(4, 0, "user", "abc", "x", "y", "z"), (5, 1, "user", "abc", "x", "y", "z")], schema)))
    assert sorted(got.columns) == sorted(COLUMNS)
    assert {(r["depth"], r["conv_id"], r["n_convs"], r["saved_tokens"]) for r in got.collect()} == {(0, 4, 2, 3), (1, 4, 2, 3)}


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.SQL['op12_prefix_trie']})").fetchall(), key=str)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in queries.op12_prefix_trie(spark, "/root/testdata/sf0.01").collect()), key=str) == want
