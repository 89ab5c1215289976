"""The Merkle manifest against plain Python, and its proofs against its root."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tilewright.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """(root, for each node its path of (place, siblings))."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(own):
            run = nodes[i - i % 8 : i - i % 8 + 8]
            paths[k].append((i % 8, run[: i % 8] + run[i % 8 + 1 :]))
        own = [i // 8 for i in own]
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def fold(leaf, path):
    for place, s in path:
        leaf = H(*s[:place], leaf, *s[place:])
    return leaf


def brute(rows):
    leaf = lambda r, t: H(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], t)))
    trees = {}
    for r in rows:
        t = r["text"]
        bad = r["doc_id"] is not None and t is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if bad else t
        trees.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, t), leaf(r, low)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for x in trees.values():
        x.sort(key=lambda y: (y[0] is not None, y[0] or 0, y[1]))
    subs = {x: climb([y[1] for y in trees[x]]) for x in order}
    root, over = climb([subs[x][0] for x in order])
    out = []
    for k, x in enumerate(order):
        for (i, a, b), path in zip(trees[x], subs[x][1]):
            whole = path + over[k]
            got = fold(b, whole)
            out.append((i, a, subs[x][0], root, H(*[s for _, ss in whole for s in ss]), got, got == root))
    return out


def asked(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_merkle_manifest(spark, str(tmp_path)).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1:])
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r[c] for c in cols) for r in got), key=key) == sorted(brute([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in rows]), key=key)
    return got


@pytest.mark.parametrize("height", [1, 2])
def test_many_levels(spark, tmp_path, monkeypatch, height):
    """Superblocks of 8 and 64 leaves, so that tops have superblocks of their own; one language has most rows."""
    real = merkle.manifest
    monkeypatch.setattr(merkle, "manifest", lambda *a, **b: real(*a, **b, height=height))
    rows = [(i * 7 % 5000, f"Text {i} ß", "en" if i % 10 else f"l{i % 90}", "web" if i % 3 else None, i) for i in range(700)]
    rows += [(9000 + i, "A", f"x{i:03}", None, None) for i in range(75)] + [(8000, "Solo", None, "s", 4), (8001, None, "Z", "s", None), (8002, "", "Z", "", 0)]
    got = asked(spark, tmp_path, rows)
    assert any(r["verified"] for r in got) and not all(r["verified"] for r in got)


def test_ties_nulls_repeats(spark, tmp_path):
    rows = [(1, "A", "en", "s", 1)] * 9 + [(1, "B", "en", "s", 1), (None, "C", "en", "s", 1), (None, None, None, None, None), (3, "x" * 300_000 + "Y", "en", "s", 1)]
    asked(spark, tmp_path, rows)


def test_one_row_and_none(spark, tmp_path):
    got = asked(spark, tmp_path, [(5, "abc", "en", "s", 3)])
    assert got[0]["leaf"] == got[0]["subroot"] == got[0]["root"] and got[0]["proof_sha256"] == H()
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA), FIELDS)
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_proofs_and_clashing_columns(spark):
    rows = [(i, f"T{i}", "en" if i % 4 else "de", i, "x", "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, node long, tree string, p string")
    got = merkle.manifest(docs, ["doc_id", "text"], presented={"text": F.when(F.col("doc_id") == 7, "T8").otherwise(F.col("text"))}, proofs=True).collect()
    assert len(got) == 40
    for r in got:
        path = [(x["place"], list(x["siblings"])) for x in r["proof"]]
        assert fold(r["leaf"], path) == r["root"] and H(*[s for _, ss in path for s in ss]) == r["proof_sha256"]
        assert r["verified"] == (r["doc_id"] != 7) == (r["folded_root"] == r["root"])


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    got = queries.op13_merkle_manifest(spark, "/root/testdata/sf0.01").toPandas().sort_values("doc_id").reset_index(drop=True)
    want = con.execute(queries.SQL["op13_merkle_manifest"]).df().sort_values("doc_id").reset_index(drop=True)
    assert got.equals(want[got.columns.tolist()].astype(got.dtypes.to_dict()))
