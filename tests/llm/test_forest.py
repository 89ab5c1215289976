"""The LSH forest against all pairs in plain Python."""

import random

import numpy as np
import pytest

from tests.llm.test_jaccard import brute, made
from tilewright.llm import forest, queries


def asked(spark, rows, **how):
    got = forest.forest_groups(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


@pytest.mark.parametrize("most", [2048, 3])
def test_against_brute_force(spark, most):
    """Also with regions of three sets, so that most regions go as deep as the signatures."""
    rows = made(4, 300)
    got, want = asked(spark, rows, most=most), brute(rows, 4, 80, 100)
    if most > 3:
        assert got == want
    assert got.keys() == want.keys() and sum(got[i] == want[i] for i in want) >= 0.97 * len(want)
    assert all(want[i][1] <= got[i][1] for i in want)


def test_exactly_at_the_threshold(spark):
    """400 pairs of similarity 0.8: sets of nine shingles that have eight in common."""
    rows = []
    for i in range(400):
        w = [f"p{i}x{j}" for j in range(12)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-1], "end"]))]
    assert asked(spark, rows) == brute(rows[:0], 4, 80, 100) | {d: (9, d - d % 2) for d in range(800)}


def test_regions_over_pieces():
    """Cut in two anywhere, pieces give each region the labels that the whole gives it, unless one part is cut deeper."""
    rng = np.random.default_rng(3)
    order = np.unique(rng.integers(0, 2, (300, forest.DEPTH + 1)).astype(np.uint32), axis=0)

    def pairs(pieces):
        found, at = {}, 0
        for p in pieces:
            for _, rows, label in forest.regions(p, 1000):
                for r, h in zip(rows, label, strict=True):
                    found.setdefault(int(h), set()).add(int(r) + at)
            at += len(p)
        return {(a, b) for x in found.values() for a in x for b in x if a < b}

    want = {(a, b) for a in range(len(order)) for b in range(a + 1, len(order)) if (order[a, : 1 + forest.LEAST] == order[b, : 1 + forest.LEAST]).all()}
    for cut in (0, 1, 7, 50, len(order) - 1, len(order)):
        assert pairs([order[:cut], order[cut:]]) == want


def test_adaptive_depth():
    order = np.zeros((100, forest.DEPTH + 1), np.uint32)
    order[50:, forest.LEAST + 1] = 1
    order[:, forest.DEPTH] = np.arange(100)
    depths = {int(r): d for d, rows, _ in forest.regions(order, 60, (False, False)) for r in rows}
    assert set(depths.values()) == {forest.LEAST + 1} and len(depths) == 100
    assert [d for d, _, _ in forest.regions(order, 100, (False, False))] == [forest.LEAST]


def test_large_groups(spark, monkeypatch):
    from tilewright.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 10)
    monkeypatch.setattr(jaccard, "FEW_BLOCKS", 2)
    base = [f"w{i}" for i in range(120)]
    rng = random.Random(2)
    rows = []
    for i in range(200):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    assert asked(spark, rows, most=20) == brute(rows, 4, 80, 100)


def test_edges_of_input(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n long, sig string, node long")
    assert forest.forest_groups(docs).count() == 0
    rows = [(1, "a b c d e f", 1, "x", 2), (2, "A b c d e f", 2, "x", 2), (None, "a", 3, "x", 2), (5, None, 4, None, 2), (6, "", 4, None, 2), (7, "w " * 200_000, 1, "", 1), (8, "one", 1, "", 1), (1, "a b c d e f", 1, "x", 2)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in forest.forest_groups(spark.createDataFrame(rows, docs.schema)).collect())
    assert got == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (8, 1, 8, True)]


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = sorted(con.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({queries.SQL['op11_lsh_forest']})").fetchall())
    assert sorted(tuple(r) for r in queries.op11_lsh_forest(spark, "/root/testdata/sf0.01").collect()) == want
