import random
import re

import pytest

from tilewright.llm.jaccard import jaccard_groups, one_of_each

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, k, num, den):
    sets = {}
    for i, t in rows:
        b = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())
        w = WORD.findall(b)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and den * len(s & t) >= num * len(s | t):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def made(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                w = w + [rng.choice(vocab)]
            t = " ".join(w)
        else:
            t = " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 8, 12, 20, 21, 22, 30, 60, 200])))
        rows.append((i * 3 + 1, t.upper() if rng.random() < 0.1 else t))
    return rows + [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "é"), (9004, "É")]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100)])
def test_against_brute_force(spark, k, num, den):
    rows = made(k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_groups(docs, k=k, num=num, den=den).collect()}
    assert got == brute(rows, k, num, den)


@pytest.mark.parametrize("few", [0, 8])
def test_blocks_agree(spark, monkeypatch, few):
    from tilewright.llm import jaccard

    rows = made(11, 120)
    want = brute(rows, 3, 90, 100)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "FEW_BLOCKS", few)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n long, h1 string, component string")
    assert jaccard_groups(docs).count() == 0
    rows = [(1, "a b c d e f", 1, "x", "y"), (2, "a b c d e f", 2, "x", "y"), (None, "a", 3, "x", "y"), (5, None, 4, None, None)]
    docs = spark.createDataFrame(rows, docs.schema)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_groups(docs).collect()} == {1: 1, 2: 1, 5: 5}
    kept = one_of_each(docs).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 5] and kept[0].asDict().keys() == {"doc_id", "text", "n", "h1", "component"}


def test_ids_of_several_texts_and_null_ids(spark):
    t = [" ".join(f"w{a}" for a in range(b, b + 60)) for b in (0, 200, 400, 600)]
    near = [x + " more" for x in t]
    rows = [(1, t[0]), (1, t[1]), (2, near[1]), (3, near[0]), (4, t[2]), (1, t[0]), (None, near[2]), (None, t[3]), (None, t[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_groups(docs, k=5, num=80).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in one_of_each(docs).collect()) == sorted([(1, t[0]), (1, t[0]), (1, t[1]), (4, t[2]), (0, t[3]), (0, t[3])])


def test_a_chain_of_sets_that_only_meet(spark, monkeypatch):
    """Sets that meet their neighbours by a rare shingle but link with none: copies grow with the lists, not with blocks."""
    from tilewright.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 20)
    n = 2000
    keyed = spark.range(n).selectExpr("explode(array(id, id + 1)) h", "0L a", "0L b", "id node")
    placed = jaccard._cut(spark.range(n).selectExpr("id node", "0L component"))
    copies = lambda spots: spots.selectExpr("node", "inline(spots)").collect()
    first = copies(jaccard._first_spots(placed))
    rest = copies(jaccard._rest_spots(keyed, placed, spark.createDataFrame([], "node long, component long")))
    assert len(first) < 3 * n and len(rest) <= 3 * n
    at = {}
    for r in first + rest:
        at.setdefault(r["node"], set()).add((r["i"], r["j"]))
    assert all(at[x] & at[x + 1] for x in range(n - 1))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Most sets link with the first block; copies grow with the group, not with its square; those apart are still found."""
    from tilewright.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK", 10)
    monkeypatch.setattr(jaccard, "FEW_BLOCKS", 8)
    made_of = {}
    real = jaccard._compared
    monkeypatch.setattr(jaccard, "_compared", lambda t, r, spots, *a: (made_of.setdefault(len(made_of), spots.selectExpr("sum(size(spots)) n").first()["n"]), real(t, r, spots, *a))[1])
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:10] + [f"x{i}"] + base[11:])) for i in range(300)]
    far = base[:10] + [f"q{i}" for i in range(19)] + base[29:]
    rows += [(1000 + i, " ".join(far[:-1] + [f"y{i}"])) for i in range(12)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 3, 90, 100)
    assert 1 <= len(made_of) <= 2 and sum(made_of.values()) < 6 * len(rows)


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    """A group of a few long texts has blocks of its own: so many that none holds much more than the bytes allowed."""
    from tilewright.llm import jaccard

    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 20_000)
    placed = []
    real = jaccard._first_spots
    monkeypatch.setattr(jaccard, "_first_spots", lambda p: (placed.append(p), real(p))[1])
    base = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join([*base[: 500 + i], f"x{i}", *base[500 + i :]])) for i in range(24)] + [(100 + i, f"a b c d e {i % 2}") for i in range(6)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 3, 90, 100)
    assert placed[0].where("component = 0").first()["blocks"] >= 10


def test_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x" * 500_000), (4, "w1 " * 100_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard_groups(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
