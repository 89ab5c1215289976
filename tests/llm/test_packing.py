import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tilewright.llm import packing


def check(got, docs, size, encode):
    by = defaultdict(list)
    seqs = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, t in docs:
        ids = [*encode(t or ""), 2]
        total += len(ids)
        k = -(-len(ids) // size)
        mine = sorted(by[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(k))
        at = 0
        for p, r in enumerate(mine):
            assert r["start"] == at and (r["length"] == size or p == 0)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= size
    return len(seqs), -(-total // size)


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_packing(spark, encode, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 60)
    rng = random.Random(4)
    odd = ["<|endoftext|> x", "\x1c\x1d a  b　c​d", "naïve ÉÜß   \n\n tab\t 12 345¾² don't", "日本語 テスト", "a" * 3000, "", None, "x " * 1023, "x " * 1024, "x " * 5000, "̀ͅ é"]
    docs = list(enumerate(odd)) + [(100 + i, " ".join(rng.choice(["the", "lorem", "Ünï", "12", "x,y"]) for _ in range(rng.choice([1, 5, 100, 300, 700])))) for i in range(300)]
    df = spark.createDataFrame([(i, t, "p") for i, t in docs], "doc_id long, text string, piece string")
    n, least = check(packing.pack(df).collect(), docs, 1024, encode)
    assert n <= least * 1.02 + 2
    assert packing.pack(df.limit(0)).count() == 0


def test_repeated_rows_are_packed_row_by_row(spark):
    df = spark.createDataFrame([(1, "same text")] * 5, "doc_id long, text string")
    got = packing.pack(df, size=4).collect()
    seqs = defaultdict(int)
    for r in got:
        seqs[r["sequence_id"]] += r["length"]
    assert len(got) == 5 and all(v <= 4 for v in seqs.values())


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(3)
    length = rng.integers(1, 1024, 500)
    a, b = (packing._packed(length, rng.permutation(500), 1024) for _ in "ab")
    c = packing._cross(length, a, b, rng, 1024)
    assert np.bincount(c, length).max() <= 1024 and len(np.unique(c)) == c.max() + 1
    best = packing._evolve(length, [], 1, 1024)
    assert best[0].max() + 1 <= min(a.max(), b.max()) + 1


def test_the_genetic_part_saves_bins():
    """Triples that fill a bin exactly, and pieces of 200 to 500: best fit leaves gaps, crossover and mutation close most."""
    rng = np.random.default_rng(0)
    a = rng.integers(256, 420, 400)
    b = rng.integers(256, 1024 - a - 200)
    for length, most in ((np.r_[a, b, 1024 - a - b], 0.5), (rng.integers(200, 500, 2000), 0.75)):
        least = -(-int(length.sum()) // 1024)
        plain = int(packing._packed(length, np.argsort(-length, kind="stable"), 1024).max()) + 1
        best = packing._evolve(length, [], 1, 1024)[0]
        assert np.bincount(best, length).max() <= 1024 and len(np.unique(best)) == best.max() + 1
        assert best.max() + 1 - least <= most * (plain - least)


def test_levels_go_on_while_bins_can_be_saved(spark, monkeypatch, tmp_path):
    """Most pieces stay loose at the first level: they are dealt again until one shard is left."""
    monkeypatch.setattr(packing, "SHARD", 40)
    rng = random.Random(2)
    docs = [(i, " ".join("the" for _ in range(rng.randint(560, 640)))) for i in range(60)] + [(1000 + i, " ".join("the" for _ in range(rng.randint(370, 450)))) for i in range(60)]
    got = packing.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    total = sum(r["length"] for r in got)
    assert len({r["sequence_id"] for r in got}) <= total / 1024 * 1.05 + 1


def test_levels_end_without_gain(spark, monkeypatch):
    """Pieces of which no two fit together are packed once; others go on while a level saves bins."""
    calls = []
    real = packing._level
    monkeypatch.setattr(packing, "_level", lambda loose, level, shards, size: (calls.append(level), real(loose, level, shards, size))[1])
    monkeypatch.setattr(packing, "SHARD", 200)
    monkeypatch.setattr(packing, "pieces", lambda docs, *a: docs.selectExpr("doc_id", "0 piece", "0L start", "cast(length as bigint) length", "0L ids_crc32"))
    rng = random.Random(1)
    large = spark.createDataFrame([(i, rng.randint(600, 899)) for i in range(900)], "doc_id long, length int")
    assert packing.pack(large).select("sequence_id").distinct().count() == 900 and calls == [0]
    calls.clear()
    mixed = spark.createDataFrame([(i, rng.choice([350, 420, 500, 700])) for i in range(900)], "doc_id long, length int")
    got = packing.pack(mixed).collect()
    fill = {}
    for r in got:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert len(got) == 900 and max(fill.values()) <= 1024 and 1 <= len(calls) <= 6
