import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tilewright.llm import languages, quality
from tilewright.llm.queries import op5_language_mixture, op9_quality_trees

SF = "/root/testdata/sf0.01"


def test_remainder(spark):
    got = spark.range(-5, 50).select("id", languages.remainder(F.col("id"), 3).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in got)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = op5_language_mixture(spark, SF).join(docs, "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_mixtures_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = languages.fit(docs)
    t = {r["lang"]: r["text"] for r in docs.where("n_chars > 2000").orderBy("doc_id").collect()}
    rows = [(1, t["en"][:1500] + " " + t["de"][:1500]), (2, None), (3, ""), (4, "123 !!"), (5, t["fr"]), (5, t["fr"]), (6, "a")]
    got = {r["doc_id"]: r for r in languages.predict(spark.createDataFrame([(i, x, "de") for i, x in rows], "doc_id long, text string, lang_pred string"), model).collect()}
    assert sorted(got[1]["langs"]) == ["de", "en"] and all(abs(s - 0.5) < 0.2 for s in got[1]["shares"])
    assert [got[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3 and got[4]["score"] == 0 and got[5]["lang_pred"] == "fr" and got[6]["lang_pred"] != "und"
    none = languages.fit(docs.limit(0))
    assert {r["lang_pred"] for r in languages.predict(docs.limit(5), none).collect()} == {"und"}
    assert languages.predict(docs.limit(0), model).count() == 0


def test_one_language_likelihood_against_plain_sums():
    rng = np.random.default_rng(0)
    model = languages.Model(["a", "b"], np.log(rng.dirichlet(np.ones(languages.SLOTS), 2).T).astype(np.float32))
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 63, 64, 65, 700, 0)]
    d, off = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(x) for x in texts])]
    joint = languages.mixture(model, d, off)
    assert np.allclose(joint[:5].sum(axis=1), 1) and not joint[5].any()


def test_mixtures_against_plain_python():
    """Expectation-maximisation and the choice of languages, computed again with loops over numbers."""
    import math

    rng = np.random.default_rng(5)
    k = 4
    model = languages.Model(list("abcd"), np.log(rng.dirichlet(np.full(languages.SLOTS, 0.05), k).T + 1e-7).astype(np.float32))
    def text(langs):
        out = b""
        for lang in langs:
            pool = [bytes(rng.integers(97, 123, 64).astype(np.uint8)) for _ in range(60)]
            out += max(pool, key=lambda t: sum(float(model.log_p[s, lang]) - float(model.log_p[s].mean()) for s in languages._grams(np.frombuffer(t, np.uint8))))
        return out
    texts = [text([0] * 8), text([1, 2] * 5), text([0, 1, 2, 3] * 6), text([3]), bytes(rng.integers(97, 123, 500).astype(np.uint8))]
    d, off = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(x) for x in texts])]
    got = languages.mixture(model, d, off)

    def em(ll, kept):
        share = {j: 1 / len(kept) for j in kept}
        for _ in range(languages.ROUNDS):
            total = dict.fromkeys(kept, 0.0)
            for row in ll:
                top = max(row[j] for j in kept)
                p = {j: share[j] * math.exp(max(row[j] - top, -60)) for j in kept}
                for j in kept:
                    total[j] += p[j] / sum(p.values())
            share = {j: t / len(ll) for j, t in total.items()}
        return share, sum(max(row[j] for j in kept) + math.log(sum(share[j] * math.exp(max(row[j] - max(row[i] for i in kept), -60)) for j in kept)) for row in ll)

    for i in range(len(texts)):
        slots = languages._grams(d)[off[i] : off[i + 1]]  # the last grams of a text reach into the next one, as in the slice
        ll = [[float(model.log_p[slots[a : a + languages.SEGMENT], j].astype(np.float64).sum()) for j in range(k)] for a in range(0, len(slots), languages.SEGMENT)]
        share, _ = em(ll, list(range(k)))
        kept = [j for j in range(k) if share[j] * len(ll) >= 0.5 or share[j] == max(share.values())]
        share, fit = em(ll, kept)
        while len(kept) > 1:
            fewer = [j for j in kept if j != min(kept, key=lambda j: share[j])]
            new, new_fit = em(ll, fewer)
            if new_fit + 0.5 * math.log(len(ll) + 1) + 1 < fit:
                break
            kept, share, fit = fewer, new, new_fit
        assert np.allclose(got[i], [share.get(j, 0.0) for j in range(k)], atol=2e-3), (i, got[i], share)


def test_many_languages_and_repeated_rows(spark):
    """Every language is learnt, however many there are."""
    rows = [(f"l{i:03d}", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{x}" for x in ("ra", "mo", "ti")) + " ") for i in range(300)]
    docs = spark.createDataFrame([(t * 30, lang, 1) for lang, t in rows for _ in range(2)], "text string, lang string, k int")
    model = languages.fit(docs)
    assert len(model.langs) == 300
    got = languages.predict(spark.createDataFrame([(i, t * 10) for i, (_, t) in enumerate(rows[::30])], "doc_id long, text string"), model).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == [lang for lang, _ in rows[::30]]


def test_statistics_against_plain_python():
    texts = ["The cat. The cat! A dog?\n\nthe CAT 12 %%\nA dog?\n", "", "x", "é|é| ##  a a a", "one two three\none two three\nend."]
    data = [t.encode() for t in texts]
    d, off = np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])]
    got = quality.statistics(d, off)
    low = lambda b: bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    for row, b in zip(got, data, strict=True):
        x = dict(zip(quality.NAMES, row.tolist(), strict=True))
        w, lines = b.split(), [s for s in b.split(b"\n") if s]
        lw, m, n = [low(v) for v in w], max(1, len(w)), len(b)
        want = dict.fromkeys(quality.NAMES, 0.0)
        if n:
            pairs = list(zip(lw, lw[1:], strict=False))
            want |= dict(length=np.log1p(n), words=np.log1p(len(w)), mean_word=sum(map(len, w)) / m, long_word=sum(len(v) > 20 for v in w) / m, upper=sum(65 <= c <= 90 for c in b) / n, lower=sum(97 <= c <= 122 for c in b) / n,
                         digit=sum(48 <= c <= 57 for c in b) / n, space=sum(c in b" \t\n\v\f\r" for c in b) / n, punctuation=sum(c in b".,;:!?'\"()-" for c in b) / n, symbol=sum(c in b"#$%&*+/<=>@[\\]^_`{|}~" for c in b) / n,
                         non_ascii=sum(c > 127 for c in b) / n, lines=len(lines) / n * 100, mean_line=np.log1p(sum(map(len, lines)) / max(1, len(lines))) if lines else 0, short_line=sum(len(s) < 20 for s in lines) / max(1, len(lines)),
                         repeated_line=1 - len({low(s) for s in lines}) / len(lines) if lines else 0, distinct_words=len(set(lw)) / m, repeated_words=1 - len(set(lw)) / m, adjacent_words=sum(p == q for p, q in pairs) / m,
                         top_word=max((lw.count(v) for v in lw), default=0) / m, stop_end=sum(v.endswith((b".", b"?")) for v in w) / m, capital_words=sum(65 <= v[0] <= 90 for v in w) / m, kinds_of_bytes=len(set(b)),
                         repeated_pairs=1 - len(set(pairs)) / len(pairs) if pairs else 0, **{k: b.count(c.encode()) / m for k, c in zip("bar bang hash_sign percent ampersand star dollar".split(), "|!#%&*$", strict=True)})
        assert all(abs(x[k] - float(want[k])) < 1e-4 for k in x), [(k, x[k], want[k]) for k in x if abs(x[k] - float(want[k])) >= 1e-4]


def test_quality_labels_that_are_missing_or_contradict(spark):
    from tilewright.llm.queries import quality_scores

    docs = spark.createDataFrame([(i, f"text {i} " * (i % 9)) for i in range(40)] + [(None, "no id"), (3, "twice")], "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("predicted", F.lit(7)).withColumn("label", F.lit(3))
    none = spark.createDataFrame([], "doc_id long, quality int, label int")
    got = quality_scores(docs, none).collect()
    assert len(got) == 42 and {(r["score"], r["predicted"]) for r in got} == {(0.5, 1)}
    both = spark.createDataFrame([(i, i % 2, 9) for i in range(40)] + [(i, 1, 9) for i in range(40)] + [(5, None, 9), (None, 0, 9)], none.schema)
    assert {r["score"] > 0.9 for r in quality_scores(docs, both).collect()} == {True}
    assert quality_scores(docs.limit(0), both).count() == 0


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = op9_quality_trees(spark, SF)
    assert got.count() == 1000
    p = got.join(labels, "doc_id").where("held_out").toPandas()
    good, bad = p[p.quality == 1].score.to_numpy(), p[p.quality == 0].score.to_numpy()
    auc = ((good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean())
    assert auc > 0.95 and (p[p.quality == 1].predicted == 1).mean() > 0.97


def test_tree_walk_against_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    t = quality.fit_trees(x, y)
    for i in range(20):
        total = t.base
        for k in range(len(t.leaf)):
            node = 0
            while node < 2**quality.DEPTH - 1:
                node = 2 * node + (2 if x[i, t.feature[k, node]] > t.threshold[k, node] else 1)
            total += t.leaf[k, node - (2**quality.DEPTH - 1)]
        assert abs(t.score(x[i : i + 1])[0] - 1 / (1 + np.exp(-total))) < 1e-9
    assert ((t.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    assert (quality.fit_trees(x[:0], y[:0]).score(x) == 0.5).all()


def test_statistics_edges(spark):
    rng = random.Random(0)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "é"), (5, " ".join(rng.choice("abc") for _ in range(300000))), (5, "dup"), (5, "dup")]
    got = quality.features(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, x int")).collect()
    assert len(got) == 7 and all(len(r["x"]) == len(quality.NAMES) and np.isfinite(r["x"]).all() for r in got)
