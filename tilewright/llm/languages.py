"""Multilingual mixture inference: the languages of a text and their shares.

A text is cut into segments; each segment has a likelihood under each language, the product of its n-grams' probabilities.
Expectation-maximisation estimates the text's language shares from them. The set of languages is chosen by penalised
likelihood: languages whose share is less than half a segment are given up at once; then the language of least share is
given up as long as the likelihood, less a price for each language kept, does not fall. The price is half the logarithm of the
number of segments and one, and one more.

The probabilities are counts of hashed n-grams over all learning texts, added up by Spark. The model knows every language of the
learning texts; it holds ``SLOTS`` numbers of 32 bits, 64 KB, for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tilewright.llm import bytetext as bt
from tilewright.sources.scratch import written

U64 = np.uint64
BITS = 14
SLOTS = 1 << BITS
GRAM = 4
SEGMENT = 64
ROUNDS = 12


def _grams(d: np.ndarray) -> np.ndarray:
    """The slot of the GRAM bytes that start at each place, and of the bytes that follow the end as zeros."""
    b = np.r_[d, np.zeros(GRAM - 1, np.uint8)].astype(np.uint32)
    g = b[: len(d)].copy()
    for i in range(1, GRAM):
        g = (g << np.uint32(8)) | b[i : len(d) + i]
    return ((g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)


def _folded(column: pa.Array) -> pa.Array:
    """Lower case; digits, punctuation and white space become one space."""
    return pc.replace_substring_regex(pc.utf8_lower(column), r"[\x00-\x60\x7B-\x7F]+", " ")


def _count(langs: list[str]):
    at = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            lang = np.array([at.get(x, -1) for x in batch.column(1).to_pylist()])
            for i in range(0, len(batch), 512):
                data, off = bt.column_bytes(_folded(batch.column(0).slice(i, 512)))
                for a, b, d, o in bt.slices(data, off):
                    g, of = _grams(d), np.repeat(lang[i + a : i + b], np.diff(o))
                    for k in np.unique(of[of >= 0]).tolist():
                        total.setdefault(k, np.zeros(SLOTS, np.int64))
                        total[k] += np.bincount(g[of == k], minlength=SLOTS)
        for k, n in total.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), k, np.int32)), pa.array(slot.astype(np.int32)), pa.array(n[slot])], ["k", "slot", "n"])

    return count


class Model:
    def __init__(self, langs: list[str], log_p: np.ndarray):
        self.langs, self.log_p = langs, log_p


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of the rows given; rows with a null text or language add nothing, repeated rows count anew, and columns of other
    names are not looked at. Without any row it knows no language."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    log_p = np.zeros((SLOTS, max(1, len(langs))), np.float32)
    if langs:
        added = written(rows.mapInArrow(_count(langs), "k int, slot int, n long").groupBy("k", "slot").agg(F.sum("n").alias("n")), "counts")
        prior = np.zeros(SLOTS)
        for r in added.groupBy("slot").agg(F.sum("n").alias("n")).collect():
            prior[r["slot"]] = r["n"]
        prior = prior / max(1.0, prior.sum()) + 1e-6
        own = added.groupBy("k").agg(F.collect_list(F.struct("slot", "n")).alias("c"))
        count = {}
        for r in own.toLocalIterator():  # one language at a time
            counts = np.zeros(SLOTS)
            counts[[c["slot"] for c in r["c"]]] = [c["n"] for c in r["c"]]
            count[r["k"]] = True
            log_p[:, r["k"]] = np.log((counts + 50 * prior) / (counts.sum() + 50 * (1 + 1e-6 * SLOTS)))
        for k in set(range(len(langs))) - count.keys():  # languages of empty texts alone
            log_p[:, k] = np.log(prior / (1 + 1e-6 * SLOTS))
    return Model(langs, log_p)


def _mixture(ll: np.ndarray, text: np.ndarray, n: int, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log likelihood) of n texts by expectation-maximisation over their segments, of the languages kept."""
    first = np.searchsorted(text, np.arange(n))
    size = np.maximum(np.diff(np.r_[first, len(text)]), 1)[:, None]
    top = np.where(kept[text], ll, -np.inf).max(axis=1, keepdims=True)
    p = np.where(kept[text], np.exp(np.maximum(ll - top, -60)), 0)
    share = kept / kept.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = p * share[text]
        share = np.add.reduceat(joint / joint.sum(axis=1, keepdims=True), first, axis=0) / size
    joint = (p * share[text]).sum(axis=1)
    return share, np.add.reduceat(np.log(np.maximum(joint, 1e-300)) + top[:, 0], first)


def mixture(model: Model, d: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The language shares of each folded text of a slice; rows of zeros for empty texts."""
    n, k = len(off) - 1, len(model.langs)
    out = np.zeros((n, max(1, k)))
    full = np.flatnonzero(np.diff(off) > 0)
    if not len(full) or not k:
        return out
    # segments of whole texts: every SEGMENT bytes from the text's begin
    pos = np.arange(len(d)) - np.repeat(off[:-1], np.diff(off))
    start = np.flatnonzero(pos % SEGMENT == 0)
    ll = np.add.reduceat(model.log_p[_grams(d)], start, axis=0).astype(np.float64)
    text = np.searchsorted(full, np.searchsorted(off[1:], start, side="right"))
    segments = np.bincount(text, minlength=len(full))
    price = 0.5 * np.log(segments + 1.0) + 1.0
    share, fit_ = _mixture(ll, text, len(full), np.ones((len(full), k), bool))
    kept = share * segments[:, None] >= 0.5
    kept[np.arange(len(full)), share.argmax(axis=1)] = True
    share, fit_ = _mixture(ll, text, len(full), kept)
    open_ = kept.sum(axis=1) > 1
    while open_.any():
        go = np.flatnonzero(open_)
        fewer = kept[go].copy()
        fewer[np.arange(len(go)), np.where(fewer, share[go], np.inf).argmin(axis=1)] = False
        mine = open_[text]
        new, new_fit = _mixture(ll[mine], np.searchsorted(go, text[mine]), len(go), fewer)
        better = new_fit + price[go] >= fit_[go]
        take = go[better]
        kept[take], share[take], fit_[take] = fewer[better], new[better], new_fit[better]
        open_[:] = False
        open_[take] = kept[take].sum(axis=1) > 1
    out[full] = share
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, langs, shares) for each row: the language of most share, that share, and the mixture.

    ``lang_pred`` is ``und``, with score 0 and no mixture, for a null text, a text without a letter, and where the model
    knows no language. Ties go to the language that is first in alphabetical order. Repeated rows stay; an empty table
    gives an empty result. Texts may be of any length. Only the text is looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                ids, text = batch.column(0).slice(i, 512), batch.column(1).slice(i, 512)
                letters = np.array([any(c.isalpha() for c in t) if t else False for t in text.to_pylist()], bool)
                data, off = bt.column_bytes(_folded(text))
                share = np.concatenate([mixture(model, d, o) for _, _, d, o in bt.slices(data, off)]) if len(ids) else np.zeros((0, 1))
                share[~letters] = 0
                best = share.argmax(axis=1)
                score = np.clip(share[np.arange(len(best)), best], 0, 1)
                known = score > 0
                names = [model.langs[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
                langs = [[model.langs[j] for j in np.flatnonzero(s > 0)] for s in share]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(names, pa.string()), pa.array(score), pa.array(langs, pa.list_(pa.string())), pa.array([s[s > 0] for s in share], pa.list_(pa.float64()))],
                    ["doc_id", "lang_pred", "score", "langs", "shares"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, langs array<string>, shares array<double>")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))
