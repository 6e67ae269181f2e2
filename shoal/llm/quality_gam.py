"""Text quality by a generalised additive model with pairwise interactions.

The model (GA2M, Lou et al. 2013) is a sum of lookup tables over binned features,
one per feature and one per chosen pair. It is boosted in cycles: each turn fits a
tree of at most four leaves to the residuals of one feature's bins and adds it to
that feature's table, one feature after the other, so that no feature takes what
others explain as well. Then the pairs whose binned residuals a tree reduces
most get tables in the same way. Scoring looks up bins and adds.

The fit uses a bounded sample: the labelled, not held-out documents of least
hash, ``SAMPLE`` ids at most. Features come from whole texts, in tasks; scoring is one
pass without a shuffle.

Defined results: a null text counts as empty, and empty texts are scored like
any other. A row is held out if crc32 of its doc_id as text leaves 2 modulo 4; a null
doc_id is not held out and has no label. Of several texts or labels of an id the
least is learned from. Without labels of both kinds the score is their share (0.5 without
any). Repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import bounded_sample
from shoal.llm.quality_rules import count_text

SAMPLE = 20_000
BINS = 32
PAIR_BINS = 12
PAIRS = 8
CYCLES = 120
PAIR_CYCLES = 60
RATE = 0.1
CUT = 0.7
FEATURES = ("n_words", "word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "words_per_line", "distinct_ratio",
            "top_word_ratio", "capital_ratio", "digit_ratio", "mark_ratio", "shout_ratio", "pipe_ratio", "wide_ratio",
            "title_ratio", "long_word_ratio", "at_ratio", "last_mark")


def text_features(text: str | None) -> tuple[float, ...]:
    """The features of one text, in the order of ``FEATURES``."""
    text = text or ""
    n, chars, symbols, dups, repeated, lines = count_text(text)
    data = text.encode()
    words = data.split()
    counts = Counter(words)
    n1, c1 = max(n, 1), max(chars, 1)
    upper = sum(map(data.count, _UPPER))
    return (
        np.log1p(n), chars / n1, symbols / c1, dups / max(lines, 1), repeated / n1, np.log1p(n / max(lines, 1)),
        len(counts) / n1, max(counts.values(), default=0) / n1, upper / c1, sum(map(data.count, _DIGITS)) / c1,
        sum(map(text.count, ".,;:")) / n1, sum(map(text.count, "!?")) / n1, text.count("|") / n1, len(data) / max(len(text), 1),
        sum(k for w, k in counts.items() if w[:1].isupper()) / n1, sum(k for w, k in counts.items() if len(w) > 12) / n1,
        (text.count("@") + text.count("://")) / n1, float(text.rstrip()[-1:] in (".", "!", "?")))


_UPPER = [bytes([c]) for c in range(65, 91)]
_DIGITS = [bytes([c]) for c in range(48, 58)]


class Gam:
    """Cut points of each feature, tables of bins and of pairs of coarse bins."""

    def __init__(self, base: float, cuts: list[np.ndarray], tables: list[np.ndarray],
                 coarse: list[np.ndarray], pairs: dict[tuple[int, int], np.ndarray]):
        self.base, self.cuts, self.tables, self.coarse, self.pairs = base, cuts, tables, coarse, pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of features."""
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (a, b), table in self.pairs.items():
            out += table[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-out))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def _leaf(g, h):
    return g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins on the left) of the best single cut of a row of bins; 0 if none gains."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    gain[(hl < 1) | (hr < 1)] = 0.0
    k = int(gain.argmax())
    return (float(gain[k]), k + 1) if gain[k] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of each bin: a cut, and a cut of either side."""
    out = np.zeros(len(g))
    _, k = _best_cut(g, h)
    for lo, hi in ((0, k), (k, len(g))):
        _, m = _best_cut(g[lo:hi], h[lo:hi])
        for a, b in ((lo, lo + m), (lo + m, hi)):
            if b > a:
                out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of a grid of bins, and the gain: a cut of one axis, and of each
    side a cut of the other one."""
    best = (np.zeros_like(g), 0.0)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for k in range(1, len(gg)):
            out, gain = np.zeros_like(gg), -g.sum() ** 2 / (h.sum() + 1)
            for lo, hi in ((0, k), (k, len(gg))):
                gs, hs = gg[lo:hi].sum(axis=0), hh[lo:hi].sum(axis=0)
                _, m = _best_cut(gs, hs)
                for a, b in ((0, m), (m, len(gs))):
                    if b > a:
                        v = _leaf(gs[a:b].sum(), hs[a:b].sum())
                        out[lo:hi, a:b] = v
                        gain += v * gs[a:b].sum()
            if gain > best[1] + 1e-9:
                best = (out.T if turned else out, float(gain))
    return best


def train(x: np.ndarray, y: np.ndarray, cycles: int = CYCLES, pairs: int = PAIRS) -> Gam:
    """The model of the rows ``x`` and labels ``y`` (0, 1). A sixth of the rows
    only watches: boosting keeps the cycles up to its least loss."""
    n = x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    cuts = [_cuts(x[:, j], BINS) if len(x) else np.zeros(0) for j in range(n)]
    coarse = [_cuts(x[:, j], PAIR_BINS) if len(x) else np.zeros(0) for j in range(n)]
    model = Gam(base, cuts, [np.zeros(len(c) + 1) for c in cuts], coarse, {})
    if len(np.unique(y)) < 2:
        return model
    watch = np.arange(len(y)) % 6 == 0 if len(y) >= 60 else np.zeros(len(y), bool)
    use = ~watch
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    f = np.full(len(y), base)

    def residuals():
        p = 1 / (1 + np.exp(-f))
        return np.where(use, y - p, 0.0), np.where(use, p * (1 - p), 0.0)

    def loss():
        rows = watch if watch.any() else use
        return float(np.logaddexp(0, np.where(y[rows] > 0.5, -f[rows], f[rows])).mean())

    def boost(turns, tables, at, cycles):
        """Cycles over ``turns``; ``at(t)`` gives the flat bins of the rows of a
        turn, and ``tables`` the table and tree of each."""
        nonlocal f
        kept, least, best_f = None, loss(), f.copy()
        for _ in range(cycles):
            for t in turns:
                g, h = residuals()
                table, tree = tables[t]
                size = table.size
                step = RATE * tree(np.bincount(at[t], g, size).reshape(table.shape), np.bincount(at[t], h, size).reshape(table.shape))
                table += step
                f = f + step.ravel()[at[t]]
            if (now := loss()) < least - 1e-6:
                kept, least, best_f = {t: tables[t][0].copy() for t in turns}, now, f.copy()
        for t in turns:
            tables[t][0][...] = kept[t] if kept else 0.0
        f = best_f

    boost(list(range(n)), {j: (model.tables[j], _tree) for j in range(n)}, dict(enumerate(bins)), cycles)
    c_bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(coarse)]
    width = [len(c) + 1 for c in coarse]
    g, h = residuals()
    flat = {(a, b): c_bins[a] * width[b] + c_bins[b] for a in range(n) for b in range(a + 1, n)}
    gains = {}
    for (a, b), at in flat.items():
        shape = (width[a], width[b])
        gains[a, b] = _pair_tree(np.bincount(at, g, shape[0] * shape[1]).reshape(shape), np.bincount(at, h, shape[0] * shape[1]).reshape(shape))[1]
    chosen = sorted((p for p in gains if gains[p] > 0), key=lambda p: (-gains[p], p))[:pairs]
    model.pairs = {p: np.zeros((width[p[0]], width[p[1]])) for p in chosen}
    boost(chosen, {p: (model.pairs[p], lambda g, h: _pair_tree(g, h)[0]) for p in chosen}, {p: flat[p] for p in chosen}, PAIR_CYCLES if chosen else 0)
    return model


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in texts])


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Gam:
    """The model learned from the sampled labels that are not held out."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~is_held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    some = bounded_sample(known, sample)  # bounded, so it may be broadcast
    own = documents.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    rows = (own.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
            .select("doc_id", "quality", _features("text").alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(FEATURES))
    return train(x, np.array([r["quality"] for r in rows], float))


def quality_scores(documents: DataFrame, labels: DataFrame | None = None, model: Gam | None = None) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = model or fit(documents, labels)

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))
        return pd.Series(np.round(model.score(x), 9))

    return (documents.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))
