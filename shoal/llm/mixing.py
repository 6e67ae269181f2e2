"""Temperature mixing of sources, realised as budgeted block permutations.

A source of token share p gets the weight p**a / sum(p**a). The exponent a in
[0, 1] (0: all sources alike, 1: as they are) is searched for the value nearest
1 that meets a least entropy, or the least that keeps to a most number of
passes over a source. A search round evaluates the ends of ``_SECTIONS`` sections
in one pass of at most ``_PARTS`` tasks over the source table; each sends its sums.

With weight w and budget B a source of T tokens is passed B * w / T times: every
whole pass gives each of its documents once, in a new order of blocks; the last,
partial pass gives a prefix of its permutation. A permutation is the order of
a keyed 64-bit hash of the row, blocks are ranges of it. The end of the prefix is
therefore one hash value per source: block totals locate the block, and the
documents of that block alone are summed up in order. No row is joined with
another one and no window holds a source.

Defined results: a null text has no tokens; a null source is a source. A source
without tokens has weight 0 and is passed once. Equal rows (same doc_id, text)
share their hash and stay or go together. Other columns are ignored
(``mix_plan``) or carried unchanged (``mix_documents``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import WORD, checkpointed, in_few_tasks

SEED = 7
REPEATS = 2.0
BLOCK_ROWS = 1024
MAX_SOURCES = 100_000  # rows of a few dozen bytes that are broadcast; beyond, adaptive execution splits a hot source
_SECTIONS = 256
_ROUNDS = 4
_PARTS = 16


def tokens(text: Column) -> Column:
    """Words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(SEED), doc_id, text)


def source_tokens(rows: DataFrame) -> DataFrame:
    """(source, tokens, rows) of rows (source, tokens)."""
    return rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))


def _powers(total: float, at: np.ndarray):
    """Sums over sources of share p: of p**a and p**a ln p, and the bounds of p**a / p, for each a of ``at``."""
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, l, most, least = np.zeros(len(at)), np.zeros(len(at)), np.zeros(len(at)), np.full(len(at), np.inf)
        for b in batches:
            log_p = np.log(b["tokens"].to_numpy(float) / total)
            for i in range(0, len(log_p), 1024):
                part = log_p[i:i + 1024]
                x = np.exp(np.outer(part, at))
                z, l = z + x.sum(axis=0), l + part @ x  # noqa: E741
                x /= np.exp(part)[:, None]
                most, least = np.maximum(most, x.max(axis=0)), np.minimum(least, x.min(axis=0))
        yield pd.DataFrame({"i": np.arange(len(at)), "z": z, "l": l, "most": most, "least": least})

    return over


def find_exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = None,
                  budget: int | None = None) -> float:
    """The exponent for ``entropy`` (a share of the most there can be, the log
    of the number of sources) or else for ``repeats`` (passes over any source
    when ``budget`` tokens are drawn, or the least budget that passes each once)."""
    if (entropy is None) == (repeats is None):
        raise ValueError("give one of entropy and repeats")
    some = sources.filter("tokens > 0")
    total, n = some.agg(F.sum("tokens"), F.count("*")).first()
    if not n or n == 1:
        return 1.0
    some = some.select("tokens").coalesce(_PARTS)
    lo, hi = 0.0, 1.0
    for _ in range(_ROUNDS):
        at = [lo + (hi - lo) * i / _SECTIONS for i in range(_SECTIONS + 1)]
        rows = some.mapInPandas(_powers(float(total), np.array(at)), "i int, z double, l double, most double, least double").collect()
        parts = np.array(rows, float).reshape(-1, len(at), 5)  # _PARTS at most
        r = zip(parts[:, :, 1].sum(axis=0).tolist(), parts[:, :, 2].sum(axis=0).tolist(),
                parts[:, :, 3].max(axis=0).tolist(), parts[:, :, 4].min(axis=0).tolist())
        ok = []
        for a, (z, l, most, least) in zip(at, r):  # noqa: E741
            if entropy is not None:
                ok.append((a, math.log(z) - a * l / z >= entropy * math.log(n)))
            else:
                ok.append((a, (most / least if budget is None else most * budget / total / z) <= repeats))
        # entropy falls with the exponent, and so do the passes over small sources
        good = [a for a, x in ok if x]
        if not good:
            return 0.0 if entropy is not None else 1.0
        if entropy is not None:
            lo = max(good)
            hi = min([a for a in at if a > lo], default=lo)
        else:
            hi = min(good)
            lo = max([a for a in at if a < hi], default=hi)
        if lo == hi:
            break
    return round(lo if entropy is not None else hi, 9)


def source_passes(sources: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """(source, weight, whole, rest): whole passes, and the tokens that the
    partial one should give. Without a budget each source is passed at least once."""
    total, = sources.agg(F.sum("tokens")).first()
    p = F.col("tokens") / F.lit(float(total or 1))
    power = F.when(F.col("tokens") > 0, F.pow(p, F.lit(exponent))).otherwise(0.0)
    z, least = sources.agg(F.sum(power), F.min(F.when(F.col("tokens") > 0, power / F.col("tokens")))).first()
    drawn = (float(budget) if budget is not None else z / least) if z else 0.0
    out = sources.withColumn("weight", power / F.lit(z or 1.0))
    passes = F.when(F.col("tokens") > 0, F.round(F.lit(drawn) * F.col("weight") / F.col("tokens"), 9)).otherwise(1.0)
    return (out.withColumn("passes", passes).withColumn("whole", F.floor("passes").cast("int"))
            .withColumn("rest", ((F.col("passes") - F.col("whole")) * F.col("tokens")).cast("long"))
            .select("source", "weight", "whole", "rest"))


def _order(h: Column, epoch: Column) -> Column:
    return F.xxhash64(h, epoch)


def _block(order: Column, bits: int) -> Column:
    return F.shiftrightunsigned(order, 64 - bits).cast("int") if bits else F.lit(0)


def _prefix_ends(rows: DataFrame, passes: DataFrame, bits: int) -> DataFrame:
    """(source, weight, whole, cut_block, cut): the partial pass gives the
    documents of the blocks before cut_block, and of cut_block those up to the
    order value cut (null: none)."""
    small = passes.select(F.col("source").alias("_s"), "weight", "whole", "rest")
    r = (rows.join(small.filter("rest > 0").select("_s", "whole", "rest"), F.col("source").eqNullSafe(F.col("_s")))
         .withColumn("order", _order(F.col("h"), F.col("whole"))).withColumn("block", _block(F.col("order"), bits)))
    # sums run over groups of blocks first, so that a window holds 2**(bits / 2) rows
    half = bits // 2
    blocks = checkpointed(in_few_tasks(r.groupBy("_s", "rest", "block").agg(F.sum("tokens").alias("t"))))  # read twice
    blocks = blocks.withColumn("super", F.shiftright("block", half))
    before = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    supers = (blocks.groupBy("_s", "super").agg(F.sum("t").alias("t"))
              .select(F.col("_s").alias("_s2"), F.col("super").alias("_super"),
                      F.coalesce(F.sum("t").over(before(["_s"], "super")), F.lit(0)).alias("before_super")))
    cum = (blocks.join(supers, F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("super") == F.col("_super")))
           .withColumn("before", F.col("before_super") + F.coalesce(F.sum("t").over(before(["_s", "super"], "block")), F.lit(0))))
    cuts = cum.filter("before < rest and before + t >= rest").select(
        F.col("_s").alias("_cs"), F.col("block").alias("cut_block"), F.col("before").alias("cut_before"))
    inner = (r.join(cuts, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("block") == F.col("cut_block")))
             .groupBy("_cs", "cut_block", "cut_before", "rest", "order").agg(F.sum("tokens").alias("t")))
    upto = F.col("cut_before") + F.sum("t").over(Window.partitionBy("_cs").orderBy("order").rowsBetween(Window.unboundedPreceding, 0))
    # a document is in if its middle is within the budget
    ends = (inner.withColumn("in", 2 * upto - F.col("t") <= 2 * F.col("rest")).groupBy("_cs", "cut_block")
            .agg(F.max(F.when(F.col("in"), F.col("order"))).alias("cut")))
    return (small.join(ends, F.col("_s").eqNullSafe(F.col("_cs")), "left")
            .select("_s", "weight", "whole", "cut_block", "cut"))


def _plan(documents: DataFrame, entropy: float | None, repeats: float | None, budget: int | None):
    rows = checkpointed(documents.select("source", tokens(F.col("text")).alias("tokens"),
                                         _hash(F.col("doc_id"), F.col("text")).alias("h")))
    sources = checkpointed(source_tokens(rows).coalesce(_PARTS))  # short rows; the search reads them again and again
    n = sources.agg(F.sum("rows")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, n / BLOCK_ROWS))))
    exponent = find_exponent(sources, entropy, repeats, budget)
    ends = _prefix_ends(rows, source_passes(sources, exponent, budget), bits)
    return checkpointed(in_few_tasks(ends)), exponent, bits


def _copies(rows: DataFrame, ends: DataFrame, bits: int) -> DataFrame:
    """``rows`` (source, h, ...) once per copy, with weight, epoch and block."""
    last = _order(F.col("h"), F.col("whole"))
    block = _block(last, bits)
    partial = F.coalesce((block < F.col("cut_block")) | ((block == F.col("cut_block")) & (last <= F.col("cut"))), F.lit(False))
    copies = F.col("whole") + partial.cast("int")
    if ends.count() <= MAX_SOURCES:  # else a hot source would be one key of a shuffle of texts
        ends = F.broadcast(ends)
    return (rows.join(ends, F.col("source").eqNullSafe(F.col("_s"))).filter(copies > 0)
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), copies - 1)))
            .withColumn("block", _block(_order(F.col("h"), F.col("epoch")), bits)))


def mix_plan(documents: DataFrame, entropy: float | None = None, repeats: float | None = REPEATS,
             budget: int | None = None) -> DataFrame:
    """One row per drawn copy: doc_id, source, tokens, the source's weight, the
    exponent, epoch and block. Epochs in order, and in each the blocks in order,
    are the drawn sequence of a source."""
    ends, exponent, bits = _plan(documents, entropy, repeats, budget)
    rows = documents.select("doc_id", "source", tokens(F.col("text")).alias("tokens"),
                            _hash(F.col("doc_id"), F.col("text")).alias("h"))
    return _copies(rows, ends, bits).select("doc_id", "source", "tokens", "weight", F.lit(exponent).alias("exponent"), "epoch", "block")


def mix_documents(documents: DataFrame, entropy: float | None = None, repeats: float | None = REPEATS,
                  budget: int | None = None) -> DataFrame:
    """The rows of ``documents``, each as often as it is drawn."""
    ends, _, bits = _plan(documents, entropy, repeats, budget)
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    rows = held.select("_row", F.col("_row.source").alias("source"), _hash(F.col("_row.doc_id"), F.col("_row.text")).alias("h"))
    return _copies(rows, ends, bits).select("_row.*")
