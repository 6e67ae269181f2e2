"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Base counts come from one vectorised pass over each whole text. Four ratios
of them are summarised by a logarithmic-bucket quantile sketch (DDSketch,
Masson et al. 2019) per (lang, source). Such a sketch is a table of bucket
counts, so it merges by addition: partial sums before the shuffle, and sums
over sources for the language and corpus level. Each group takes the finest
level with at least ``min_rows`` documents. The fences of a ratio follow from
the quartiles of its group, and from an upper quantile where most documents have
none of what the ratio counts and the quartiles are all zero. A joined filter applies them.

Defined results: a null text counts as empty (all counts 0, base_failed). Null
lang or source is a group of its own. Repeated rows are judged one by one,
alike. Columns beyond doc_id, text, lang, source are ignored by
``quality_rules`` and carried unchanged by ``filter_documents``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import SPACES, checkpointed, in_few_tasks

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MAX_GROUPS = 10_000
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, j, 1 << 64) for j in range(1, WINDOW + 1)], np.uint64)


@dataclass(frozen=True)
class Rules:
    """``gamma``: a sketched value lies within (gamma - 1) / (gamma + 1) of the
    true one. ``reach``: interquartile ranges between a quartile and its fence.
    ``min_rows``: documents below which a group borrows the next wider sketch."""

    gamma: float = 1.02
    reach: float = 3.0
    min_rows: int = 100
    min_words: int = 20
    repeat_percent: int = 30


#: ratio -> (numerator, denominator, fence below the quartiles?, tail, slack). The upper
#: fence is no lower than the group's ``tail`` quantile; ``slack``, a few points,
#: keeps a ratio that is nearly constant in a group from rejecting what is merely not equal.
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars", False, 0.75, 0.02),
    "dup_line_ratio": ("n_dup_lines", "n_lines", False, 0.99, 0.10),
    "repeat_ratio": ("n_repeat_words", "n_words", False, 0.99, 0.10),
    "word_length": ("word_chars", "n_words", True, 0.75, 0.50),
}


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dups += line in seen
            seen.add(line)
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dups,
            repeated_words(words), lines)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        h += ids[j:j + n] * _MULTIPLIERS[j]
    ordered = np.sort(h)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    repeated = np.isin(h, again)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(repeated), 1)
    np.add.at(edges, np.flatnonzero(repeated) + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([count_text(t) for t in texts], columns=list(COUNTS), dtype="int64")


_counts = _counts.asNondeterministic()  # else every use of a count would read the text again


def _failed(s: str, r: Rules) -> Column:
    return ((F.col(f"{s}.n_words") < r.min_words)
            | (100 * F.col(f"{s}.n_repeat_words") > r.repeat_percent * F.col(f"{s}.n_words")))


def _ratio(s: str, name: str) -> Column:
    num, den, *_ = RATIOS[name]
    return F.try_divide(F.col(f"{s}.{num}").cast("double"), F.col(f"{s}.{den}"))


def sketches(counted: DataFrame, r: Rules = Rules()) -> DataFrame:
    """(level, lang, source, ratio, bucket, n): the bucket counts of every
    group, language and of the corpus. Bucket null holds the zeros; bucket i
    the values in (gamma^(i-1), gamma^i]. Documents that fail the base rules
    are no part of what is usual and stay out."""
    log_gamma = math.log(r.gamma)
    long = (counted.filter(~_failed("c", r))
            .select("lang", "source", F.explode(F.array(*[
                F.struct(F.lit(k).alias("ratio"), _ratio("c", k).alias("x")) for k in RATIOS])).alias("v"))
            .select("lang", "source", "v.ratio",
                    F.when(F.col("v.x") > 0, F.ceil(F.log("v.x") / log_gamma)).cast("int").alias("bucket")))
    fine = long.groupBy("lang", "source", "ratio", "bucket").agg(F.count("*").alias("n"))
    lang = fine.groupBy("lang", "ratio", "bucket").agg(F.sum("n").alias("n"))
    every = lang.groupBy("ratio", "bucket").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    cols = ("level", "lang", "source", "ratio", "bucket", "n")
    return (fine.withColumn("level", F.lit(0)).select(*cols)
            .unionByName(lang.withColumn("level", F.lit(1)).withColumn("source", none).select(*cols))
            .unionByName(every.withColumn("level", F.lit(2)).withColumn("lang", none)
                         .withColumn("source", none).select(*cols)))


def fences(sketch: DataFrame, r: Rules = Rules()) -> DataFrame:
    """(level, lang, source, rows, <ratio>_lo, <ratio>_hi): the quartiles read
    off each merged sketch and the fences around them. A group has at most one
    row per bucket, however many documents it holds."""
    keys = ("level", "lang", "source", "ratio")
    w = Window.partitionBy(*keys)
    running = w.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(
        2 * F.pow(F.lit(r.gamma), F.col("bucket")) / (r.gamma + 1))
    cum = sketch.withColumns({"upto": F.sum("n").over(running), "rows": F.sum("n").over(w), "value": value})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("rows"), F.col("value")))
    tail = F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v[3])) for k, v in RATIOS.items()])
    q = cum.withColumn("tail", tail).groupBy(*keys).agg(
        F.max("rows").alias("rows"), at(0.25).alias("q1"), at(0.75).alias("q3"), at(F.col("tail")).alias("qt"))
    out = []
    for k, (_, _, below, _, slack) in RATIOS.items():
        here = F.col("ratio") == k
        spread = r.reach * (F.col("q3") - F.col("q1"))
        out.append(F.max(F.when(here, F.greatest(F.col("q3") + spread, F.col("qt")) + slack)).alias(f"{k}_hi"))
        if below:
            out.append(F.max(F.when(here, F.col("q1") - spread - slack)).alias(f"{k}_lo"))
    return q.groupBy("level", "lang", "source").agg(F.max("rows").alias("rows"), *out)


FENCES = tuple(f"{k}_hi" for k in RATIOS) + tuple(f"{k}_lo" for k, v in RATIOS.items() if v[2])


def thresholds(counted: DataFrame, r: Rules = Rules()) -> DataFrame:
    """One row per (lang, source) that occurs, with the fences of the finest
    level of at least ``min_rows`` documents (the corpus, if none has them)."""
    f = checkpointed(in_few_tasks(fences(sketches(counted, r), r)))
    groups = f.filter("level = 0").select("lang", "source", F.col("rows").alias("rows0"), *[F.col(c).alias(f"{c}0") for c in FENCES])
    lang = f.filter("level = 1").select(F.col("lang").alias("lang1"), F.col("rows").alias("rows1"), *[F.col(c).alias(f"{c}1") for c in FENCES])
    every = f.filter("level = 2").select(*FENCES).first()  # one row, or none in an empty table
    whole = dict(zip(FENCES, every or [None] * len(FENCES)))
    j = groups.join(F.broadcast(lang), F.col("lang").eqNullSafe(F.col("lang1")), "left")
    pick = lambda c: (F.when(F.col("rows0") >= r.min_rows, F.col(f"{c}0"))
                      .when(F.col("rows1") >= r.min_rows, F.col(f"{c}1")).otherwise(F.lit(whole[c]).cast("double")))
    return j.select("lang", "source", F.col("rows0").alias("rows"), *[pick(c).alias(c) for c in FENCES])


def _verdict(counted: DataFrame, limits: DataFrame, r: Rules) -> DataFrame:
    """``counted`` (struct c, lang, source, ...) with ``base_failed``, ``kept``.
    A group all of whose documents fail the base rules has no limits, and
    needs none."""
    t = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.struct(*FENCES).alias("_limits"), "rows")
    match = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    if limits.count() <= MAX_GROUPS:  # small enough to leave the texts where they are
        j = counted.join(F.broadcast(t), match, "left")
    else:  # the largest groups as before; only documents of the others, none of them hot, go to their limits
        large = F.broadcast(checkpointed(t.orderBy(F.desc("rows"), "_lang", "_source").limit(MAX_GROUPS)))
        rest = t.join(large.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s")),
                      F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left_anti")
        j = counted.join(large, match).unionByName(counted.join(large, match, "left_anti").join(rest, match, "left"))
    inside = F.lit(True)
    for k, (_, _, below, *_) in RATIOS.items():
        inside = inside & (_ratio("c", k) <= F.col(f"_limits.{k}_hi"))
        if below:
            inside = inside & (_ratio("c", k) >= F.col(f"_limits.{k}_lo"))
    return (j.withColumn("_failed", _failed("c", r))
            .withColumn("_kept", ~F.col("_failed") & F.coalesce(inside, F.lit(True))))


def quality_rules(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per row: doc_id, the counts, the ratios, base_failed and kept."""
    counted = checkpointed(documents.select("doc_id", "lang", "source", _counts("text").alias("c")))
    v = _verdict(counted, checkpointed(thresholds(counted, rules)), rules)
    return v.select("doc_id", "lang", "source", *[F.col(f"c.{c}") for c in COUNTS],
                    F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def filter_documents(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``documents`` that the rules keep, with their columns. The
    counts are made twice rather than shuffling the texts to them."""
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    counted = held.select("_row", F.col("_row.lang").alias("lang"), F.col("_row.source").alias("source"),
                          _counts("_row.text").alias("c"))
    limits = checkpointed(thresholds(counted.select("lang", "source", "c"), rules))
    return _verdict(counted, limits, rules).filter("_kept").select("_row.*")
