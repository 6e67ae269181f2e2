"""Why were reviews flagged: per-term contributions of a linear text model,
ranked per business and per review, plus behaviour patterns and reports.

For a linear model with an all-zero background, a term's attribution is
``coef[term] * weight[text, term]``. It depends on the text alone, so everything
up to the ranked terms is computed once per distinct text (column ``text_id``) and
joined to the reviews that carry it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.functions.numeric import ratio, round_half
from shoal.functions.stats import mean_from_moments, pop_std_from_moments
from shoal.operators.text_model import TermLists

TOP_SIGNALS = 15
PIECE = 20_000  # texts of a business that one task adds up
TOP_REVIEW_FEATURES = 5
PREVIEW_CHARS = 100


def contributions(tfidf: DataFrame | TermLists, coefs: DataFrame) -> DataFrame | TermLists:
    """tfidf rows + ``coef`` and ``contribution`` = coef * weight. The sides are
    left to Spark: a coefficient table is as long as its vocabulary. Lists of a bounded
    vocabulary stay lists, with the coefficients beside them."""
    if not isinstance(tfidf, TermLists):
        return (tfidf.join(coefs.select("term", "coef"), "term")
                .withColumn("contribution", F.col("coef") * F.col("weight")))
    number = {t: i for i, t in enumerate(tfidf.terms)}
    coef = np.full(len(number), np.nan)  # terms without a coefficient are left out, as by the join
    for r in coefs.select("term", "coef").collect():  # bounded by the vocabulary
        if r["term"] in number and r["coef"] is not None:
            coef[number[r["term"]]] = r["coef"]
    return TermLists(tfidf.rows, tfidf.terms, tfidf.idf, coef)


def text_scores(contrib: DataFrame | TermLists, key: str = "text_id") -> DataFrame:
    """(key, n_terms, score): number of scored terms of each text that has one, and their sum."""
    if not isinstance(contrib, TermLists):
        return contrib.groupBy(key).agg(F.count(F.lit(1)).alias("n_terms"), F.sum("contribution").alias("score"))

    def made(keys, n, found):
        row, _, _, value = found
        return [*keys, pa.array(np.bincount(row, minlength=n)), pa.array(np.bincount(row, value, n))]

    fields = [T.StructField("n_terms", T.LongType()), T.StructField("score", T.DoubleType())]
    return contrib.mapped(made, [*contrib.keys(), *fields]).where(F.col("n_terms") > 0).select(key, "n_terms", "score")


def review_scores(contrib: DataFrame | TermLists, reviews: DataFrame, key: str = "text_id", id_col: str = "review_id",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Per review: number of scored terms and the summed contribution (the
    model's margin without intercept); 0 and 0.0 for a review without any."""
    return (reviews.select(id_col, key, *keep).join(text_scores(contrib, key), key, "left")
            .select(id_col, *keep, F.coalesce("n_terms", F.lit(0).cast("bigint")).alias("n_terms"),
                    round_half(F.coalesce("score", F.lit(0.0)), 6).alias("score")))


def top_attack_signals(contrib: DataFrame | TermLists, flagged: DataFrame, k: int = TOP_SIGNALS,
                       key: str = "text_id", piece: int = PIECE) -> DataFrame:
    """Per business, the ``k`` terms with the largest mean |contribution| over
    all its flagged reviews (reviews without terms count as zero). Reviews of a
    business that share a text are counted before the terms are joined."""
    n = flagged.groupBy("business_id").agg(F.count(F.lit(1)).alias("_n"))
    uses = flagged.groupBy("business_id", key).agg(F.count(F.lit(1)).alias("_uses"))
    if isinstance(contrib, TermLists):
        per = _summed(contrib, uses, k, key, piece)
    else:
        per = (uses.join(contrib.select(key, "term", "contribution"), key)
               .select("business_id", "term", (F.col("_uses") * F.abs("contribution")).alias("_s")))
    s = per.groupBy("business_id", "term").agg(F.sum("_s").alias("_s"))
    imp = s.join(n, "business_id").withColumn("_imp", F.col("_s") / F.col("_n"))
    w = Window.partitionBy("business_id").orderBy(F.desc("_imp"), "term")   # <= vocabulary rows
    return (imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("business_id", "rank", F.col("term").alias("feature"),
                    round_half(F.col("_imp"), 4).alias("importance")))


def _places(terms: list[str]) -> np.ndarray:
    """The place of each term in the order of the terms."""
    place = np.empty(len(terms), np.int64)
    place[sorted(range(len(terms)), key=terms.__getitem__)] = np.arange(len(terms))
    return place


def _summed(contrib: TermLists, uses: DataFrame, k: int, key: str, piece: int) -> DataFrame:
    """(business_id, term, _s): sums of uses * |contribution| for every term that may be among
    the first ``k`` of its business. The texts' lists are dealt by business and added up in one array of
    the vocabulary's length; a row per business and term is made only of the first terms. A
    business of more than ``piece`` texts is dealt in pieces, which give all their sums."""
    size, values = len(contrib.terms), contrib.values()
    terms = pa.array(contrib.terms, pa.string())
    known = uses.where(F.col("business_id").isNotNull() & F.col(key).isNotNull())
    many = known.groupBy("business_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(piece)).cast("int").alias("_pieces"))
    dealt = known.join(many, "business_id").withColumn("_piece", F.pmod(F.xxhash64(key), F.col("_pieces")).cast("int"))
    rows = (dealt.join(contrib.rows.where(F.size("idx") > 0), key)
            .select("business_id", "_piece", "_pieces", "_uses", "idx", "tf", "norm")
            .repartition("business_id", "_piece").sortWithinPartitions("business_id", "_piece"))

    def first(total: np.ndarray, here: np.ndarray, pieces: int) -> np.ndarray:
        at = np.flatnonzero(here)
        if pieces > 1 or len(at) <= k:
            return at
        least = np.partition(total[at], -k)[-k]
        # the mean may tie where sums differ in their last digits
        return at[total[at] >= least * (1 - 1e-12)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces = None, 0
        total, here = np.zeros(size), np.zeros(size, bool)

        def done(out: list) -> None:
            at = first(total, here, pieces)
            out.append((now[0], at, total[at]))

        def batch(out: list) -> pa.RecordBatch:
            at = np.concatenate([a for _, a, _ in out])
            names = pa.array([b for b, _, _ in out], schema.field("business_id").type)
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array(np.repeat(np.arange(len(out)), [len(a) for _, a, _ in out]))), terms.take(pa.array(at)),
                 pa.array(np.concatenate([s for _, _, s in out]))], names=["business_id", "term", "_s"])

        for b in batches:
            schema = b.schema
            out: list = []
            business, part, of, n = b.columns[:4]
            row, idx, _, value = values(*b.columns[4:])
            group = np.stack([business.dictionary_encode().indices.to_numpy(), part.to_numpy()])
            cuts = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
            use = n.to_numpy()[row] * np.abs(value)
            for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
                one = (business[lo].as_py(), part[lo].as_py())
                if one != now:
                    if now is not None:
                        done(out)
                    now, pieces = one, of[lo].as_py()
                    total, here = np.zeros(size), np.zeros(size, bool)
                start, end = np.searchsorted(row, [lo, hi])
                total += np.bincount(idx[start:end], use[start:end], size)
                here[idx[start:end]] = True
            if out:
                yield batch(out)
        if now is not None:
            out = []
            done(out)
            yield batch(out)

    types = [uses.schema["business_id"], T.StructField("term", T.StringType()), T.StructField("_s", T.DoubleType())]
    return rows.mapInArrow(add, T.StructType(types))


def text_top_features(contrib: DataFrame | TermLists, k: int = TOP_REVIEW_FEATURES, key: str = "text_id") -> DataFrame:
    """Per text, its ``k`` present terms with the largest |contribution| (ties by
    term), long form. Lists are ranked inside their row."""
    if isinstance(contrib, TermLists):
        ranked = _ranked(contrib, k, key)
    else:
        w = Window.partitionBy(key).orderBy(F.desc(F.abs("contribution")), "term")
        ranked = contrib.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(key, "rank", F.col("term").alias("feature"), round_half(F.col("contribution"), 4).alias("shap_value"))


def _ranked(contrib: TermLists, k: int, key: str) -> DataFrame:
    terms, place = pa.array(contrib.terms, pa.string()), _places(contrib.terms)

    def made(keys, n, found):
        row, idx, _, c = found
        order = np.lexsort((place[idx], -np.abs(c), row))
        row, idx, c = row[order], idx[order], c[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < k
        row, idx = pa.array(row[top]), pa.array(idx[top])
        return [*[x.take(row) for x in keys], pa.array(rank[top] + 1, pa.int32()), terms.take(idx), pa.array(c[top])]

    fields = [T.StructField("rank", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("contribution", T.DoubleType())]
    return contrib.mapped(made, [*contrib.keys(), *fields])


def previews(texts: DataFrame, key: str = "text_id") -> DataFrame:
    """(key, text_preview): the first 100 characters of each text."""
    return texts.select(key, F.substring("text", 1, PREVIEW_CHARS).alias("text_preview"))


def review_top_features(top: DataFrame, reviews: DataFrame, preview: DataFrame, key: str = "text_id",
                        id_col: str = "review_id") -> DataFrame:
    """Per review its top terms, long form, with stars and preview; a review
    without a scored term has one row of rank 0."""
    return (reviews.select(id_col, "business_id", "stars", key).join(preview, key, "left").join(top, key, "left")
            .select(id_col, "business_id", "stars", "text_preview", F.coalesce("rank", F.lit(0)).alias("rank"), "feature", "shap_value"))


def behaviour_patterns(flagged: DataFrame) -> DataFrame:
    """Per business: flagged reviews, distinct users and their share, mean and
    population deviation of stars (round 2) and of ``text_length`` (round 1; NULL
    counts as 0). Only the length of a text is needed, not the text."""
    st = F.col("stars").cast("bigint")
    ln = F.coalesce(F.col("text_length"), F.lit(0)).cast("bigint")
    a = flagged.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("num_flagged_reviews"),
        F.countDistinct(F.coalesce(F.col("user_id"), F.lit(""))).alias("unique_users"),
        F.count(st).alias("_sn"), F.sum(st).alias("_ss"), F.sum(st * st).alias("_sq"),
        F.count(F.lit(1)).alias("_ln"), F.sum(ln).alias("_ls"), F.sum(ln * ln).alias("_lq"))
    return a.select(
        "business_id", "num_flagged_reviews", "unique_users",
        round_half(ratio(F.col("unique_users"), F.greatest(F.col("num_flagged_reviews"), F.lit(1))), 3)
        .alias("distinct_user_ratio"),
        round_half(mean_from_moments(F.col("_sn"), F.col("_ss")), 2).alias("avg_stars"),
        round_half(pop_std_from_moments(F.col("_sn"), F.col("_ss"), F.col("_sq")), 2).alias("std_stars"),
        round_half(mean_from_moments(F.col("_ln"), F.col("_ls")), 1).alias("avg_text_length"),
        round_half(pop_std_from_moments(F.col("_ln"), F.col("_ls"), F.col("_lq")), 1).alias("std_text_length"))


def report_index(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.countDistinct("business_id").alias("total_businesses"),
                       F.count(F.lit(1)).alias("total_quarantined_reviews"))


def build_reports(signals: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row per business: bounded parts only (<= 15 signals and the
    pattern struct). Per-review explanations stay one row per review
    (:func:`review_explanations`), so no business becomes one huge row."""
    sig = (signals.groupBy("business_id")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "feature", "importance"))).alias("_s"))
           .select("business_id", F.transform("_s", lambda x: F.struct(
               x["feature"].alias("feature"), x["importance"].alias("importance"))).alias("top_attack_signals")))
    pat = patterns.select("business_id", "num_flagged_reviews", F.struct(
        "unique_users", "distinct_user_ratio", "avg_stars", "std_stars",
        "avg_text_length", "std_text_length").alias("aggregate_patterns"))
    return (pat.join(sig, "business_id", "left")
            .withColumn("alert_timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")))


def review_explanations(top: DataFrame, reviews: DataFrame, preview: DataFrame, key: str = "text_id",
                        id_col: str = "review_id") -> DataFrame:
    """One row per review with its ordered top features (<= 5 entries; empty if
    no term of the text is scored)."""
    lists = top.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", "feature", "shap_value"))).alias("_f"))
    features = F.transform(F.coalesce("_f", F.array()), lambda x: F.struct(x["feature"].alias("feature"), x["shap_value"].alias("shap_value")))
    return (reviews.select(id_col, "business_id", "stars", key).join(preview, key, "left").join(lists, key, "left")
            .select(id_col, "business_id", "stars", "text_preview", features.alias("top_features")))
