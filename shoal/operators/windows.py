"""Sliding-window statistics per business and the flagged-window table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.config import DEFAULT, Thresholds
from shoal.functions.rules import anomaly_reason, is_anomaly
from shoal.functions.timecols import MICROS_PER_MINUTE, floor_to
from shoal.functions.stats import mean_from_moments, sample_std_from_moments

WINDOW_STAT_COLUMNS = ("business_id", "window_start", "window_end", "review_count",
                       "avg_stars", "std_stars", "neg_count")


def _moment_aggs(thr: Thresholds):
    stars = F.col("stars").cast("bigint")
    return [
        F.count(F.lit(1)).alias("review_count"),          # rows with NULL stars count here
        F.count(stars).alias("star_n"),
        F.sum(stars).alias("star_sum"),
        F.sum(stars * stars).alias("star_sq_sum"),
        F.count_if(F.col("stars") <= F.lit(thr.negative_max_stars)).alias("neg_count"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    n, s, ss = F.col("star_n"), F.col("star_sum"), F.col("star_sq_sum")
    return df.select(
        "business_id", "window_start", "window_end", "review_count",
        mean_from_moments(n, s).alias("avg_stars"),
        sample_std_from_moments(n, s, ss).alias("std_stars"),
        "neg_count")


def window_stats(reviews: DataFrame, thr: Thresholds = DEFAULT,
                 time_col: str = "event_time") -> DataFrame:
    """Per business and sliding window (``thr.window`` every ``thr.slide``):
    ``review_count`` (all rows), ``avg_stars`` and sample ``std_stars`` over
    non-NULL stars, ``neg_count`` (stars <= 2).

    Plan: the rows of each (business, slide bucket) are combined first,
    map-side and then in one shuffle; only these sums are copied to the windows
    they belong to and added up. However many reviews an attack packs into a
    minute, the copies stay one per business-minute and window. Exact, because the
    moments are integers. The slide must divide the window; streams, whose state
    needs ``window()``, use :func:`window_stats_hopping`.
    """
    if thr.window_minutes % thr.slide_minutes:
        raise ValueError("window length must be a multiple of the slide")
    base = reviews.where(F.col("business_id").isNotNull() & F.col(time_col).isNotNull())
    per_bucket = (base.groupBy("business_id", floor_to(F.col(time_col), thr.slide_minutes).alias("bucket"))
                  .agg(*_moment_aggs(thr)))
    k = thr.window_minutes // thr.slide_minutes
    step = thr.slide_minutes * MICROS_PER_MINUTE
    shifted = per_bucket.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_k"))
    start = F.timestamp_micros(F.unix_micros("bucket") - F.col("_k") * F.lit(step))
    agg = (shifted.groupBy("business_id", start.alias("window_start"))
           .agg(F.sum("review_count").alias("review_count"), F.sum("star_n").alias("star_n"),
                F.sum("star_sum").alias("star_sum"), F.sum("star_sq_sum").alias("star_sq_sum"),
                F.sum("neg_count").alias("neg_count"))
           .withColumn("window_end", F.timestamp_micros(
               F.unix_micros("window_start") + F.lit(thr.window_minutes * MICROS_PER_MINUTE))))
    return _finish(agg)


def window_stats_hopping(reviews: DataFrame, thr: Thresholds = DEFAULT,
                         time_col: str = "event_time") -> DataFrame:
    """The same rows by Spark's ``window()``: each row is copied to its windows
    and aggregated there. Any slide; works on a stream."""
    base = reviews.where(F.col("business_id").isNotNull() & F.col(time_col).isNotNull())
    agg = (base.groupBy("business_id", F.window(time_col, thr.window, thr.slide).alias("window"))
           .agg(*_moment_aggs(thr))
           .select("business_id", F.col("window.start").alias("window_start"),
                   F.col("window.end").alias("window_end"), "review_count",
                   "star_n", "star_sum", "star_sq_sum", "neg_count"))
    return _finish(agg)


def classify_windows(stats: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """Add ``anomaly_reason`` (first matching rule or ``NONE``) and ``is_anomaly``."""
    return (stats.withColumn("anomaly_reason", anomaly_reason(thr))
            .withColumn("is_anomaly", is_anomaly()))


FLAGGED_COLUMNS = ("business_id", "window_start", "window_end", "window_review_count",
                   "window_avg_stars", "window_std_stars", "anomaly_reason")


def flag_windows(stats: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """Anomalous windows only, flattened and renamed for the label join."""
    return (classify_windows(stats, thr).where(F.col("is_anomaly"))
            .select("business_id", "window_start", "window_end",
                    F.col("review_count").alias("window_review_count"),
                    F.col("avg_stars").alias("window_avg_stars"),
                    F.col("std_stars").alias("window_std_stars"),
                    "anomaly_reason"))
