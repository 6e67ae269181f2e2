"""The three attack rules as one first-match CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoal.config import (DEFAULT, REASON_NONE, REASON_RATIO, REASON_UNIFORM,
                          REASON_VELOCITY, Thresholds)


def anomaly_reason(thr: Thresholds = DEFAULT, review_count: str = "review_count",
                   avg_stars: str = "avg_stars", std_stars: str = "std_stars",
                   neg_count: str = "neg_count") -> Column:
    """First matching rule wins; a NULL comparison falls through to the next rule."""
    n, avg, std, neg = F.col(review_count), F.col(avg_stars), F.col(std_stars), F.col(neg_count)
    busy = n > F.lit(thr.review_count_threshold)
    neg_share = F.try_divide(neg.cast("double"), n)
    return (F.when(busy & (avg < F.lit(thr.avg_stars_threshold)), F.lit(REASON_VELOCITY))
            .when(busy & (std < F.lit(thr.std_threshold))
                  & (avg < F.lit(thr.coordinated_avg_threshold)), F.lit(REASON_UNIFORM))
            .when((n >= F.lit(thr.neg_count_min_reviews))
                  & (neg_share > F.lit(thr.neg_ratio_threshold)), F.lit(REASON_RATIO))
            .otherwise(F.lit(REASON_NONE)))


def is_anomaly(reason: str = "anomaly_reason") -> Column:
    return F.col(reason) != F.lit(REASON_NONE)
