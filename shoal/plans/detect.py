"""End-to-end batch detection: reviews -> windows -> flags -> labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.config import DEFAULT, Thresholds
from shoal.operators.label import label_reviews, organic, quarantined
from shoal.operators.windows import flag_windows, window_stats


@dataclass
class Detection:
    stats: DataFrame
    flagged: DataFrame
    labelled: DataFrame

    @property
    def organic(self) -> DataFrame:
        return organic(self.labelled)

    @property
    def quarantined(self) -> DataFrame:
        return quarantined(self.labelled)


def detect(reviews: DataFrame, thr: Thresholds = DEFAULT, time_col: str = "event_time",
           dedupe: bool = True) -> Detection:
    """Lazy plan; nothing runs until an action on one of the outputs. Rows without
    a ``review_id`` are rejects and count nowhere."""
    known = reviews.where(F.col("review_id").isNotNull())
    stats = window_stats(known.select("business_id", time_col, "stars"), thr, time_col)
    flagged = flag_windows(stats, thr)
    labelled = label_reviews(known, flagged, thr, time_col, dedupe)
    return Detection(stats, flagged, labelled)
