"""Thresholds, intervals and record schemas.

The values in ``Thresholds`` are fixed values that must equal the
original detector's for identical flags: window 10 minutes sliding by
1 minute, 15 minute watermark, 2 minute grace after a window, rule 1
and 2 need more than 8 reviews, rule 1 average below 2.5, rule 2
sample deviation below 0.8 with average below 3.5, rule 3 needs at
least 5 reviews of which more than 80 % have 1 or 2 stars.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------
REASON_VELOCITY = "HIGH_VELOCITY_NEGATIVE"
REASON_UNIFORM = "COORDINATED_UNIFORM_RATING"
REASON_RATIO = "NEGATIVE_RATIO_SPIKE"
REASON_NONE = "NONE"
REASONS = (REASON_VELOCITY, REASON_UNIFORM, REASON_RATIO)

LABEL_QUARANTINED = "quarantined"
LABEL_ORGANIC = "organic"


@dataclass(frozen=True)
class Thresholds:
    window_minutes: int = 10
    slide_minutes: int = 1
    watermark_minutes: int = 15
    grace_minutes: int = 2
    review_count_threshold: int = 8      # rules 1, 2: review_count > this
    avg_stars_threshold: float = 2.5     # rule 1: avg_stars < this
    std_threshold: float = 0.8           # rule 2: std_stars < this
    coordinated_avg_threshold: float = 3.5  # rule 2: avg_stars < this
    neg_ratio_threshold: float = 0.80    # rule 3: neg share > this
    neg_count_min_reviews: int = 5       # rule 3: review_count >= this
    negative_max_stars: int = 2          # a review with stars <= this is negative

    @property
    def window(self) -> str:
        return f"{self.window_minutes} minutes"

    @property
    def slide(self) -> str:
        return f"{self.slide_minutes} minutes"

    @property
    def watermark(self) -> str:
        return f"{self.watermark_minutes} minutes"


DEFAULT = Thresholds()

# The names below are those of the original's records and tables.
# Wire format of one review (all nullable). The narrow fields are read as text and
# narrowed afterwards, so that ``5``, ``5.0`` and ``"5"`` all survive parsing and a
# field of another type is NULL instead of spoiling its record.
REVIEW_WIRE_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("useful", T.StringType()),
    T.StructField("funny", T.StringType()),
    T.StructField("cool", T.StringType()),
    T.StructField("is_injected", T.StringType()),
])

# Columns of a parsed review as the detector sees it.
REVIEW_COLUMNS = (
    "review_id", "user_id", "business_id", "stars", "text",
    "event_time", "ingestion_time", "is_injected", "sentiment_label",
)

ORGANIC_COLUMNS = (
    "review_id", "user_id", "business_id", "stars", "text",
    "sentiment_label", "event_time", "ingestion_time", "is_injected",
)

QUARANTINED_COLUMNS = (
    "review_id", "user_id", "business_id", "stars", "text",
    "sentiment_label", "anomaly_reason",
    "window_review_count", "window_avg_stars", "window_std_stars",
    "window_start", "window_end",
    "event_time", "ingestion_time", "is_injected",
)
