"""Label each review organic or quarantined by the flagged windows around it.

A review at time ``t`` of business ``b`` is quarantined when a flagged window
of ``b`` has ``window_start <= t <= window_end + grace`` (closed upper bound);
the earliest such window supplies the window attributes.

Plan. A range join on business alone is quadratic in a hot business. Instead
each flagged window is expanded to the slide buckets (minutes) it can cover,
and those are reduced to at most one row per (business, bucket): the earliest
window that covers the whole bucket (``inner_w``) and the one window that only
reaches the bucket's first instants (``edge_w``, start = bucket - floor(window
+ grace)). Reviews then join that table on the equality (business, bucket):
at most one match per review, no fan-out, no post-join dedupe for the window
choice. The bucket table is small relative to reviews; AQE broadcasts it
when its measured size is under the threshold, else it is a sort-merge join
in which a hot business spreads over its minutes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.config import (DEFAULT, LABEL_ORGANIC, LABEL_QUARANTINED, ORGANIC_COLUMNS,
                          QUARANTINED_COLUMNS, Thresholds)
from shoal.functions.timecols import MICROS_PER_MINUTE, add_minutes, floor_to

WINDOW_ATTRS = ("window_start", "window_end", "window_review_count", "window_avg_stars",
                "window_std_stars", "anomaly_reason")


def coverage_buckets(flagged: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """(business_id, _bucket) -> inner_w, edge_w (structs of the window attributes)."""
    reach = thr.window_minutes + thr.grace_minutes
    k_edge = reach // thr.slide_minutes          # buckets 0..k_edge-1 are inner, k_edge is the edge
    step = thr.slide_minutes * MICROS_PER_MINUTE
    w = F.struct(*[F.col(c) for c in WINDOW_ATTRS])
    ex = flagged.select("business_id", w.alias("w"),
                        F.explode(F.sequence(F.lit(0), F.lit(k_edge))).alias("_k"))
    bucket = F.timestamp_micros(F.unix_micros(F.col("w.window_start")) + F.col("_k") * F.lit(step))
    return (ex.groupBy("business_id", bucket.alias("_bucket"))
            .agg(F.min(F.when(F.col("_k") < k_edge, F.col("w"))).alias("inner_w"),
                 F.min(F.when(F.col("_k") == k_edge, F.col("w"))).alias("edge_w")))


def label_reviews(reviews: DataFrame, flagged: DataFrame, thr: Thresholds = DEFAULT,
                  time_col: str = "event_time", dedupe: bool = True) -> DataFrame:
    """All review columns plus ``label`` and the window attributes (NULL when organic).

    ``dedupe`` keeps one row per ``review_id``: that of the earliest flagged
    window (organic only if no row of the id lies near one), then of the earliest
    event, then of the smallest remaining values. Rows without an id cannot be told
    apart and are no output; :func:`missing_ids` gives them for the reject table.
    """
    cols = reviews.columns
    buckets = coverage_buckets(flagged, thr)
    r = reviews.withColumn("_bucket", floor_to(F.col(time_col), thr.slide_minutes))
    j = r.join(buckets, ["business_id", "_bucket"], "left")
    edge_ok = (F.col("edge_w").isNotNull()
               & (F.col(time_col) <= add_minutes(F.col("edge_w.window_end"), thr.grace_minutes)))
    j = j.withColumn("_w", F.when(edge_ok, F.col("edge_w")).otherwise(F.col("inner_w")))
    out = j.select(*cols,
                   F.when(F.col("_w").isNotNull(), F.lit(LABEL_QUARANTINED))
                   .otherwise(F.lit(LABEL_ORGANIC)).alias("label"),
                   *[F.col(f"_w.{c}").alias(c) for c in WINDOW_ATTRS])
    if dedupe:
        out = dedupe_by_id(out.where(F.col("review_id").isNotNull()), "review_id", first=("window_start", time_col))
    return out


def missing_ids(reviews: DataFrame) -> DataFrame:
    """The rows that :func:`label_reviews` leaves out for want of an id, with a
    ``status``; a reject sink stores and counts them."""
    return reviews.where(F.col("review_id").isNull()).withColumn("status", F.lit("missing_review_id"))


def dedupe_by_id(df: DataFrame, id_col: str, first: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``id_col``: the row with the smallest ``first`` columns (NULLs
    last), ties broken by all other columns (deterministic, unlike
    ``dropDuplicates``). Partial aggregation collapses a hot id map-side;
    the struct buffer makes it a sort-based aggregate, which spills. Keep the rows
    narrow: wide columns are joined to the result."""
    rest = [c for c in df.columns if c != id_col and c not in first]
    nulls = [F.col(c).isNull().alias(f"_null_{c}") for c in first]
    order = list(first) + rest
    ranked = F.struct(*[x for c, n in zip(first, nulls) for x in (n, F.col(c))], *rest)
    picked = (df.groupBy(id_col).agg(F.min(ranked).alias("_r"))
              .select(id_col, *[F.col(f"_r.{c}").alias(c) for c in order]))
    return picked.select(*df.columns)


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def organic(labelled: DataFrame) -> DataFrame:
    """Organic output columns (``text`` only when the input carried it)."""
    return labelled.where(F.col("label") == LABEL_ORGANIC).select(*_present(labelled, ORGANIC_COLUMNS))


def quarantined(labelled: DataFrame) -> DataFrame:
    return (labelled.where(F.col("label") == LABEL_QUARANTINED)
            .select(*_present(labelled, QUARANTINED_COLUMNS)))
