"""Labels from any table of intervals: windows off the minute grid, incidents, sessions.

A review at time t takes the interval of its business that covers t (both bounds
closed) and starts first (ties: ends first, then the smallest attributes). An
interval wins exactly where no earlier one reaches: from the greatest end of those
before it, if that is past its start, to its own end. One running maximum over the
intervals in order of start therefore cuts them into disjoint segments. These
are clipped at the borders of time bins, and a sweep over the times of each (business,
bin) gives every review the last segment that began: no range join, no fan-out, and
a busy business is spread over its bins.

Defined results: reviews without business or time take no interval; intervals
without business, start or end, or that end before they start, cover nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.config import DEFAULT, LABEL_ORGANIC, LABEL_QUARANTINED, Thresholds
from shoal.functions.timecols import MICROS_PER_MINUTE, add_minutes

BIN_MINUTES = 60


def disjoint_segments(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """(business_id, _from, _to, _w): where each interval wins, in microseconds, both
    ends within; _w is the interval's row as a struct."""
    rest = [c for c in intervals.columns if c not in ("business_id", start, end)]
    w = (intervals.select("business_id", F.unix_micros(start).alias("_s"), F.unix_micros(end).alias("_e"),
                          F.struct(start, end, *rest).alias("_w")).where("business_id is not null and _s <= _e"))
    before = Window.partitionBy("business_id").orderBy("_s", "_e", "_w").rowsBetween(Window.unboundedPreceding, -1)
    cut = w.withColumn("_from", F.greatest("_s", F.max("_e").over(before) + 1))  # greatest passes over null
    return cut.where("_from <= _e").select("business_id", "_from", F.col("_e").alias("_to"), "_w")


def covering(reviews: DataFrame, intervals: DataFrame, start: str, end: str, time_col: str = "event_time",
             bin_minutes: int = BIN_MINUTES) -> DataFrame:
    """``reviews`` with column ``_w``: the covering interval as a struct of ``start``,
    ``end`` and the other columns of ``intervals``, or null."""
    width = bin_minutes * MICROS_PER_MINUTE
    bin_of = lambda t: F.floor(t / F.lit(width)).cast("long")
    seg = disjoint_segments(intervals, start, end)
    seg = seg.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_from")), bin_of(F.col("_to")))))
    held = F.struct(*[F.col(f"`{c}`") for c in reviews.columns])
    t = F.unix_micros(time_col)
    r = reviews.select(F.col("business_id").alias("_b"), bin_of(t).alias("_bin"), t.alias("_t"), F.lit(1).alias("_kind"), held.alias("_row"))
    s = seg.select(F.col("business_id").alias("_b"), "_bin", F.greatest("_from", F.col("_bin") * F.lit(width)).alias("_t"),
                   F.lit(0).alias("_kind"), F.struct("_to", "_w").alias("_seg"))
    both = r.where("_b is not null and _t is not null").unionByName(s, allowMissingColumns=True)
    sweep = Window.partitionBy("_b", "_bin").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("_last", F.last("_seg", ignorenulls=True).over(sweep)).where("_kind = 1")
    hit = last.select("_row", F.when(F.col("_t") <= F.col("_last._to"), F.col("_last._w")).alias("_w"))
    none = r.where("_b is null or _t is null").select("_row", F.lit(None).cast(hit.schema["_w"].dataType).alias("_w"))
    return hit.unionByName(none).select("_row.*", "_w")


def label_by_intervals(reviews: DataFrame, intervals: DataFrame, start: str = "window_start", end: str = "window_end",
                       grace_minutes: int = 0, time_col: str = "event_time", bin_minutes: int = BIN_MINUTES) -> DataFrame:
    """``reviews`` with ``label`` and the columns of the interval that covers each
    one up to ``grace_minutes`` after its end (null when organic). Any interval table with
    a ``business_id`` will do; its start and end need lie on no grid."""
    attrs = [c for c in intervals.columns if c != "business_id"]
    reach = intervals.withColumn("_reach", add_minutes(F.col(end), grace_minutes))
    got = covering(reviews, reach, start, "_reach", time_col, bin_minutes)
    return got.select(*[F.col(f"`{c}`") for c in reviews.columns],
                      F.when(F.col("_w").isNotNull(), F.lit(LABEL_QUARANTINED)).otherwise(F.lit(LABEL_ORGANIC)).alias("label"),
                      *[F.col(f"_w.{c}").alias(c) for c in attrs])


def incidents(flagged: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """Runs of flagged windows of a business, each overlapping the ones before it:
    business_id, incident_start, incident_end (grace included), windows, max_review_count."""
    w = flagged.select("business_id", "window_start", add_minutes(F.col("window_end"), thr.grace_minutes).alias("_end"), "window_review_count")
    order = Window.partitionBy("business_id").orderBy("window_start", "_end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens: Column = F.coalesce(F.col("window_start") > F.max("_end").over(before), F.lit(True))
    run = w.withColumn("_opens", opens.cast("int")).withColumn("_run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (run.groupBy("business_id", "_run").agg(
        F.min("window_start").alias("incident_start"), F.max("_end").alias("incident_end"), F.count(F.lit(1)).alias("windows"),
        F.max("window_review_count").alias("max_review_count")).drop("_run"))


def incident_report(reviews: DataFrame, flagged: DataFrame, thr: Thresholds = DEFAULT) -> DataFrame:
    """Per incident: its bounds, windows, reviews inside, their mean stars, injected ones."""
    inc = incidents(flagged, thr)
    got = covering(reviews.select("business_id", "event_time", "stars", "is_injected"), inc, "incident_start", "incident_end")
    keys = ["incident_start", "incident_end", "windows", "max_review_count"]
    return (got.where("_w is not null").groupBy("business_id", *[F.col(f"_w.{c}").alias(c) for c in keys])
            .agg(F.count(F.lit(1)).alias("reviews"), F.count("stars").alias("rated"), F.sum("stars").cast("long").alias("stars_sum"),
                 F.count_if(F.coalesce("is_injected", F.lit(False))).alias("injected")))
