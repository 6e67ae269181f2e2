"""Attack detection on a stream with the batch semantics.

``window_stats`` over the watermarked stream keeps per-(business, window)
state until the watermark passes the window; flagged windows are joined
back to the reviews with a stream-stream left outer interval join, bounded
on both sides by event time, and an append-mode aggregation keeps the
earliest window per review. The join is also keyed on the minute (each flagged
window is repeated for the minutes it reaches), so the reviews and windows of one
attacked business spread over many state partitions. Spark 4.1 accepts the interval join only when
anchored on ``window_time(window)`` (= window end - 1 microsecond); the
offsets below turn that into ``start <= t <= end + grace`` exactly.

Output appears once the watermark has passed a review's last window, so a
stream's tail is emitted only when later events arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.config import DEFAULT, LABEL_ORGANIC, LABEL_QUARANTINED, Thresholds
from shoal.functions.rules import anomaly_reason
from shoal.functions.stats import mean_from_moments, sample_std_from_moments
from shoal.functions.timecols import MICROS_PER_MINUTE, floor_to
from shoal.operators.text_model import score
from shoal.sources.json_lines import BLANK, VALID, parse_lines
from shoal.sources.tables import write_labelled, write_rejects


def parse_stream(lines: DataFrame, thr: Thresholds = DEFAULT, time_col: str = "event_time",
                 dedupe_ids: bool = False) -> DataFrame:
    """Valid reviews of a ``value`` stream, watermarked on ``time_col``.

    Rows older than the watermark are dropped here by a deduplication keyed
    on (review_id, event time), which also removes exact replays of an
    at-least-once source; its state is evicted by the watermark. (The later
    join alone would still label late rows: its output watermark trails the
    input's.) ``dedupe_ids`` also drops a repeated id with another time
    within the watermark."""
    p = (parse_lines(lines).where(F.col("status") == VALID)
         .drop("status", "raw", "date", "useful", "funny", "cool"))
    if "sentiment_label" not in p.columns:
        p = p.withColumn("sentiment_label", F.lit(None).cast("double"))
    p = p.withWatermark(time_col, thr.watermark).dropDuplicates(["review_id", time_col])
    if dedupe_ids:
        p = p.dropDuplicatesWithinWatermark(["review_id"])
    return p


def reject_stream(lines: DataFrame) -> DataFrame:
    """Lines that are no valid review, with ``status`` and the raw text."""
    return parse_lines(lines).where(~F.col("status").isin(VALID, BLANK)).select("status", "raw")


def rejects_sink(base_path: str):
    """foreachBatch function that stores rejects by batch and status
    (:func:`shoal.sources.tables.reject_counts` counts them)."""
    return lambda batch_df, batch_id: write_rejects(batch_df, base_path, batch_id)


def score_stream(reviews: DataFrame, model, text_col: str = "text") -> DataFrame:
    """``reviews`` with ``sentiment_label`` from a loaded model; between parsing
    and labelling."""
    return score(model, reviews.drop("sentiment_label"), text_col).drop("p_positive")


def _interval(us: int) -> F.Column:
    return F.expr(f"INTERVAL '{us // 1_000_000}.{us % 1_000_000:06d}' SECOND")


def stream_flagged_windows(reviews: DataFrame, thr: Thresholds = DEFAULT,
                           time_col: str = "event_time") -> DataFrame:
    stars = F.col("stars").cast("bigint")
    agg = (reviews.where(F.col("business_id").isNotNull())
           .groupBy(F.col("business_id").alias("f_business_id"),
                    F.window(time_col, thr.window, thr.slide).alias("window"))
           .agg(F.count(F.lit(1)).alias("review_count"), F.count(stars).alias("n"),
                F.sum(stars).alias("s"), F.sum(stars * stars).alias("ss"),
                F.count_if(F.col("stars") <= F.lit(thr.negative_max_stars)).alias("neg_count")))
    stats = agg.select(
        "f_business_id", F.window_time("window").alias("wt"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "review_count", mean_from_moments(F.col("n"), F.col("s")).alias("avg_stars"),
        sample_std_from_moments(F.col("n"), F.col("s"), F.col("ss")).alias("std_stars"), "neg_count")
    return (stats.withColumn("anomaly_reason", anomaly_reason(thr)).where(F.col("anomaly_reason") != "NONE")
            .select("f_business_id", "wt", "window_start", "window_end",
                    F.col("review_count").alias("window_review_count"),
                    F.col("avg_stars").alias("window_avg_stars"),
                    F.col("std_stars").alias("window_std_stars"), "anomaly_reason"))


WINDOW_ATTRS = ("window_start", "window_end", "window_review_count", "window_avg_stars",
                "window_std_stars", "anomaly_reason")


def label_stream(reviews: DataFrame, thr: Thresholds = DEFAULT, time_col: str = "event_time") -> DataFrame:
    """Labelled reviews (append mode), one row per (review_id, event time)."""
    reach = (thr.window_minutes + thr.grace_minutes) // thr.slide_minutes
    step = thr.slide_minutes * MICROS_PER_MINUTE
    flagged = stream_flagged_windows(reviews, thr, time_col).withColumn(
        "_k", F.explode(F.sequence(F.lit(0), F.lit(reach))))
    flagged = flagged.withColumn("_f_minute", F.timestamp_micros(F.unix_micros("window_start") + F.col("_k") * F.lit(step))).drop("_k")
    keyed = reviews.withColumn("_minute", floor_to(F.col(time_col), thr.slide_minutes))
    win_us = thr.window_minutes * MICROS_PER_MINUTE
    grace_us = thr.grace_minutes * MICROS_PER_MINUTE
    t = F.col(time_col)
    cond = ((F.col("business_id") == F.col("f_business_id")) & (F.col("_minute") == F.col("_f_minute"))
            & (t >= F.col("wt") - _interval(win_us - 1))
            & (t <= F.col("wt") + _interval(grace_us + 1)))
    j = keyed.join(flagged, cond, "leftOuter")
    carry = [c for c in reviews.columns if c not in ("review_id", time_col)]
    picked = (j.groupBy("review_id", time_col)
              .agg(F.min(F.struct(*WINDOW_ATTRS, *carry)).alias("_m")))
    return picked.select(
        "review_id", time_col, *[F.col(f"_m.{c}").alias(c) for c in carry],
        F.when(F.col("_m.window_start").isNotNull(), F.lit(LABEL_QUARANTINED))
        .otherwise(F.lit(LABEL_ORGANIC)).alias("label"),
        *[F.col(f"_m.{c}").alias(c) for c in WINDOW_ATTRS])


def labelled_sink(base_path: str):
    """foreachBatch function writing the two tables under ``base_path`` by event
    date and batch id. A retried batch replaces its own files (idempotent); the
    batch is persisted once for both tables."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        b = batch_df.persist()
        try:
            write_labelled(b, base_path, batch_id)
        finally:
            b.unpersist()
    return write


def micro_batch_labeller(base_path: str, thr: Thresholds = DEFAULT, time_col: str = "event_time"):
    """foreachBatch function with per-micro-batch windows (each trigger is
    judged on its own rows, like a detector that runs inside the batch)."""
    from shoal.plans.detect import detect
    sink = labelled_sink(base_path)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        b = batch_df.persist()
        try:
            if not b.isEmpty():
                sink(detect(b, thr, time_col).labelled, batch_id)
        finally:
            b.unpersist()
    return run


def use_rocksdb_state(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def start(labelled: DataFrame, sink, checkpoint: str, trigger: str | None = "30 seconds",
          available_now: bool = False, name: str | None = None):
    """Start a foreachBatch query with a checkpoint (restartable)."""
    w = labelled.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
