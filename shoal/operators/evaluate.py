"""Detection quality and throughput reports over labelled reviews (column
``label``). Each report is one conditional aggregate, so one detection plan. For
the two tables read back from disk :func:`united` gives the same shape.
Reports on flagged reviews alone take the quarantined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.config import LABEL_ORGANIC, LABEL_QUARANTINED
from shoal.functions.numeric import ratio, round_half
from shoal.functions.timecols import seconds_between



def _injected() -> Column:
    return F.coalesce(F.col("is_injected"), F.lit(False))


def _is_quarantined() -> Column:
    return F.col("label") == LABEL_QUARANTINED


def united(organic: DataFrame, quarantined: DataFrame) -> DataFrame:
    """UNION ALL of the two stored tables with ``label`` naming the table; columns
    that the organic table lacks are NULL."""
    return (organic.withColumn("label", F.lit(LABEL_ORGANIC))
            .unionByName(quarantined.withColumn("label", F.lit(LABEL_QUARANTINED)), allowMissingColumns=True))


def eval_precision(quarantined: DataFrame) -> DataFrame:
    return (quarantined.agg(F.count_if(_injected()).alias("true_positives"),
                            F.count_if(~_injected()).alias("false_positives"),
                            F.count(F.lit(1)).alias("total_quarantined"))
            .withColumn("precision", round_half(ratio(F.col("true_positives"),
                                                      F.col("total_quarantined")), 4)))


def _pr_counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.count_if(_is_quarantined() & _injected()).alias("caught_count"),
                        F.count_if(_injected()).alias("total_injected"),
                        F.count_if(_is_quarantined()).alias("total_quarantined"))


def eval_recall(labelled: DataFrame) -> DataFrame:
    return (_pr_counts(labelled)
            .select("caught_count", "total_injected",
                    round_half(ratio(F.col("caught_count"), F.col("total_injected")), 4).alias("recall")))


def eval_f1(labelled: DataFrame) -> DataFrame:
    c = _pr_counts(labelled)
    p = ratio(F.col("caught_count"), F.col("total_quarantined"))
    r = ratio(F.col("caught_count"), F.col("total_injected"))
    s = c.select(p.alias("p"), r.alias("r"))
    f1 = F.try_divide(F.lit(2.0) * F.col("p") * F.col("r"), F.nullif(F.col("p") + F.col("r"), F.lit(0.0)))
    return s.select(round_half(F.col("p"), 4).alias("precision"),
                    round_half(F.col("r"), 4).alias("recall"),
                    round_half(f1, 4).alias("f1_score"))


def eval_sentiment_accuracy(organic: DataFrame) -> DataFrame:
    ok = (((F.col("stars") <= 2) & (F.col("sentiment_label") == 0))
          | ((F.col("stars") >= 4) & (F.col("sentiment_label") == 1)))
    return (organic.where(F.col("stars") != 3)
            .agg(F.count_if(ok).alias("correct"), F.count(F.lit(1)).alias("total"))
            .withColumn("sentiment_accuracy", round_half(ratio(F.col("correct"), F.col("total")), 4)))


def attack_timeline(quarantined: DataFrame) -> DataFrame:
    """Per (business, reason): first/last flagged review, count, mean stars,
    distinct users; newest attack first (ties by business, reason)."""
    return (quarantined.groupBy("business_id", "anomaly_reason")
            .agg(F.min("event_time").alias("attack_start"), F.max("event_time").alias("attack_end"),
                 F.count(F.lit(1)).alias("flagged_count"),
                 round_half(ratio(F.sum("stars"), F.count("stars")), 2).alias("avg_stars"),
                 F.countDistinct("user_id").alias("unique_attackers"))
            .orderBy(F.desc("attack_start"), "business_id", "anomaly_reason"))


def _latency_us(df: DataFrame) -> DataFrame:
    return df.select((F.unix_micros("ingestion_time") - F.unix_micros("event_time")).alias("lat_us"))


def latency_mean(quarantined: DataFrame) -> DataFrame:
    """Mean event-to-ingestion latency in seconds, from exact integer microseconds."""
    lat = _latency_us(quarantined)
    mean = ratio(F.sum("lat_us"), F.count("lat_us")) / F.lit(1_000_000.0)
    return lat.agg(round_half(mean, 2).alias("avg_latency_seconds"))


def latency_approx(quarantined: DataFrame, accuracy: int = 10000) -> DataFrame:
    """Sketch percentiles (p50/p95/p99) of the latency in microseconds, each with
    whether its rank lies within the sketch's bound (rows / ``accuracy``) of the
    exact one. One row per percentile, plus the mean in seconds."""
    lat = _latency_us(quarantined).where(F.col("lat_us").isNotNull())
    probs = (0.5, 0.95, 0.99)
    q = lat.select(F.percentile_approx("lat_us", list(probs), accuracy)).scalar()   # scalar subquery
    at = [F.get(q, F.lit(i)) for i in range(len(probs))]
    whole = lat.agg(F.count(F.lit(1)).alias("n"), F.sum("lat_us").alias("s"), F.array(*[F.struct(
        F.lit(p).alias("p"), F.count_if(F.col("lat_us") < v).alias("below"), F.count_if(F.col("lat_us") <= v).alias("upto"))
        for p, v in zip(probs, at)]).alias("r"))
    ranks = whole.where("n > 0").select("n", "s", F.inline("r"))
    bound = F.col("n") / F.lit(float(accuracy)) + F.lit(1.0)
    return ranks.select(
        F.col("p").alias("percentile"), round_half(ratio(F.col("s"), F.col("n")) / F.lit(1_000_000.0), 2).alias("avg_latency_seconds"),
        ((F.col("below") <= F.col("p") * F.col("n") + bound) & (F.col("upto") >= F.col("p") * F.col("n") - bound)).alias("rank_within_bound"))


def throughput_per_minute(labelled: DataFrame) -> DataFrame:
    return (labelled.groupBy(F.date_trunc("minute", "ingestion_time").alias("minute_bucket"))
            .agg(F.count(F.lit(1)).alias("reviews_per_minute"))
            .orderBy("minute_bucket"))


def confusion_matrix(labelled: DataFrame) -> DataFrame:
    actual = F.when(_injected(), F.lit("injected")).otherwise(F.lit("organic"))
    return (labelled.groupBy(F.col("label").alias("predicted"), actual.alias("actual"))
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy("predicted", "actual"))


def false_positive_rate(labelled: DataFrame) -> DataFrame:
    """Share of non-injected reviews that were quarantined."""
    c = labelled.agg(F.count_if(_is_quarantined() & ~_injected()).alias("false_positives"),
                     F.count_if(~_is_quarantined() & ~_injected()).alias("true_negatives"))
    return c.withColumn("false_positive_rate", round_half(
        ratio(F.col("false_positives"), F.col("false_positives") + F.col("true_negatives")), 4))


def detection_delay(labelled: DataFrame) -> DataFrame:
    """Per attacked business: first injected review, end of the first window
    that quarantined an injected review (when the detector fires), and the
    delay between them in seconds (NULL when never detected)."""
    per = (labelled.where(_injected()).groupBy("business_id")
           .agg(F.min("event_time").alias("attack_start"),
                F.min("window_end").alias("detected_at"),
                F.count(F.lit(1)).alias("injected_count")))
    return (per.withColumn("detection_delay_seconds",
                           round_half(seconds_between(F.col("detected_at"), F.col("attack_start")), 3))
            .orderBy("business_id"))


def star_distribution(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("stars").agg(F.count(F.lit(1)).alias("n")).orderBy("stars")


def most_reviewed(reviews: DataFrame) -> DataFrame:
    """Business with the most reviews (ties: smallest id). A top-1 report."""
    return (reviews.where(F.col("business_id").isNotNull()).groupBy("business_id")
            .agg(F.count(F.lit(1)).alias("review_count"))
            .orderBy(F.desc("review_count"), "business_id").limit(1))
