"""Exact area under the ROC curve as a distributed rank sum.

Rows of one score are counted together. The scores are cut into ranges of about
equal size, so no task sorts more than its range; the counts of the ranges before
give each range its start. Ties count half. All sums are integers, so the
result does not depend on the partitioning.

Rows without score or label are left out; with one class only the area is null.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.functions.numeric import ratio

RANGES = 256


def score_counts(rows: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, neg) of every score that occurs; label 1 is positive."""
    some = rows.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    return (some.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))


def _ranged(counts: DataFrame, ranges: int) -> DataFrame:
    """``counts`` with column _b, the number of its range of scores."""
    cuts = [i / ranges for i in range(1, ranges)]
    edges = counts.approxQuantile("score", cuts, 0.25 / ranges) if cuts else []  # ranges numbers
    splits = [float("-inf"), *sorted(set(edges) or {0.0}), float("inf")]
    return Bucketizer(splits=splits, inputCol="score", outputCol="_b").transform(counts)


def auc(rows: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """One row: positives, negatives, auc."""
    ranged = _ranged(score_counts(rows, score, label), ranges)
    sums = ranged.groupBy("_b").agg(F.sum("neg").alias("_n"))  # a row per range
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("_b").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = (ranged.withColumn("_own", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
             .join(F.broadcast(starts), F.col("_b") == F.col("_r")).withColumn("_below", F.col("_before") + F.col("_own")))
    twice = F.sum(F.col("pos").cast("decimal(38,0)") * (2 * F.col("_below") + F.col("neg")).cast("decimal(20,0)")).cast("decimal(38,0)")
    whole = below.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"), twice.alias("_t"))
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return whole.select("positives", "negatives", ratio(F.col("_t"), pairs).alias("auc"))


def roc_points(rows: DataFrame, score: str, label: str, step: float = 0.1) -> DataFrame:
    """The ROC curve at thresholds ``step`` apart that hold a score: threshold, and
    of the rows with that score or more the true and false positives and their rates."""
    grid = (score_counts(rows, score, label).groupBy(F.floor(F.col("score") / F.lit(step)).alias("_g"))
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))  # a row per step that holds a score
    down = Window.orderBy(F.desc("_g")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(F.desc("_g")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = grid.select("_g", F.sum("pos").over(down).alias("true_positives"), F.sum("neg").over(down).alias("false_positives"),
                    F.sum("pos").over(every).alias("_p"), F.sum("neg").over(every).alias("_n"))
    return t.select((F.col("_g") * F.lit(step)).alias("threshold"), "true_positives", "false_positives",
                    ratio(F.col("true_positives"), F.col("_p")).alias("tpr"), ratio(F.col("false_positives"), F.col("_n")).alias("fpr"))
