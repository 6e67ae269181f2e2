"""Parquet outputs and inputs of the detector, reports as JSON, model files.

Outputs are partitioned by event date and batch id instead of by business id: one
folder per business per trigger would give millions of tiny files at scale. A write
replaces the partitions of its own batch and no others, so a retried batch is
written once and other batches of the same day stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.config import LABEL_ORGANIC, LABEL_QUARANTINED
from shoal.operators.label import organic, quarantined


def write_labelled(labelled: DataFrame, base: str, batch_id: int) -> None:
    """Write organic and quarantined tables under ``base``. ``batch_id`` names the
    call: the same id again replaces what it wrote, another id adds. The rebalance
    hint lets Spark split a large day and merge small ones by size, whatever
    share of it one business has."""
    for name, part in ((LABEL_ORGANIC, organic(labelled)), (LABEL_QUARANTINED, quarantined(labelled))):
        out = part.withColumn("event_date", F.to_date("event_time")).withColumn("batch_id", F.lit(batch_id))
        (out.hint("rebalance", "event_date").sortWithinPartitions("event_date", "business_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "batch_id").parquet(f"{base}/{name}"))


def write_rejects(rejects: DataFrame, base: str, batch_id: int) -> None:
    """Reject rows (``status``, ``raw``) under ``base``/rejects, by batch and
    status; :func:`reject_counts` counts them."""
    (rejects.select("status", "raw").withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "status").parquet(f"{base}/rejects"))


def reject_counts(spark: SparkSession, base: str) -> DataFrame:
    """(batch_id, status, rejects) of the written reject table."""
    return (spark.read.parquet(f"{base}/rejects").groupBy("batch_id", "status")
            .agg(F.count(F.lit(1)).alias("rejects")))


def read_labelled(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(organic, quarantined) tables as written by :func:`write_labelled`."""
    return (spark.read.parquet(f"{base}/{LABEL_ORGANIC}"),
            spark.read.parquet(f"{base}/{LABEL_QUARANTINED}"))


def register_tables(spark: SparkSession, base: str) -> None:
    """Expose the two tables to SQL as ``organic_reviews`` / ``quarantined_reviews``."""
    o, q = read_labelled(spark, base)
    o.createOrReplaceTempView("organic_reviews")
    q.createOrReplaceTempView("quarantined_reviews")


def write_reports(reports: DataFrame, explanations: DataFrame, index: DataFrame, path: str) -> None:
    """JSON lines: one report row per business, one explanation row per
    review, and the index; written by the executors in parallel. Explanations are
    spread by size, not by business."""
    reports.write.mode("overwrite").json(f"{path}/reports")
    explanations.hint("rebalance").write.mode("overwrite").json(f"{path}/explanations")
    index.coalesce(1).write.mode("overwrite").json(f"{path}/index")


def write_latency_report(profile: DataFrame, path: str) -> None:
    """A profile (one row per cohort) as one JSON-lines file in the folder ``path``."""
    profile.coalesce(1).write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
