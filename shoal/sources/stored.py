"""The labelled reviews as catalog tables: partitions by day, statistics, compaction.

Reports read the stored tables instead of detecting again. A report on some days
opens the files of these days only, by a literal or by a join with a table of days
(dynamic pruning). Streams and small batches leave many small files; compaction
writes a day's files anew in about ``target`` bytes each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.config import LABEL_ORGANIC, LABEL_QUARANTINED
from shoal.operators.evaluate import united
from shoal.operators.label import organic, quarantined

TABLES = {LABEL_ORGANIC: "organic_reviews", LABEL_QUARANTINED: "quarantined_reviews"}
STATISTICS = ("business_id", "event_time", "ingestion_time", "stars")
TARGET_BYTES = 256 << 20
SMALL_SHARE = 0.5  # files below this share of the target are small


def store(labelled: DataFrame, base: str) -> None:
    """Adds labelled reviews to the tables under ``base``, creating them if they are
    not there, by event day. Sorted by business and time within a file, so that a
    file's statistics exclude most businesses."""
    spark = labelled.sparkSession
    for label, part in ((LABEL_ORGANIC, organic(labelled)), (LABEL_QUARANTINED, quarantined(labelled))):
        out = part.withColumn("event_date", F.to_date("event_time"))
        table = TABLES[label]
        (out.hint("rebalance", "event_date").sortWithinPartitions("event_date", "business_id", "event_time")
         .write.format("parquet").mode("append").option("path", f"{base}/{table}").partitionBy("event_date").saveAsTable(table))
        spark.catalog.refreshTable(table)


def attach(spark: SparkSession, base: str) -> None:
    """Defines the tables over files that another session stored under ``base``."""
    for table in TABLES.values():
        spark.catalog.createTable(table, f"{base}/{table}", "parquet")
        spark.catalog.recoverPartitions(table)


def analyze(spark: SparkSession, columns: Sequence[str] = STATISTICS) -> None:
    """Row counts, sizes and column statistics for the optimizer, of the tables and their partitions."""
    for table in TABLES.values():
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
        spark.sql(f"ANALYZE TABLE {table} PARTITION (event_date) COMPUTE STATISTICS")


def days(spark: SparkSession, label: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored reviews of one label from day ``first`` to day ``last``."""
    df = spark.table(TABLES[label])
    if first is not None:
        df = df.where(F.col("event_date") >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col("event_date") <= F.lit(last).cast("date"))
    return df


def labelled_days(spark: SparkSession, first: str | None = None, last: str | None = None) -> DataFrame:
    """Both tables of these days as one labelled frame, for the evaluation reports."""
    return united(days(spark, LABEL_ORGANIC, first, last), days(spark, LABEL_QUARANTINED, first, last))


def of_days(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a stored table on the days (event_date) of ``wanted``, a small
    table such as the days of some incidents; other days' files are skipped."""
    listed = wanted.select(F.col("event_date").alias("_day")).distinct()
    return table.join(listed, F.col("event_date") == F.col("_day"), "left_semi")


def file_sizes(spark: SparkSession, table: str) -> DataFrame:
    """(event_date, files, bytes, small): files of each day and how many are small."""
    f = (spark.table(table).select("event_date", F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).distinct())
    return f.groupBy("event_date").agg(F.count(F.lit(1)).alias("files"), F.sum("b").alias("bytes"),
                                       F.count_if(F.col("b") < F.lit(int(TARGET_BYTES * SMALL_SHARE))).alias("small"))


def compact(spark: SparkSession, table: str, scratch: str, target: int = TARGET_BYTES) -> list[str]:
    """Writes the days that have over one file more than their bytes need anew; gives their
    dates. The new files are complete under ``scratch`` (a shared folder) before any
    old one goes, so a failed run loses nothing and can be repeated from there."""
    need = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target))).cast("int")
    todo = file_sizes(spark, table).where(F.col("files") > need + 1).select("event_date", need.alias("parts"))
    plan = todo.orderBy("event_date").collect()  # a row per day
    done = []
    for r in plan:
        day = str(r["event_date"])
        rows = spark.table(table).where(F.col("event_date") == F.lit(day).cast("date"))
        path = f"{scratch}/{table}/{day}"
        (rows.repartitionByRange(r["parts"], "business_id", "event_time").sortWithinPartitions("business_id", "event_time")
         .write.mode("overwrite").parquet(path))
        # a static partition: no other day is touched, whatever the session's overwrite mode is
        columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != "event_date")
        spark.read.parquet(path).createOrReplaceTempView("_compacted_day")
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (event_date = DATE'{day}') SELECT {columns} FROM _compacted_day")
        spark.catalog.dropTempView("_compacted_day")
        spark.catalog.refreshTable(table)
        done.append(day)
    return done
