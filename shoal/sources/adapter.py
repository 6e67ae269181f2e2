"""Review view over the driver's tables.

The test tables hold no reviews. This view derives one review per ``events``
row and a text from ``documents`` (review i takes the text of document i modulo the
number of documents, so every text is used): 30 days of events are compressed into one
hour (integer microseconds divided by 720) so that sliding windows fill at
every scale, and stars, injected flag and sentiment are derived from the ids
by integer arithmetic that any SQL engine computes alike. The formulas are
fixed values shared with the SQL oracle (``shoal.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.session import ensure_utc

# --- fixed values -------------------------------------------------------
ORIGIN_MICROS = 1704067200000000  # 2024-01-01 00:00:00 UTC
TIME_COMPRESSION = 720            # 30 days -> 1 hour

_REVIEW_EXPRS = (
    "cast(event_id AS string) AS review_id",
    "cast(event_id % 997 AS string) AS user_id",
    "cast(user_id AS string) AS business_id",
    """CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN user_id % 4 = 0 THEN (CASE WHEN event_id % 33 = 0 THEN 2 ELSE 1 END)
            WHEN user_id % 4 = 1 THEN 3
            ELSE cast(1 + (event_id * 7 + cast(floor(value) AS bigint)) % 5 AS int) END AS stars""",
    f"""timestamp_micros({ORIGIN_MICROS}
         + (unix_micros(cast(ts AS timestamp)) - {ORIGIN_MICROS}) div {TIME_COMPRESSION}) AS event_time""",
    f"""timestamp_micros({ORIGIN_MICROS}
         + (unix_micros(cast(ts AS timestamp)) - {ORIGIN_MICROS}) div {TIME_COMPRESSION}
         + (1 + event_id % 90) * 1000000) AS ingestion_time""",
    """CASE WHEN (user_id % 4 = 0 AND event_id % 10 < 9)
              OR (user_id % 4 = 2 AND event_id % 50 = 0) THEN true END AS is_injected""",
    "cast(CASE WHEN value < 30 THEN 0 ELSE 1 END AS double) AS sentiment_label",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def review_adapter(spark: SparkSession, sf_dir: str, with_text: bool = True,
                   with_text_id: bool = False) -> DataFrame:
    """Reviews with columns ``review_id user_id business_id stars text event_time
    ingestion_time is_injected sentiment_label`` (``text`` only if asked).

    ``with_text_id`` adds the number of the review's document instead of its
    text: plans that label, dedupe or sample reviews run on these narrow rows
    and call :func:`attach_text` on what is left.
    """
    ensure_utc(spark)
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    reviews = ev.selectExpr("event_id", *_REVIEW_EXPRS)
    if not (with_text or with_text_id):
        return reviews.drop("event_id")
    n = read_table(spark, sf_dir, "documents").select(F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    narrow = reviews.withColumn("text_id", F.col("event_id") % n).drop("event_id")
    if with_text_id:
        return narrow
    return attach_text(narrow, spark, sf_dir).select(
        "review_id", "user_id", "business_id", "stars", "text",
        "event_time", "ingestion_time", "is_injected", "sentiment_label")


def attach_text(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rows`` (with ``text_id``) and their texts. ``documents.doc_id`` is unique,
    so rows neither vanish nor multiply; all documents are equally likely, so the
    join key has no hot value, however many documents there are."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), "text")
    return rows.join(docs, "text_id", "left").drop("text_id")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality label (NULL where it has none)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")
