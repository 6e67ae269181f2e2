"""JSON-lines reviews: parse with a fixed schema, keep rejects with a reason.

Parsing stays in Spark's JSON reader (``from_json``); malformed text lands in
``_corrupt_record`` instead of failing the job, bad dates become NULL through
``try_cast`` (ANSI mode stays on). Numbers and flags are read as text and
narrowed to INT only when integral, so ``5``, ``5.0`` and ``"5"`` survive and any
other value is NULL; ``_corrupt_record`` then means broken JSON alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.config import REVIEW_WIRE_SCHEMA
from shoal.session import ensure_utc

CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = T.StructType(list(REVIEW_WIRE_SCHEMA.fields) + [T.StructField(CORRUPT, T.StringType())])
_PARSE_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

# status values of a line
VALID, BLANK, MALFORMED = "valid", "blank", "malformed"
NO_ID, NO_BUSINESS, BAD_DATE = "missing_review_id", "missing_business_id", "bad_date"


def _integral(c: Column) -> Column:
    d = c.try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("int"))


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Every input line with a ``status`` and the parsed review columns.

    ``value`` may be STRING or BINARY (Kafka). ``ingestion_time`` is the
    micro-batch (or query) time, ``event_time`` the parsed ``date``.
    """
    raw = F.col(value_col).cast("string")
    txt = F.trim(raw)
    j = F.from_json(raw, _PARSE_SCHEMA, _PARSE_OPTS)
    extra = [c for c in lines.columns if c != value_col]
    df = lines.select(*extra, raw.alias("raw"), txt.alias("_txt"), j.alias("j"))
    parsed = df.select(
        *extra, "raw", "_txt",
        F.col(f"j.{CORRUPT}").alias("_corrupt"),
        F.col("j.review_id").alias("review_id"), F.col("j.user_id").alias("user_id"),
        F.col("j.business_id").alias("business_id"), _integral(F.col("j.stars")).alias("stars"),
        F.col("j.text").alias("text"), F.col("j.date").alias("date"),
        *[_integral(F.col(f"j.{c}")).alias(c) for c in ("useful", "funny", "cool")],
        F.col("j.is_injected").try_cast("boolean").alias("is_injected"),
        F.col("j.date").try_cast("timestamp").alias("event_time"),
        F.current_timestamp().alias("ingestion_time"))
    status = (F.when(F.col("_txt").isNull() | (F.length("_txt") == 0), F.lit(BLANK))
              .when(F.col("_corrupt").isNotNull() | F.col("review_id").isNull() & F.col("business_id").isNull()
                    & F.col("date").isNull() & F.col("stars").isNull() & F.col("text").isNull(), F.lit(MALFORMED))
              .when(F.col("review_id").isNull(), F.lit(NO_ID))
              .when(F.col("business_id").isNull(), F.lit(NO_BUSINESS))
              .when(F.col("event_time").isNull(), F.lit(BAD_DATE))
              .otherwise(F.lit(VALID)))
    out = parsed.withColumn("status", status).drop("_txt", "_corrupt")
    # A filter on ``status`` would otherwise be pushed below this projection
    # with ``from_json`` inlined into it, parsing every line twice; a
    # generator is a barrier for that pushdown, so each line is parsed once.
    return out.select(F.inline(F.array(F.struct(*out.columns))))


REVIEW_OUT = ("review_id", "user_id", "business_id", "stars", "text", "useful", "funny", "cool",
              "event_time", "ingestion_time", "is_injected")


def split_valid_rejected(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(reviews, rejects). Blank lines are skipped silently; every other
    failure is a reject row with ``status`` and the raw text."""
    p = parse_lines(lines, value_col)
    good = p.where(F.col("status") == VALID).select(*REVIEW_OUT)
    bad = p.where(~F.col("status").isin(VALID, BLANK)).select("status", "raw")
    return good, bad


def parse_reviews(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Valid reviews only (rows without id, business or parseable date dropped)."""
    return split_valid_rejected(lines, value_col)[0]


def status_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return parse_lines(lines, value_col).groupBy("status").agg(F.count(F.lit(1)).alias("lines"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their position: file, start of the split in the file, and
    the number within the split. Spark packs splits of several files into a
    task by size, so only these three together give the order of the files."""
    return (spark.read.text(path)
            .select("value", F.struct(F.col("_metadata.file_path").alias("file"),
                                      F.col("_metadata.file_block_start").alias("start"),
                                      F.monotonically_increasing_id().alias("line")).alias("pos")))


def read_reviews_json(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of JSON-lines reviews with the fixed schema (no inference)."""
    ensure_utc(spark)
    return parse_reviews(spark.read.text(path))


def limit_valid(lines_with_pos: DataFrame, n: int, value_col: str = "value") -> DataFrame:
    """The first ``n`` valid reviews by line position; bad lines do not count.
    A top-n (ordered limit), evaluated as a per-partition top-n plus a merge."""
    p = parse_lines(lines_with_pos.select(value_col, "pos"), value_col)
    return p.where(F.col("status") == VALID).orderBy("pos").limit(n)
