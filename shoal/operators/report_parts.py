"""Business reports with their reviews nested inside, in parts of bounded size.

A business's explained reviews are numbered and cut into arrays of at most ``size``
entries, one row each; a manifest row per business tells how many parts and
reviews there are. Numbering is by pieces: a business of more than ``PIECE`` reviews is
dealt by a hash of the review id, each piece is numbered by itself, and the pieces'
part counts add up to the part numbers. No row and no task holds a whole business.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART = 50
PIECE = 100_000
ENTRY = ("review_id", "stars", "text_preview", "top_features")


def _piece(pieces) -> F.Column:
    digits = F.conv(F.substring(F.md5(F.coalesce(F.col("review_id"), F.lit(""))), 1, 8), 16, 10).cast("long")
    return F.pmod(digits, pieces)


def report_parts(explanations: DataFrame, size: int = PART, piece: int = PIECE, entry: tuple[str, ...] = ENTRY) -> DataFrame:
    """(business_id, part, n, reviews): ``reviews`` is an array of structs of ``entry``
    in order of review id, at most ``size`` of them; parts count from 1. The explanations go
    through one shuffle: businesses in pieces are fewer than the reviews by ``piece``, so
    their piece counts and the part counts before each piece are broadcast."""
    many = (explanations.groupBy("business_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(piece)).cast("long").alias("_pieces"))
            .where(F.col("_pieces") > 1).withColumnRenamed("business_id", "_b"))
    same = F.col("business_id").eqNullSafe(F.col("_b"))
    before = Window.partitionBy("_b").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # a row per piece
    first = (explanations.select("business_id", "review_id").join(F.broadcast(many), same)
             .groupBy("_b", _piece(F.col("_pieces")).alias("_at")).agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("_parts"))
             .select("_b", "_at", F.coalesce(F.sum("_parts").over(before), F.lit(0)).alias("_before")))
    rows = (explanations.join(F.broadcast(many), same, "left").drop("_b")
            .withColumn("_piece", _piece(F.coalesce("_pieces", F.lit(1)))).drop("_pieces"))
    numbered = rows.withColumn("_n", F.row_number().over(Window.partitionBy("business_id", "_piece").orderBy("review_id")) - 1)
    parts = (numbered.groupBy("business_id", "_piece", F.floor(F.col("_n") / F.lit(size)).alias("_k"))
             .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(F.col("_n"), F.struct(*entry).alias("r")))).alias("_l")))
    part = (F.coalesce("_before", F.lit(0)) + F.col("_k") + 1).cast("int").alias("part")
    return (parts.join(F.broadcast(first), same & (F.col("_piece") == F.col("_at")), "left")
            .select("business_id", part, "n", F.transform("_l", lambda x: x["r"]).alias("reviews")))


def manifest(parts: DataFrame) -> DataFrame:
    """(business_id, parts, reviews) of the parts of each business."""
    return parts.groupBy("business_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("reviews"))


def reassembled(parts: DataFrame) -> DataFrame:
    """The explanations that the parts were made of, one row per review."""
    return parts.select("business_id", F.explode("reviews").alias("r")).select("business_id", "r.*")


def write_nested_reports(reports: DataFrame, parts: DataFrame, path: str) -> None:
    """The business reports with their manifest, and the parts, as JSON lines under
    ``path``/reports and /parts; read again by :func:`read_nested_parts`."""
    parts.write.mode("overwrite").json(f"{path}/parts")
    m = manifest(read_nested_parts(parts.sparkSession, path, parts.schema)).withColumnRenamed("business_id", "_b")
    (reports.join(m, F.col("business_id").eqNullSafe(F.col("_b")), "left").drop("_b")
     .withColumnsRenamed({"parts": "review_parts", "reviews": "explained_reviews"}).write.mode("overwrite").json(f"{path}/reports"))


def read_nested_parts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(f"{path}/parts")
