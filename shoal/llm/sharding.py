"""Shards balanced jointly in bytes, tokens and rows by vector bin packing.

Equal texts form a group and stay together. A group is placed in the shard
whose residual capacity has the highest dot product with the group's vector of
(bytes, tokens, rows), each as a share of the total (Panigrahy et al. 2011),
largest group first. What is placed one by one is bounded by constants, not by
the data: groups below 1/``PACKETS`` of every total are dealt by hash into
``PACKETS`` packets, so at most ``PACKETS`` packets and 3 * ``PACKETS`` large
groups are known to the driver and broadcast. A group beyond a quarter of a
shard is dealt into pieces of about that size by the hash of a row's place in the input, so
that repeated rows are dealt too.

Rows are numbered within a shard from per-split counts and their running sum;
a window holds the rows of one split of the input at most.

Defined results: a null text has size 1 and the checksum of the empty text, and
is equal to other null texts; an empty table gives an empty result. Repeated
rows get a slot each. Other columns are ignored (``shard_table``) or written
too (``write_shards``, whose partition column is ``_shard``).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import checkpointed
from shoal.llm.mixing import tokens

SHARDS = 8
PACKETS = 4096
LAW = "bytes"


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of shares of the totals). An item goes, of the
    shards that have room for it in every dimension, to the one of highest dot
    product with the residual capacity; if none has room, where it overflows
    least."""
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    out = np.zeros(len(items), np.int32)
    for i in np.argsort(-items.max(axis=1, initial=0), kind="stable"):
        left = residual - items[i]
        fits = (left >= 0).all(axis=1)
        best = np.where(fits, residual @ items[i], -np.inf) if fits.any() else left.min(axis=1)
        out[i] = k = int(best.argmax())
        residual[k] = left[k]
    return out


def _with_keys(rows: DataFrame, text: str) -> DataFrame:
    text = F.coalesce(F.col(text), F.lit(""))
    return rows.withColumns({
        "_size": (F.octet_length(text) + 1).cast("long"), "_crc": F.crc32(text.cast("binary")),
        "_key": F.xxhash64(text), "_piece": F.xxhash64(F.monotonically_increasing_id())})


def assign(rows: DataFrame, shards: int = SHARDS, packets: int = PACKETS) -> tuple[DataFrame, DataFrame]:
    """Where the rows (_size, tokens, _key, _crc) go: (_p, _by_packet) of the
    packets, and (_key, _crc, _by_piece) of the large groups."""
    sums = [F.sum("_size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")]
    groups = checkpointed(rows.groupBy("_key", "_crc").agg(*sums))
    total = [float(x or 1) for x in groups.agg(F.sum("b"), F.sum("t"), F.sum("r")).first()]
    share = F.greatest(*[F.col(c) / F.lit(x) for c, x in zip("btr", total)])
    large = groups.withColumn("share", share).filter(F.col("share") >= 1.0 / packets).collect()  # 3 * packets rows at most
    dealt = (groups.filter(share < 1.0 / packets).groupBy(_packet(packets).alias("p"))
             .agg(*[F.sum(c).alias(c) for c in "btr"]).collect())  # packets rows at most
    pieces = [max(1, math.ceil(g["share"] * 4 * shards)) for g in large]
    vectors = [[x[c] / t for c, t in zip("btr", total)] for x in dealt]
    for g, m in zip(large, pieces):
        vectors += [[g[c] / t / m for c, t in zip("btr", total)]] * m
    shard = pack(np.array(vectors, float).reshape(-1, 3), shards).tolist()
    own, at = [], len(dealt)
    for g, m in zip(large, pieces):
        own.append((g["_key"], g["_crc"], shard[at:at + m]))
        at += m
    spark = rows.sparkSession
    return (spark.createDataFrame([(int(x["p"]), s) for x, s in zip(dealt, shard)], "_p long, _by_packet int"),
            spark.createDataFrame(own, "_key long, _crc long, _by_piece array<int>"))


def _packet(packets: int) -> Column:
    return F.pmod(F.xxhash64("_key", "_crc"), F.lit(packets))


def place(rows: DataFrame, places: DataFrame, own: DataFrame, packets: int = PACKETS) -> DataFrame:
    """``rows`` (_key, _crc, _piece, ...) with column _shard."""
    piece = F.pmod(F.col("_piece"), F.size("_by_piece")).cast("int")
    return (rows.join(F.broadcast(own), ["_key", "_crc"], "left").withColumn("_p", _packet(packets))
            .join(F.broadcast(places), "_p", "left")
            .withColumn("_shard", F.when(F.col("_by_piece").isNotNull(), F.get("_by_piece", piece)).otherwise(F.col("_by_packet")))
            .drop("_p", "_by_packet", "_by_piece"))


def number(rows: DataFrame) -> DataFrame:
    """``rows`` (_shard, _split, _n) with column slot, gapless from 0 in a shard."""
    counts = rows.groupBy("_shard", "_split").agg(F.count("*").alias("c"))
    before = Window.partitionBy("_shard").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shard", "_split", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("_shard", "_split").orderBy("_n"))
    return rows.withColumn("own", own).join(offsets, ["_shard", "_split"]).withColumn("slot", F.col("offset") + F.col("own") - 1)


def _counted(documents: DataFrame) -> DataFrame:
    return checkpointed(_with_keys(documents, "text").select(
        "doc_id", "_size", "_crc", "_key", "_piece", tokens(F.col("text")).alias("tokens"),
        F.spark_partition_id().alias("_split"), F.monotonically_increasing_id().alias("_n")))


def shard_table(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null:
    this law promises nothing about one more shard), tokens."""
    rows = _counted(documents)
    placed = number(checkpointed(place(rows, *assign(rows, shards))))
    return placed.select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit(LAW).alias("law"),
                         F.col("_shard").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, files: int = 16) -> None:
    """``documents`` as Parquet in one folder ``_shard=k`` per shard, each
    written by ``files`` tasks."""
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    rows = _with_keys(held.withColumn("_text", F.col("_row.text")), "_text")
    placed = place(rows, *assign(_counted(documents), shards))
    (placed.select("_row.*", "_shard").repartition(shards * files, "_shard", F.pmod(F.xxhash64("doc_id"), F.lit(files)))
     .write.partitionBy("_shard").parquet(path))
