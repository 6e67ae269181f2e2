"""Documents drawn by their likeness to a target, by hashed n-gram importance weights
(Xie et al. 2023) and Gumbel scores.

The features of a text are its runs of 1 to ``RUN`` consecutive words
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z lower-cased), joined by one space; a
feature's bucket is its CRC-32 modulo ``BUCKETS``. A document's weight is the sum
of its features' gains, in thousandths of the log ratio of target and corpus
frequency of their buckets. Gumbel noise, keyed by doc_id, turns the order of weights
into a draw without replacement.

CRC-32 is affine: apart from a constant of the length, the checksum is the
exclusive or of what each byte, at its distance from the end, contributes. ``_AT``
holds these contributions for distances below ``SPAN``; the features of about ``CHUNK``
bytes of text are looked up at once and folded by ``bitwise_xor.reduceat``. Longer
spans are cut into blocks from their end; the register of a block with j blocks
behind it is moved on by the tables for 2**i blocks, for each bit i of j.

Scale: two passes over the texts, nothing of them is shuffled. The first sends at
most ``BUCKETS`` sums per task, the second one narrow row per document. Ranks come
from one range partitioning of narrow rows by (score, doc_id) and the partitions' sizes, so no
task sorts more than its range.

Defined results: a null text has no words; its weight is 0. A null doc_id counts as
empty text under the hash and as larger than any other in ties. Repeated rows are
ranked one by one. An empty target gives every bucket its smoothed gain. Other
columns are ignored, and carried unchanged by ``resampled``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import checkpointed

RUN = 3
BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = 42
SPAN = 64
CHUNK = 1 << 17
_U4 = np.uint32


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contribution of a byte by distance from the end, register after ``SPAN``
    zero bytes by byte of the register, checksums of ``SPAN`` * 64 lengths of zeros)."""
    byte = np.arange(256, dtype=_U4)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ _U4(0xEDB88320), byte >> 1).astype(_U4)
    step = lambda reg: (reg >> _U4(8)) ^ byte[reg & _U4(255)]
    at = [byte]
    while len(at) < SPAN:
        at.append(step(at[-1]))
    block = np.arange(256, dtype=_U4)[None, :] << _U4(8) * np.arange(4, dtype=_U4)[:, None]
    for _ in range(SPAN):
        block = step(block)
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(64 * SPAN)], _U4)
    return np.concatenate(at), block, zeros


def _moved(table: np.ndarray, reg: np.ndarray) -> np.ndarray:
    out = table[0][reg & _U4(255)]
    for k in range(1, 4):
        out = out ^ table[k][(reg >> _U4(8 * k)) & _U4(255)]
    return out


@cache
def _block_step(level: int) -> np.ndarray:
    """Tables that move a register on by 2**level blocks of zeros."""
    return _tables()[1] if not level else _moved(_block_step(level - 1), _block_step(level - 1))


def _folded(base: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Registers of spans of 1 to ``SPAN`` bytes; ``base`` has each byte less 256
    times its place, so a span's end makes it an index of the table."""
    size = end - start
    first = np.cumsum(size) - size
    at = np.arange(int(first[-1] + size[-1]), dtype=base.dtype)
    at += np.repeat((start - first).astype(base.dtype), size)
    index = base[at]
    index += np.repeat(256 * (end - 1), size)
    return np.bitwise_xor.reduceat(_tables()[0][index], first)


def _registers(base: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Registers of any spans that hold a byte."""
    blocks = (end - start + SPAN - 1) // SPAN
    if blocks.max() == 1:
        return _folded(base, start, end)
    first = np.cumsum(blocks) - blocks
    behind = np.repeat(first + blocks - 1, blocks) - np.arange(int(blocks.sum()))
    b_end = np.repeat(end, blocks) - SPAN * behind
    b_start = np.maximum(np.repeat(start, blocks), b_end - SPAN)
    step = CHUNK // SPAN
    reg = np.concatenate([_folded(base, b_start[i:i + step], b_end[i:i + step]) for i in range(0, len(b_end), step)])
    for level in range(int(behind.max()).bit_length()):
        some = np.flatnonzero(behind >> level & 1)
        reg[some] = _moved(_block_step(level), reg[some])
    return np.bitwise_xor.reduceat(reg, first)


def crc_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans [start, end) of some bytes; each holds a byte at least."""
    out = np.empty(len(start), _U4)
    size = end - start
    upto = np.cumsum(size)
    i = 0
    while i < len(start):  # about CHUNK bytes at a time
        j = max(i + 1, int(np.searchsorted(upto, upto[i] - size[i] + CHUNK, "right")))
        low, high = int(start[i:j].min()), int(end[i:j].max())
        small = np.int32 if high - low < 1 << 22 else np.int64
        base = data[low:high].astype(small) - 256 * np.arange(high - low, dtype=small)
        out[i:j] = _registers(base, (start[i:j] - low).astype(small), (end[i:j] - low).astype(small))
        i = j
    zeros = _tables()[2]
    short = size < len(zeros)
    out ^= zeros[np.where(short, size, 0)]
    for i in np.flatnonzero(~short):
        out[i] ^= _U4(zlib.crc32(bytes(int(size[i]))))
    return out


_WORD = np.array([48 <= i <= 57 or 97 <= i <= 122 or i >= 128 for i in range(256)])


def features(texts: list[bytes], run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, text of each feature, bucket of each feature)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    raw = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)  # touches A-Z only
    inside = _WORD[raw]
    edges = np.flatnonzero(np.diff(np.r_[False, inside]))
    first, last = edges[::2], edges[1::2]
    owner = np.searchsorted(np.cumsum(sizes), first, "right")
    words = np.bincount(owner, minlength=len(texts))
    kept = inside.copy()
    kept[last] = True  # one space after each word
    data = np.where(inside, raw, np.uint8(32))[kept]
    length = last - first
    start = np.cumsum(length + 1) - length - 1
    end = start + length
    whose, codes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in range(1, run + 1):
        if len(owner) >= n:
            same = owner[n - 1:] == owner[:len(owner) - n + 1]
            whose.append(owner[:len(same)][same])
            codes.append(crc_spans(data, start[:len(same)][same], end[n - 1:][same]) % _U4(buckets))
    return words, np.concatenate(whose), np.concatenate(codes).astype(np.int64)


def _groups(texts: pd.Series) -> Iterator[list[bytes]]:
    """The texts in lists of about ``CHUNK`` bytes."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode())
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _bucket_sums(run: int, buckets: int):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in _groups(batch["text"]):
                total += np.bincount(features(group, run, buckets)[2], minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    return over


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the whole table fall into each bucket."""
    r = (texts.select("text").mapInPandas(_bucket_sums(run, buckets), "bucket long, n long")
         .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # buckets rows at most
    out = np.zeros(buckets, np.int64)
    for bucket, n in r:
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of target and corpus frequency."""
    k, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = (target + 1.0) * (s_all + k) / ((corpus + 1.0) * (t_all + k))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _weigher(gain: np.ndarray, run: int):
    @F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]))
    def weigh(texts: pd.Series) -> pd.DataFrame:
        out = [np.empty((0, 3), np.int64)]
        for group in _groups(texts):
            words, whose, codes = features(group, run, len(gain))
            weight = np.zeros(len(group), np.int64)
            np.add.at(weight, whose, gain[codes])
            out.append(np.stack([words, np.bincount(whose, minlength=len(group)), weight], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["n_words", "n_features", "weight"])

    return weigh.asNondeterministic()  # else every use of a field would read the text again


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, from the first 32 bits of a keyed SHA-256."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _scored(rows: DataFrame, documents: DataFrame, target: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    gain = gains(bucket_counts(documents), bucket_counts(target))
    c = rows.withColumn("_c", _weigher(gain, RUN)(text))
    return c.withColumn("_score", F.col("_c.weight") + gumbel(doc_id)).withColumn("_fit", F.col("_c.n_words") >= MIN_WORDS)


def importance_ranks(documents: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank (null: not drawn). Of the
    documents with ``MIN_WORDS`` words, ``percent`` in a hundred are drawn."""
    rows = documents.select("doc_id", "text")
    scored = checkpointed(_scored(rows, documents, target, F.col("doc_id"), F.col("text"))
                          .select("doc_id", F.col("_c.n_features").alias("n_features"), F.col("_c.weight").alias("weight"),
                                  F.col("_score").alias("score"), F.col("_fit").alias("fit")))
    drawn = percent * scored.filter("fit").count() // 100
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("doc_id")]
    # the identifier holds the range's number above the row's number in it
    ranged = checkpointed(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part, own = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("p")).count().orderBy("p").collect()  # a row per range
    before, ends = 0, []
    for p, n in sizes:
        ends.append((p, before))
        before += n
    offsets = documents.sparkSession.createDataFrame(ends, "_p long, _before long")
    rank = F.col("_before") + own + 1
    return (ranged.join(F.broadcast(offsets), part == F.col("_p"))
            .select("doc_id", "n_features", "weight", "score", F.when(F.col("fit") & (rank <= drawn), rank).alias("rank")))


def resampled(documents: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The drawn rows of ``documents``. Rows equal to the last one in score and
    doc_id are all drawn."""
    last = (importance_ranks(documents, target, percent).filter("rank is not null")
            .agg(F.max_by(F.struct("score", "doc_id"), "rank").alias("m")).first()["m"])
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    rows = _scored(held, documents, target, F.col("_row.doc_id"), F.col("_row.text")).filter("_fit")
    if last is None:
        return rows.filter(F.lit(False)).select("_row.*")
    doc = F.col("_row.doc_id")
    tied = F.lit(True) if last["doc_id"] is None else F.coalesce(doc <= F.lit(last["doc_id"]), F.lit(False))
    return rows.filter((F.col("_score") > last["score"]) | ((F.col("_score") == last["score"]) & tied)).select("_row.*")
