"""Repeated byte strings found by merging sparse Burrows-Wheeler transforms.

Every start of a ``length``-byte string belongs to an anchor: the position of least
16-gram hash among its first ``length - DEPTH + 1`` bytes. The choice depends on
these bytes alone, so equal strings have their anchors at equal offsets, and it
suffices to sort and merge the suffixes at anchors, about one byte in sixty.

Shard: a task sorts the anchor suffixes of about a megabyte of texts by their first
``DEPTH`` bytes (the part that all strings of an anchor share), with the context
before each as the transform's column. Neighbours of equal common prefix form
intervals; members that agree on the whole span of their strings, before and
behind the anchor, are repeated already, and one of them stands for all.

Merge, by refinement of the interleave of all shards, never by a sort of all
suffixes: (1) intervals of all shards meet in blocks of equal ``DEPTH``-byte prefix;
a block of a single interval is unique and leaves. (2) What is left is refined by the
whole span: anchors that share it with another one are repeated in all
their strings. (3) Blocks with several spans are refined string by string: one
anchor for each span gives its bytes to its block, and strings that stand in several
of them are repeated. Blocks are known by fingerprints of their bytes (64 bits for a
block, 128 for what decides).

Scale: rows are anchors, and in step 3 the spans at the borders of repeats; a hot
passage gives one row per shard. Blocks are read as sorted streams, of which one
batch is held, and at most ``_MOST`` rows of a block in step 3, beyond which its strings
are shuffled by their fingerprints. The texts are shuffled once, for steps 3 and the end.

Defined results: matches never cross texts. A null text is empty; texts shorter
than ``length`` bytes lose nothing. Each of several equal rows repeats the others.
Other columns are ignored (``repeats``) or carried unchanged (``drop_repeats``,
which replaces the text; bytes that no longer form a code point are dropped there).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import checkpointed

LENGTH = 200
GRAM = 16
_SHARD = 1 << 20
_POSITION = np.uint64((1 << 22) - 1)
_U = np.uint64
_MIX = _U(0xBF58476D1CE4E5B9)
_LAST = 1 << 10  # an anchor has fewer starts than that
_MOST = 1 << 16

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 1 << 64, (2, 256), np.uint64)
_BASE = (0x9E3779B97F4A7C13, 0xD6E8FEB86659FD93)  # odd, so that they have inverses


def depth_of(length: int) -> int:
    """Bytes of the first refinement: those that all strings of an anchor share."""
    if not 40 <= length < _LAST:
        raise ValueError("length must be from 40 to 1023")
    return length * 2 // 5 // 8 * 8


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX
    return x ^ (x >> _U(29))


class Fingerprints:
    """Polynomial hashes modulo 2**64 of all ranges of some bytes."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray):
        self.sums, n = [], len(data)
        for k, base in enumerate(_BASE):
            if k not in self.powers or len(self.powers[k][0]) <= n:
                size = max(2 * _SHARD, n) + 1
                inverse = pow(base, -1, 1 << 64)
                self.powers[k] = tuple(np.cumprod(np.r_[_U(1), np.full(size, b, np.uint64)]) for b in (base, inverse))
            s = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[k][data] * self.powers[k][0][:n], out=s[1:])
            self.sums.append(s)

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        s = self.sums[k]
        return _mixed((s[end] - s[start]) * self.powers[k][1][start] + (end - start).astype(np.uint64))


def _words(data: np.ndarray, order: str) -> np.ndarray:
    """The 8 bytes from each position as a number; zeros follow the end."""
    padded = np.r_[data, np.zeros(8, np.uint8)]
    return np.ndarray((len(data),), f"{order}u8", padded.data, 0, (1,)).astype(np.uint64)


def anchors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first start, last start) of the strings inside the pieces of
    ``data`` that begin at ``starts``."""
    w = _words(data, "<")
    gram = w * _U(_BASE[0])
    gram[:-8] ^= (w[8:] * _U(_BASE[1])) >> _U(1)
    value = (_mixed(gram) & ~_POSITION) | np.arange(len(data), dtype=np.uint64)
    width = length - depth_of(length) + 1
    reach = 1
    while 2 * reach <= width:  # least of the next 2 * reach values
        value = np.minimum(value[:-reach], value[reach:])
        reach *= 2
    if width > reach:
        value = np.minimum(value[:reach - width], value[width - reach:])
    count = sizes - length + 1
    at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    owner = (value[at] & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:] - 1, len(owner) - 1]
    return owner[first], at[first], at[last]


def _pieces(keys, texts, least: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (key, offset, bytes), about a shard each. A piece of a long
    text overlaps the next by ``least`` - 1 bytes, so no string is lost."""
    held, size = [], 0
    for key, text in zip(keys, texts):
        data = (text or "").encode()
        for at in range(0, len(data) - least + 1, _SHARD):
            held.append((key, at, data[at:at + _SHARD + least - 1]))
            size += len(held[-1][2])
            if size >= _SHARD:
                yield held
                held, size = [], 0
    if held:
        yield held


def _intervals(by: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, whether first of its interval, size of the interval) of rows
    sorted by the columns ``by``; equal rows form an interval."""
    order = np.lexsort(by[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in by:
        c = column[order]
        new[1:] |= c[1:] != c[:-1]
    size = np.diff(np.r_[np.flatnonzero(new), len(order)])
    return order, new, np.repeat(size, size)


_ROW = "key long, s1 long, s2 long, rid long, place long"
_RESOLVED, _SINGLE, _SEVERAL = 0, 1, 2


def _rows(key, s1, s2, rid, lo, last, new, size) -> pd.DataFrame:
    """One row per interval for the merge, and the other members as repeated.
    place: first start, starts after it, and kind of row."""
    kind = np.where(new, np.where(size > 1, _SEVERAL, _SINGLE), _RESOLVED)
    out = kind == _RESOLVED
    signed = lambda x: np.where(out, 0, x.view(np.int64))
    return pd.DataFrame({"key": np.where(out, rid, key.view(np.int64)), "s1": signed(s1), "s2": signed(s2), "rid": rid,
                         "place": ((lo * _LAST + (last - lo)) * 4 + kind)})


def _unplaced(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, kind)."""
    lo, after = place // 4 // _LAST, place // 4 % _LAST
    return lo, lo + after, place % 4


def _joined(pieces: list[tuple[int, int, bytes]]):
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    sizes = np.array([len(p[2]) for p in pieces])
    return data, np.cumsum(sizes) - sizes, sizes


def _shard_rows(length: int):
    """Texts to the intervals of their shard's sparse transform."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        depth = depth_of(length)
        for b in batches:
            for pieces in _pieces(b["rid"], b["text"], length):
                data, starts, sizes = _joined(pieces)
                at, lo, hi = anchors(data, starts, sizes, length)
                prints = Fingerprints(data)
                # sorted by bytes from the anchor on, then by the span around it
                words = _words(data, ">")
                columns = [words[at + j] for j in range(0, depth, 8)]
                s1, s2 = prints.of(0, lo, hi + length), prints.of(1, lo, hi + length)
                order, new, size = _intervals([*columns, s1, s2])
                piece = np.searchsorted(starts, lo, "right") - 1
                rid = np.array([p[0] for p in pieces], np.int64)[piece]
                shift = (np.array([p[1] for p in pieces], np.int64) - starts)[piece]
                o = order
                yield _rows(prints.of(0, at, at + depth)[o], s1[o], s2[o], rid[o], (lo + shift)[o], (hi + shift)[o], new, size)

    return over


def _span_bytes(length: int):
    """The bytes (key, rid, lo, data) of the spans that are to be refined."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for rid, spans, text in zip(b["rid"], b["spans"], b["text"]):
                data = text.encode()
                out += [(s["key"], rid, s["lo"], data[s["lo"]:s["last"] + length]) for s in spans]
            yield pd.DataFrame(out, columns=["key", "rid", "lo", "data"])

    return over


def _refine(length: int):
    """Over spans sorted by block: rows of ``_ROW`` for the strings that stand in
    several spans. Equal strings are in one block, so whole blocks are decided
    here; of a block of over ``_MOST`` spans the strings themselves are given out, to
    be merged by their fingerprints."""

    def strings(c: pd.DataFrame):
        data = np.frombuffer(b"".join(c["data"]), np.uint8)
        sizes = c["data"].map(len).to_numpy()
        starts = np.cumsum(sizes) - sizes
        count = sizes - length + 1
        row = np.repeat(np.arange(len(c)), count)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = starts[row] + offset
        prints = Fingerprints(data)
        w1, w2 = prints.of(0, at, at + length), prints.of(1, at, at + length)
        order, new, size = _intervals([w1, w2])
        return w1, w2, c["rid"].to_numpy()[row], c["lo"].to_numpy()[row] + offset, row, order, new, size

    def given_out(c: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for i in range(0, len(c), _MOST // 16 + 1):
            w1, w2, rid, lo, _, o, new, size = strings(c.iloc[i:i + _MOST // 16 + 1])
            yield _rows(w1[o], w2[o], np.zeros(len(o), np.uint64), rid[o], lo[o], lo[o], new, size)

    def decided(c: pd.DataFrame) -> pd.DataFrame:
        _, _, rid, lo, row, o, _, size = strings(c)
        again = np.zeros(len(o), bool)
        again[o[size > 1]] = True
        rid, lo, row = rid[again], lo[again], row[again]
        new = np.r_[True, (row[1:] != row[:-1]) | (lo[1:] != lo[:-1] + 1)][:len(row)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(row)][:len(first)] - 1
        zero = np.zeros(len(first), np.uint64)
        return _rows(zero, zero, zero, rid[first], lo[first], lo[last], np.zeros(len(first), bool), np.ones(len(first), np.int64))

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, too_many = None, None
        for batch in batches:
            if too_many is not None and (same := (batch["key"] == too_many).to_numpy()).any():
                yield from given_out(batch[same])
                batch = batch[~same]
            chunk = batch if held is None else pd.concat([held, batch], ignore_index=True)
            held = None
            if not len(chunk):
                continue
            keys = chunk["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield decided(chunk.iloc[:cut])
            held = chunk.iloc[cut:]
            if len(held) > _MOST:
                too_many = keys[-1]
                yield from given_out(held)
                held = None
        if held is not None and len(held):
            yield decided(held)

    return over


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows of ``_ROW`` sorted by key, s1, s2: (rid, lo, last, repeated,
    refine, key). A row is repeated if its interval has several members, in its
    shard or by another shard's interval of equal span; it is to be refined if its
    block has several spans and it is the first row of its own. A block of over
    ``_MOST`` rows is given out in parts, and then always refined."""
    held, before, forced = None, None, None

    def out(c: pd.DataFrame, before, after, forced):
        """``before``, ``after``: the rows (key, s1, s2) next to ``c`` in the stream."""
        k, s1, s2 = (c[x].to_numpy() for x in ("key", "s1", "s2"))
        lo, last, kind = _unplaced(c["place"].to_numpy())
        edge = lambda i, row: row is not None and (k[i], s1[i], s2[i]) == row
        same_key = k[1:] == k[:-1]
        same = same_key & (s1[1:] == s1[:-1]) & (s2[1:] == s2[:-1])
        prev = np.r_[edge(0, before), same]
        nxt = np.r_[same, edge(-1, after)]
        block = np.r_[0, np.cumsum(~same_key)]
        spans = np.bincount(block, ~prev)
        many = (spans > 1) | (k[np.flatnonzero(np.r_[True, ~same_key])] == (forced if forced is not None else 0)) & (forced is not None)
        repeated = (kind == _SEVERAL) | prev | nxt
        refine = ~prev & many[block]
        keep = repeated | refine
        return pd.DataFrame({"rid": c["rid"].to_numpy()[keep], "lo": lo[keep], "last": last[keep], "repeated": repeated[keep],
                             "refine": refine[keep], "key": k[keep]})

    row = lambda c, i: tuple(c[x].iloc[i] for x in ("key", "s1", "s2"))
    for batch in batches:
        resolved = (batch["place"].to_numpy() % 4) == _RESOLVED
        if resolved.any():
            lo, last, _ = _unplaced(batch["place"].to_numpy()[resolved])
            yield pd.DataFrame({"rid": batch["rid"].to_numpy()[resolved], "lo": lo, "last": last, "repeated": True, "refine": False, "key": 0})
            batch = batch[~resolved]
        chunk = batch if held is None else pd.concat([held, batch], ignore_index=True)
        held = None
        if not len(chunk):
            continue
        keys = chunk["key"].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if not cut and len(chunk) > _MOST:  # one block: all but its last row
            cut, forced_now = len(chunk) - 1, keys[-1]
            yield out(chunk.iloc[:cut], before, row(chunk, cut), forced_now)
            before, forced = row(chunk, cut - 1), forced_now
        elif cut:
            yield out(chunk.iloc[:cut], before, row(chunk, cut), forced)
            before, forced = row(chunk, cut - 1), None
        held = chunk.iloc[cut:]
    if held is not None and len(held):
        yield out(held, before, None, forced)


_SPAN = "rid long, lo long, last long, repeated boolean, refine boolean, key long"


def _merged(rows: DataFrame) -> DataFrame:
    return (rows.repartition("key").sortWithinPartitions("key", "s1", "s2")
            .mapInPandas(_merge, _SPAN))


def _spans(texts: DataFrame, length: int) -> DataFrame:
    """(rid, spans): the first and last starts of repeated strings of each text."""
    first = checkpointed(_merged(texts.select("rid", "text").mapInPandas(_shard_rows(length), _ROW)))
    open_ = first.filter("refine").groupBy("rid").agg(F.collect_list(F.struct("lo", "last", "key")).alias("spans"))  # a text's anchors at most
    # all columns of texts, so that this shuffle of them serves the last join too
    spans = texts.join(open_, "rid").mapInPandas(_span_bytes(length), "key long, rid long, lo long, data binary")
    strings = spans.repartition("key").sortWithinPartitions("key").mapInPandas(_refine(length), _ROW)
    repeated = first.filter("repeated").select("rid", "lo", "last").unionByName(
        _merged(strings).filter("repeated").select("rid", "lo", "last"))
    return repeated.groupBy("rid").agg(F.collect_list(F.struct("lo", "last")).alias("spans"))  # one for each start at most


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "text")


def _removed(spans, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the strings that start in ``spans``."""
    runs: list[list[int]] = []
    for lo, last in sorted((s["lo"], s["last"]) for s in (spans if spans is not None else ())):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([lo, last + length])
    return [(a, min(b, size)) for a, b in runs]


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in runs)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(data)]))


def repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = _texts(documents)

    @F.pandas_udf(T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                                T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())]))
    def summary(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, s in zip(texts, spans):
            data = (text or "").encode()
            runs = _removed(s, len(data), length)
            out.append((len(data), sum(y - x for x, y in runs), len(runs), hashlib.sha256(_kept(data, runs)).hexdigest()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return (texts.join(_spans(texts, length), "rid", "left")
            .select("doc_id", summary("text", "spans").alias("s")).select("doc_id", "s.*"))


def drop_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with the repeated bytes taken out of their texts."""
    spans = _spans(_texts(documents), length).withColumnRenamed("rid", "_rid")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, s in zip(texts, spans):
            data = (text or "").encode()
            runs = _removed(s, len(data), length)
            out.append(_kept(data, runs).decode("utf-8", "ignore") if runs else text)
        return pd.Series(out, dtype=object)

    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    joined = held.withColumn("_key", F.xxhash64("_row.doc_id", "_row.text")).join(spans, F.col("_key") == F.col("_rid"), "left")
    return (joined.select(F.col("_row").withField("text", cut("_row.text", "spans")).alias("_row")).select("_row.*"))
