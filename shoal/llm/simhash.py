"""SimHash near-duplicates found with deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. If two fingerprints
differ in at most three bits, one of their segments differs in at most one, so
the pair agrees on that segment as it is or with one position made a wildcard.
Every distinct fingerprint is therefore indexed under 2 * (32 + 1) keys; equal
keys meet in one shuffle, and the full distance is verified there. Keys without a
second member, nearly all, are dropped before the verifying tasks see them.

Scale: copies collapse to one fingerprint before anything is indexed. A bucket
yields a spanning forest of its verified links, never all its pairs, so links
stay within 66 per fingerprint. A bucket beyond ``BUCKET`` members is not
compared but indexed again, by the same cut of its other segment (two halves of
16 bits); such a sub-bucket shares 46 of 64 bits and so holds at most 2**18
distinct fingerprints. Nothing is capped: both levels verify every pair.

Defined results: null, empty and all-space texts have fingerprint zero, which
links like any other. Repeated rows are repeated in the result. A null doc_id
counts as larger than any other; the component_id of a component without any
other id is null. Other columns are ignored (``simhash_groups``) or carried
unchanged (``drop_near_duplicates``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import checkpointed, checkpointed_by_size, in_few_tasks
from shoal.llm.graph import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BUCKET = 256
HOT = 500
SPREAD = 20_000  # fingerprints per task that makes their keys
_STEP = 255


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits of the XXH64 values of all word shingles."""
    words = (text or "").encode().lower().split()  # bytes.lower touches A-Z only
    if not words:
        return 0
    size = min(shingle, len(words))
    runs = zip(*(words[j:] for j in range(size)))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter(map(h, map(b" ".join, runs), repeat(SEED)), "<u8", len(words) - size + 1)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _STEP):  # 255 ones fit in a byte
        bits = np.unpackbits(hashes[i:i + _STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def _wild_keys(value: Column, bits: int, base: int) -> Column:
    """Keys of one segment: as it is (slot ``bits``) and with each single bit
    cleared, the slot number above the value."""
    return F.transform(F.sequence(F.lit(0), F.lit(bits)), lambda p: (
        (F.lit(base).cast("long") + p) * (1 << bits)
        + F.when(p == bits, value).otherwise(value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), p))))))


def _segments(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _is_link(a: np.ndarray, b: np.ndarray, slot: np.ndarray, distance: int) -> np.ndarray:
    """Within ``distance``, and differing at the wildcard of the shared key, so
    that pairs with an equal segment are met once and not under each wildcard."""
    x = a ^ b
    segment = (x >> (np.uint64(32) * (slot // np.uint64(33)))) & np.uint64(0xFFFFFFFF)
    at = slot % np.uint64(33)
    wanted = np.where(at == 32, np.uint64(0), np.uint64(1) << np.minimum(at, np.uint64(31)))
    return (np.bitwise_count(x) <= distance) & (segment == wanted)


def _forest(fp: np.ndarray, slot: np.uint64, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket, thinned to one towards the least connected member."""
    m = len(fp)
    label, step = np.arange(m), max(1, (1 << 20) // m)
    while True:
        new = label.copy()
        for i in range(0, m, step):
            near = _is_link(fp[i:i + step, None], fp[None, :], slot, distance)
            new[i:i + step] = np.minimum(new[i:i + step], np.where(near, label[None, :], m).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(m))
    return fp[rest], fp[label[rest]]


def _links(keys: np.ndarray, fp: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int):
    """Links of whole buckets. Those of up to 16 members are compared together,
    member with the next, then with the one after next, and so on."""
    slots = keys.view(np.uint64) >> np.uint64(32)
    first, second = [], []
    group = np.repeat(np.arange(len(starts)), sizes)
    small = np.repeat((sizes > 1) & (sizes <= 16), sizes)
    s_fp, s_group, s_slot = fp[small], group[small], slots[small]
    for gap in range(1, int(sizes[sizes <= 16].max(initial=1))):
        same = s_group[gap:] == s_group[:-gap]
        a, b = s_fp[gap:][same], s_fp[:-gap][same]
        ok = _is_link(a, b, s_slot[gap:][same], distance)
        first.append(a[ok])
        second.append(b[ok])
    for i in np.flatnonzero(sizes > 16):
        a, b = _forest(fp[starts[i]:starts[i] + sizes[i]], slots[starts[i]], distance)
        first.append(a)
        second.append(b)
    return np.concatenate([np.empty(0, np.uint64), *first]), np.concatenate([np.empty(0, np.uint64), *second])


def _bucket_mapper(distance: int, most: int | None):
    """Over rows (key[, sub], fp) sorted by key: rows (a, b, null) of links, and
    (fp, null, key) of each member of a bucket of more than ``most``. The memory
    held is one batch and one bucket."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, too_many = None, None

        def out(chunk: pd.DataFrame) -> pd.DataFrame:
            keys, fp = chunk["key"].to_numpy(), chunk["fp"].to_numpy().view(np.uint64)
            ids = chunk[[c for c in chunk.columns if c != "fp"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
            sizes = np.diff(np.r_[starts, len(keys)])
            large = sizes > (most or len(keys))
            a, b = _links(keys, fp, starts[~large], sizes[~large], distance) if not large.any() else (None, None)
            if a is None:
                keep = np.repeat(~large, sizes)
                k, f = keys[keep], fp[keep]
                z = sizes[~large]
                a, b = _links(k, f, np.cumsum(z) - z, z, distance)
                again, again_keys = fp[~keep], keys[~keep]
            else:
                again, again_keys = np.empty(0, np.uint64), np.empty(0, np.int64)
            none = np.zeros(len(again), np.int64)
            return pd.DataFrame({
                "a": np.r_[a.view(np.int64), again.view(np.int64)],
                "b": np.r_[b.view(np.int64), none],
                "key": np.r_[np.full(len(a), -1, np.int64), again_keys]})

        for batch in batches:
            if too_many is not None:  # the rest of a bucket already given out
                same = (batch["key"] == too_many).to_numpy()
                if same.any():
                    yield pd.DataFrame({"a": batch["fp"][same], "b": 0, "key": batch["key"][same]})
                batch = batch[~same]
            chunk = batch if held is None else pd.concat([held, batch], ignore_index=True)
            held = None
            if not len(chunk):
                continue
            names = [c for c in chunk.columns if c != "fp"]
            ids = chunk[names].to_numpy()
            last = int((ids != ids[-1]).any(axis=1).nonzero()[0].max(initial=-1)) + 1
            if last:
                yield out(chunk.iloc[:last])
            held = chunk.iloc[last:]
            if most and len(held) > most:
                too_many = held["key"].iloc[0]
                yield out(held)
                held = None
        if held is not None and len(held):
            yield out(held)

    return over


def _shared_buckets(df: DataFrame, *keys: str) -> DataFrame:
    """The rows (keys, fp) whose bucket has another member, whole buckets together and in
    order. Nearly every bucket holds one fingerprint; these never leave the JVM."""
    w = Window.partitionBy(*keys).orderBy("fp")
    others = df.withColumns({"_before": F.lag("fp").over(w), "_after": F.lead("fp").over(w)})
    return others.filter("_before is not null or _after is not null").select(*keys, "fp")


def _spread(fingerprints: DataFrame) -> DataFrame:
    """The distinct fingerprints dealt anew: as few bytes they come in few parts, but each
    becomes 66 rows."""
    parts = max(fingerprints.sparkSession.sparkContext.defaultParallelism, fingerprints.count() // SPREAD + 1)
    return fingerprints.repartition(parts, "fp")


def links(fingerprints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between the distinct values of column fp that connect
    whatever is within ``distance`` bits (three at most)."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments serve distances up to 3")
    schema = "a long, b long, key long"
    keyed = _spread(fingerprints).select("fp", F.explode(F.concat(
        _wild_keys(_segments(F.col("fp"), 0, 32), 32, 0),
        _wild_keys(_segments(F.col("fp"), 32, 32), 32, 33))).alias("key"))
    first = checkpointed_by_size(_shared_buckets(keyed.select("key", "fp"), "key").mapInPandas(_bucket_mapper(distance, bucket), schema))
    # what shares a key of one segment is indexed by the halves of the other
    other = F.when(F.shiftright("key", 32) < 33, _segments(F.col("a"), 32, 32)).otherwise(_segments(F.col("a"), 0, 32))
    again = (first.filter("key >= 0").select("key", F.col("a").alias("fp"), other.alias("o"))
             .select("key", "fp", F.explode(F.concat(
                 _wild_keys(_segments(F.col("o"), 0, 16), 16, 0), _wild_keys(_segments(F.col("o"), 16, 16), 16, 17))).alias("sub"))
             .select("key", "sub", "fp"))
    second = _shared_buckets(again, "key", "sub").mapInPandas(_bucket_mapper(distance, None), schema)
    return first.filter("key = -1").select("a", "b").unionByName(second.select("a", "b"))


def _component_ids(rows: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id, root, copies) of the rows (doc_id, fp); root is the
    least fingerprint of the component."""
    distinct = checkpointed(in_few_tasks(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))))
    roots = checkpointed(in_few_tasks(components(links(distinct.select("fp"), distance))))
    joined = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "least")
    own = joined.groupBy("root").agg(F.min("least").alias("component"))
    linked = joined.join(own, "root").select(F.col("fp").alias("fp_"), "root", "component")
    single = F.col("fp_").isNull()
    return (distinct.join(linked, F.col("fp") == F.col("fp_"), "left")
            .select("fp", F.when(single, F.col("least")).otherwise(F.col("component")).alias("component_id"),
                    F.coalesce("root", "fp").alias("root"), "copies"))


def _with_components(rows: DataFrame, distance: int) -> DataFrame:
    """``rows`` with component_id and root. The fingerprints of over 1/``HOT`` of
    all rows, fewer than ``HOT``, are broadcast, so a hot one is not shuffled."""
    ids = checkpointed(in_few_tasks(_component_ids(rows, distance).withColumnRenamed("fp", "fp_")))
    most = rows.count() // HOT
    hot = F.broadcast(ids.filter(F.col("copies") > most))
    match = F.col("fp") == F.col("fp_")
    rest = rows.join(hot, match, "left_anti").join(ids.filter(F.col("copies") <= most), match)
    return rows.join(hot, match).unionByName(rest).drop("fp_", "copies")


def simhash_groups(documents: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id."""
    rows = checkpointed_by_size(documents.select("doc_id", _fingerprints("text").alias("fp")))
    return (_with_components(rows, distance).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_duplicates(documents: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The row of least doc_id of each component; of rows with that id, the one
    whose text hash is least, and of equal rows one."""
    digest = F.xxhash64("text")
    rows = checkpointed_by_size(documents.select("doc_id", digest.alias("digest"), _fingerprints("text").alias("fp")))
    kept = (_with_components(rows, distance).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min("component_id").alias("_id"), F.min("digest").alias("_digest"))
            .select("_id", "_digest"))
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    keys = held.select("_row", F.col("_row.doc_id").alias("_doc"), F.xxhash64("_row.text").alias("_hash"))
    return (keys.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_digest")), "left_semi")
            .dropDuplicates(["_doc", "_hash"]).select("_row.*"))
