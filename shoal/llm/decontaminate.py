"""Benchmark leaks by latent semantic retrieval, verified word by word.

Fit: the words of the benchmark are weighted by their inverse document frequency
over all documents. The benchmark's passages, and with a small weight every passage
of every distinct text of the corpus, are rows of a TF-IDF matrix whose leading right
singular vectors come from randomised subspace iteration: every iteration is one Spark
job that adds up A'(AZ) over the rows. However many texts there are, they weigh as much
as ``CORPUS_TEXTS`` texts of the weight ``CORPUS_WEIGHT``, so that a larger corpus does not
drown the benchmark. The corpus is tokenised once for it, into the numbers of its known words.

Search: a text is cut into blocks of 8 words. Every run of 2, 4, 8 or 16 blocks is a
passage; as the projection is linear its latent vector is the sum of those of
its blocks. A benchmark passage is compared with all text passages of the least
length that holds it wherever it starts. Other words around it add to the overlap (the part of
the text passage along the benchmark passage) and take nothing from it, so no cosine is asked for:
where the overlap reaches ``SLACK`` of what the least weighty words that ``COMMON`` allows
leave, the words around are compared: the longest common subsequence must hold ``COMMON`` of the benchmark
passage, and of its answer (its last ``ANSWER`` words) ``ANSWERED``.

The overlap decides and not the cosine, which the words around a passage lower. Of 1,700
items between words of other items, all of them in one block of rank ``RANK``, the overlap finds 1.00
of the verbatim copies and 0.97 of those with 28 % of their words changed; 0.97 and 0.77
of them also have a cosine of 0.65 (``test_recall_beyond_the_rank``).

Scale: a task holds the latent basis of one block of ``BLOCK_ITEMS`` benchmark
passages (bounded), and in the fit a sum of its size; there is one sum a core, eight are added in one task. A benchmark of one block is searched in one pass over the
documents, which are not shuffled. Larger ones are searched block by block: one
index at a time is made, its leaks are written to the shared folder, and it is freed;
``drop_leaks`` then writes the digests of leaking texts and drops these texts by a join.

Defined results: null and empty texts have no passage. A benchmark item without
a word leaks nowhere; one of fewer than ``SHORT`` words only where all its words
stand in order. Items longer than 64 words are several passages, any one
of which is a leak. Repeated rows are judged alike; equal items are each reported.
Other columns are ignored (``leaks``) or carried unchanged (``drop_leaks``).
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoal.llm.common import checkpointed, shared_path

BLOCK = 8
RUNS = (2, 4, 8, 16)
PASSAGE = 64
RANK = 128
CORPUS_TEXTS = 2000
CORPUS_WEIGHT = 0.05
BLOCK_ITEMS = 4096
SLACK = 0.9
COMMON = 0.7
ANSWER = 6
ANSWERED = 0.5
SHORT = 8
_SEGMENT = 4096
_GROUP_BYTES = 1 << 19
_GROUP_NUMBERS = 1 << 20
_DENSE_ROWS = 32
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
LEAK = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
    T.StructField("common", T.DoubleType()), T.StructField("answer", T.DoubleType())]))


def _folded(text: str | None) -> bytes:
    """The words and spaces of a text."""
    return (text or "").lower().encode().translate(_FOLD)


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits (of ASCII; all other code points
    count as letters)."""
    return _folded(text).split()


def _with_spaces(vocabulary: list[bytes]) -> pa.Array:
    return pa.array([w + b" " for w in vocabulary], pa.large_binary())


def _numbers(group: list[bytes], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The place in the vocabulary (:func:`_with_spaces`) of every word of the folded texts, -1 for others, and the number of words of each text."""
    text = np.frombuffer(b" ".join([*group, b""]), np.uint8)
    space = text == 32
    before = np.r_[True, space[:-1]]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    bounds = np.cumsum(np.r_[0, ends - starts + 1])  # a word and one space after it
    each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text[~(space & before)])])
    at = pc.index_in(each, value_set=vocabulary).fill_null(-1)
    until = np.searchsorted(ends, np.cumsum([len(x) + 1 for x in group]))
    return at.to_numpy().astype(np.int64), np.diff(until, prepend=0)


def passages(items: list[tuple[int, str | None]]) -> list[tuple[int, list[bytes]]]:
    """(item_id, words) of each item, long items in overlapping passages."""
    size = PASSAGE
    out = []
    for item, text in items:
        w = words(text)
        for at in range(0, max(1, len(w) - size // 4), size * 3 // 4):
            if w[at:at + size]:
                out.append((item, w[at:at + size]))
    return out


def known_words(documents: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """One row per distinct text: the rows that have it (copies) and its passages of ``PASSAGE`` words,
    as bytes: the numbers of the known words of each, every word once (ids), how often each stands there
    (tf) and how many there are (sizes; passages without a known word are left out)."""
    many, kind, size, spaced = len(vocabulary), _kind(len(vocabulary)), PASSAGE, _with_spaces(vocabulary)

    def of_group(group: list[bytes]) -> tuple[list[bytes], list[bytes], list[bytes]]:
        at, length = _numbers(group, spaced)
        passages_of = -(-length // size)
        first = np.cumsum(passages_of) - passages_of
        passage = np.repeat(first, length) + (np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)) // size
        held, tf = np.unique((passage * many + at)[at >= 0], return_counts=True)
        passage, ids = np.divmod(held, many)
        sizes = np.bincount(passage, minlength=int(passages_of.sum()))
        bounds = np.r_[0, np.cumsum(sizes)]
        ids, tf, sizes = ids.astype(kind), tf.astype(np.uint8), sizes.astype(np.uint8)
        ends = first + passages_of
        spans = list(zip(bounds[first].tolist(), bounds[ends].tolist()))
        kept = [sizes[lo:hi] for lo, hi in zip(first.tolist(), ends.tolist())]
        return [ids[lo:hi].tobytes() for lo, hi in spans], [tf[lo:hi].tobytes() for lo, hi in spans], [x[x > 0].tobytes() for x in kept]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes, group, held = b["text_hash"].to_numpy(), [], 0
            for i, text in enumerate(b["text"], 1):
                group.append(_folded(text))
                held += len(group[-1])
                if held >= _GROUP_BYTES or i == len(b):
                    ids, tf, sizes = of_group(group)
                    yield pd.DataFrame({"text_hash": hashes[i - len(group):i], "ids": ids, "tf": tf, "sizes": sizes})
                    group, held = [], 0

    rows = (documents.select(F.xxhash64("text").alias("text_hash"), "text")
            .mapInPandas(encode, "text_hash long, ids binary, tf binary, sizes binary"))
    return checkpointed(rows.groupBy("text_hash").agg(
        F.count(F.lit(1)).alias("copies"), F.first(F.struct("ids", "tf", "sizes")).alias("held")).select("copies", "held.*"))


def _kind(n: int) -> type:
    """The type of ``n`` numbers of words."""
    return np.uint16 if n <= 1 << 16 else np.uint32


def _in_a_task_per_core(df: DataFrame) -> DataFrame:
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of arrays of ``size`` doubles (m), one a core and a few more. Eight or so are added up in one task; the driver gets one."""

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for b in batches:
            for m in b["m"]:
                total += np.frombuffer(m)
        yield pd.DataFrame({"m": [total.tobytes()]})

    n = -(-parts.sparkSession.sparkContext.defaultParallelism // 8)
    while n > 1:
        parts, n = parts.repartition(n).mapInPandas(added, "m binary"), -(-n // 8)
    return np.frombuffer(parts.repartition(1).mapInPandas(added, "m binary").first()["m"])


def document_frequencies(corpus: DataFrame, many: int) -> tuple[np.ndarray, int, int]:
    """Documents that hold each of ``many`` words, the number of documents and that of distinct texts, from :func:`known_words`."""
    kind = _kind(many)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(many + 2)
        for b in batches:
            for ids, copies in zip(b["ids"], b["copies"]):
                n[np.frombuffer(ids, kind)] += copies  # once, however many passages hold the word
            n[many:] += b["copies"].sum(), len(b)
        yield pd.DataFrame({"m": [n.tobytes()]})

    n = _added(_in_a_task_per_core(corpus.select("ids", "copies")).mapInPandas(count, "m binary"), many + 2)
    return n[:many], int(n[many]), int(n[many + 1])


def _gram_times(ids: np.ndarray, tf: np.ndarray, sizes: np.ndarray, weights: np.ndarray, z: np.ndarray) -> np.ndarray:
    """A'(AZ) in the precision of ``z``, the rows of A being unit TF-IDF vectors of passages: ``sizes`` words each, as in
    :func:`known_words`. ``_DENSE_ROWS`` rows at a time are one dense matrix over the words that they hold."""
    total = np.zeros_like(z)
    last = np.empty(len(z), np.intp)
    row = np.repeat(np.arange(len(sizes)), sizes)
    v = tf * weights.take(ids)
    v /= np.sqrt(np.bincount(row, v * v, len(sizes))).take(row)
    v = v.astype(z.dtype)
    bounds = np.r_[0, np.cumsum(sizes)].tolist()
    for r in range(0, len(sizes), _DENSE_ROWS):
        rows = min(_DENSE_ROWS, len(sizes) - r)
        here = slice(bounds[r], bounds[r + rows])
        at, order = ids[here], np.arange(bounds[r + rows] - bounds[r])
        last[at] = order
        stands = last.take(at)  # one place for all places of a word
        one = stands == order
        at = at[one]
        a = np.zeros((rows, len(at)), z.dtype)
        a[row[here] - r, (np.cumsum(one) - 1).take(stands)] = v[here]
        added = a.T @ (a @ z.take(at, axis=0))
        added += total.take(at, axis=0)
        total[at] = added
    return total


def latent_basis(rows: DataFrame, weights: np.ndarray, rank: int, iterations: int = 3, seed: int = 11,
                 corpus: DataFrame | None = None, corpus_weight: float = 1.0, precision: type = np.float32) -> np.ndarray:
    """(words, rank): leading right singular vectors of the rows (ids, weight), each the unit TF-IDF
    vector of its words times its weight, and of all passages of ``corpus``
    (:func:`known_words`) with their weight, which are multiplied in ``precision`` and added up in doubles."""
    kind = _kind(len(weights))

    def gram_times(z: np.ndarray) -> np.ndarray:
        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(z)
            for b in batches:
                for ids, weight in zip(b["ids"], b["weight"]):
                    at, tf = np.unique(np.asarray(ids, np.int64), return_counts=True)
                    v = tf * weights[at]
                    if norm := np.linalg.norm(v):
                        v = v * (weight / norm)
                        total[at] += np.outer(v, v @ z[at])
            yield pd.DataFrame({"m": [total.tobytes()]})

        def of_corpus(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, z_here = np.zeros_like(z), z.astype(precision)
            for b in batches:
                for _, some in b.groupby(b["tf"].map(len).cumsum() // _GROUP_NUMBERS):
                    ids, tf, sizes = (np.frombuffer(b"".join(some[c]), t) for c, t in (("ids", kind), ("tf", np.uint8), ("sizes", np.uint8)))
                    total += _gram_times(ids.astype(np.intp), tf, sizes.astype(np.intp), weights, z_here)
            total *= corpus_weight ** 2
            yield pd.DataFrame({"m": [total.tobytes()]})

        parts = rows.coalesce(8).mapInPandas(partial, "m binary")
        if corpus is not None:
            parts = parts.unionByName(_in_a_task_per_core(corpus.select("ids", "tf", "sizes")).mapInPandas(of_corpus, "m binary"))
        return _added(parts, z.size).reshape(z.shape)

    width = min(rank + 16, len(weights))
    z = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(weights), width)))[0]
    for _ in range(iterations):
        z = np.linalg.qr(gram_times(z))[0]
    values, u = np.linalg.eigh(z.T @ gram_times(z))
    keep = np.argsort(-values)[:rank]
    return z @ u[:, keep[values[keep] > 1e-9]]


def _least_share(weights: list[float], ws: list[bytes]) -> float:
    """The least share of a passage's squared norm that words enough for a leak hold."""
    tf = Counter(ws)
    v = np.sort([x * x * tf[w] for x, w in zip(weights, ws)])
    return v[:math.ceil(COMMON * len(ws) - 1e-9)].sum() / v.sum() if len(ws) >= SHORT else 1.0


class Index:
    """Latent vectors of benchmark passages, and the search over texts."""

    def __init__(self, items, vocabulary, weights, basis):
        self.items = items
        number = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.vocabulary = _with_spaces(vocabulary)
        self.numbers = [[number[w] for w in ws] for _, ws in items]
        self.rows = np.vstack([np.zeros(basis.shape[1]), basis * weights[:, None]]).astype(np.float32)
        latent = np.array([self.rows[at].sum(axis=0) for at in self.numbers], np.float32)
        self.norm = np.linalg.norm(latent, axis=1)
        latent /= np.maximum(self.norm, 1e-12)[:, None]
        share = np.array([_least_share([weights[number[w] - 1] for w in ws], ws) for _, ws in items])
        self.least = np.maximum(SLACK * share * self.norm, 1e-9).astype(np.float32)
        size = np.array([len(ws) for _, ws in items]) + BLOCK - 1  # whatever word of a block it starts at
        least = [0, *(BLOCK * r for r in RUNS[:-1])]
        self.of_run = [np.flatnonzero((size > lo) & (size <= BLOCK * r)) for lo, r in zip(least, RUNS)]
        self.latent = [np.ascontiguousarray(latent[at].T) for at in self.of_run]

    def search(self, texts) -> list[list[tuple]]:
        out: list[list[tuple]] = []
        group, size = [], 0
        for text in texts:
            group.append(_folded(text))
            size += len(group[-1])
            if size >= _GROUP_BYTES:
                out += self._search_group(group)
                group, size = [], 0
        return out + self._search_group(group)

    def _candidates(self, numbers: np.ndarray, length: np.ndarray) -> dict[tuple[int, int], list[tuple[float, int, int]]]:
        """(document, passage) -> (cosine, first block, blocks) where the overlap is enough."""
        starts = np.cumsum(np.r_[0, -(-length // BLOCK) + RUNS[-1]])  # empty blocks keep texts apart
        ids = np.zeros((int(starts[-1]), BLOCK), np.int64)
        ids.reshape(-1)[np.repeat(starts[:-1] * BLOCK - np.cumsum(length) + length, length) + np.arange(len(numbers))] = numbers
        found: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
        for s in range(0, len(ids), _SEGMENT):
            part = np.ascontiguousarray(ids[s:s + _SEGMENT + RUNS[-1] - 1].T)
            run = self.rows.take(part[0], axis=0)
            taken = np.empty_like(run)
            for of_word in part[1:]:
                run += self.rows.take(of_word, axis=0, out=taken, mode="clip")
            length = 1
            for r, of_run, latent in zip(RUNS, self.of_run, self.latent):
                while length < r:
                    run = run[:-length] + run[length:] if len(run) > length else run[:0]
                    length *= 2
                if not len(of_run) or not len(run):
                    continue
                here = run[:_SEGMENT]
                along = here @ latent
                b, k = np.divmod(np.flatnonzero(along >= self.least[of_run]), len(of_run))
                cosine = along[b, k] / np.linalg.norm(here[b], axis=1)
                k = of_run[k]
                docs = np.searchsorted(starts, s + b, "right") - 1
                for doc, k_, c, first in zip(docs.tolist(), k.tolist(), cosine.tolist(), (s + b - starts[docs]).tolist()):
                    found.setdefault((doc, k_), []).append((c, first, r))
        return found

    def _search_group(self, group: list[bytes]) -> list[list[tuple]]:
        best: list[dict[int, tuple]] = [{} for _ in group]
        held: dict[int, set[int]] = {}
        texts: dict[int, list[bytes]] = {}
        if group and self.items:
            numbers, length = _numbers(group, self.vocabulary)
            numbers += 1
            ends = np.cumsum(length)
            for (doc, k), runs in self._candidates(numbers, length).items():
                item, ws = self.items[k]
                needed = COMMON if len(ws) >= SHORT else 1.0
                if doc not in held:
                    held[doc] = set(numbers[ends[doc] - length[doc]:ends[doc]].tolist())
                if sum(map(held[doc].__contains__, self.numbers[k])) < needed * len(ws):  # no less than in any part of the text
                    continue
                if doc not in texts:
                    texts[doc] = group[doc].split()
                for cosine, first, blocks in sorted(runs, reverse=True):
                    around = texts[doc][max(0, (first - 1) * BLOCK):(first + blocks + 1) * BLOCK]
                    if sum(map(set(around).__contains__, ws)) < needed * len(ws):  # no less than the subsequence
                        continue
                    common = common_words(ws, around) / len(ws)
                    if common < needed:
                        continue
                    answer = ws[-ANSWER:]
                    answered = common_words(answer, around) / len(answer)
                    if answered >= ANSWERED:
                        best[doc][item] = max(best[doc].get(item, (item, 0.0, 0.0, 0.0)), (item, cosine, common, answered), key=lambda x: x[2])
                        break
        return [sorted(b.values()) for b in best]


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence (bit-parallel, Hyyrö 2004)."""
    at: dict[bytes, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def fit(documents: DataFrame, items: list[tuple[int, str | None]], rank: int = RANK) -> Index | None:
    """The index of one block of benchmark items; None if they hold no word."""
    known = passages(items)
    if not known:
        return None
    vocabulary = sorted({w for _, ws in known for w in ws})
    corpus = known_words(documents, vocabulary)
    df, n, texts = document_frequencies(corpus, len(vocabulary))
    weights = np.log((n + 1) / (1 + df)) + 1e-3
    number = {w: i for i, w in enumerate(vocabulary)}
    spark = documents.sparkSession
    own = spark.createDataFrame([([number[w] for w in ws], 1.0) for _, ws in known], "ids array<int>, weight double")
    own = checkpointed(own.coalesce(1))  # few rows: one sum
    weight = CORPUS_WEIGHT * math.sqrt(min(1.0, CORPUS_TEXTS / max(texts, 1)))
    precision = np.float32 if texts > CORPUS_TEXTS else np.float64  # half the time of doubles, where there is much to add up
    basis = latent_basis(own, weights, min(rank, len(vocabulary)), corpus=corpus, corpus_weight=weight, precision=precision)
    return Index(known, vocabulary, weights, basis)


def _searcher(index: Index):
    @F.pandas_udf(LEAK)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series(index.search(texts))

    return search


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of at most ``BLOCK_ITEMS``, one held at a time."""
    block: list = []
    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        block.append((r["item_id"], r["text"]))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def _searched(documents: DataFrame, benchmark: DataFrame, text: Column) -> Column | None:
    """The leaks of a text, where the benchmark is one block; else null."""
    first = [(r["item_id"], r["text"]) for r in benchmark.select("item_id", "text").limit(BLOCK_ITEMS + 1).collect()]
    if len(first) > BLOCK_ITEMS:
        return None
    index = fit(documents, first)
    return _searcher(index)(text) if index else F.array().cast(LEAK)


def _written(documents: DataFrame, benchmark: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` and the leaks (_leak) of every text that leaks, from one written table per block."""
    spark = documents.sparkSession
    base = shared_path(spark, f"leaks-{uuid.uuid4().hex}")
    for i, block in enumerate(_blocks(benchmark)):
        index = fit(documents, block)
        if index:
            rows = documents.select(*columns, F.explode(_searcher(index)(F.col("text"))).alias("_leak"))
            rows.write.parquet(f"{base}/block={i}")
            del index, rows
    none = documents.select(*columns, F.lit(None).cast(LEAK.elementType).alias("_leak")).limit(0)
    none.write.parquet(f"{base}/block=-1")
    return spark.read.parquet(base).drop("block")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that leaks into it: doc_id,
    item_id, cosine, and the shares of the item and its answer that are held."""
    found = _searched(documents, benchmark, F.col("text"))
    rows = (documents.select("doc_id", F.explode(found).alias("_leak")) if found is not None
            else _written(documents, benchmark, F.col("doc_id")))
    return rows.select("doc_id", "_leak.*")


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` into which no benchmark item leaks."""
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"))
    found = _searched(documents, benchmark, F.col("_row.text"))
    if found is not None:
        return held.withColumn("_leaks", found).filter(F.size("_leaks") == 0).select("_row.*")
    leaking = _written(documents, benchmark, F.md5("text").alias("_digest")).select("_digest").distinct()
    return held.withColumn("_md5", F.md5("_row.text")).join(leaking, F.col("_md5") == F.col("_digest"), "left_anti").select("_row.*")
