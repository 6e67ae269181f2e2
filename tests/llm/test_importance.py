"""Importance resampling against plain checksums and sums."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoal.llm import importance as I
from tests.llm.helpers import SMALL, awkward, documents, prose


def brute_buckets(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(rows, target):
    docs = [(d, *brute_buckets(t)) for d, t in rows]
    s, t = Counter(b for *_, f in docs for b in f), Counter(b for x in target for b in brute_buckets(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (n_s + 10000.0) / ((s[b] + 1.0) * (n_t + 10000.0))))
    out = []
    for d, n, f in docs:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = [(x[0], x[2], x[3], x[4], i + 1) for i, x in enumerate(fit[:5 * len(fit) // 100])]
    rest = [(x[0], x[2], x[3], x[4], None) for x in fit[5 * len(fit) // 100:]] + [(x[0], x[2], x[3], x[4], None) for x in out if x[1] < 20]
    return drawn + rest


def same(got, want):
    as_row = lambda r: tuple(map(str, r))
    assert sorted(map(as_row, got)) == sorted(map(as_row, want))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(1, 900)), min_size=1, max_size=30), st.integers(0, 5))
def test_span_checksums(spans, seed):
    data = np.random.default_rng(seed).integers(0, 256, 1300).astype(np.uint8)
    start = np.array([a for a, _ in spans])
    end = start + np.array([n for _, n in spans])
    assert I.crc_spans(data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]


def test_very_long_spans():
    data = np.random.default_rng(1).integers(0, 256, 6_000_000).astype(np.uint8)
    start, end = np.array([0, 5, 100, 5_999_990]), np.array([6_000_000, 1_000_003, 101, 6_000_000])
    assert I.crc_spans(data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aZ9 é.\n\U0001f600", max_size=30), max_size=6))
def test_features_of_texts(texts):
    words, whose, codes = I.features([t.encode() for t in texts])
    for i, t in enumerate(texts):
        n, want = brute_buckets(t)
        assert words[i] == n and sorted(codes[whose == i].tolist()) == sorted(want)


def target(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_small_table_and_ties(spark):
    rows = [(i, prose(20 + i % 60, i % 150)) for i in range(300)] + [(7, prose(30, 7)), (7, prose(30, 7)), (400, prose(19, 3)), (None, prose(40, 1))]
    items = [prose(50, 5), None, ""]
    same(I.importance_ranks(documents(spark, rows, clash=True), target(spark, items)).collect(), brute(rows, items))


def test_awkward_rows_and_empty_tables(spark):
    rows = [r[:2] for r in awkward()] * 3
    same(I.importance_ranks(documents(spark, awkward() * 3), target(spark, [])).collect(), brute(rows, []))
    assert I.importance_ranks(documents(spark, []), target(spark, ["one"])).collect() == []
    assert I.resampled(documents(spark, []), target(spark, ["one"])).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_ranks_over_many_ranges(spark, parts):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = I.importance_ranks(df.repartition(parts), bench, 50).filter("rank is not null").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert [(-r["score"], r["doc_id"]) for r in got] == sorted((-r["score"], r["doc_id"]) for r in got)


def test_drawn_rows_resemble_the_target(spark):
    other = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, prose(60, i, other if i % 10 == 0 else None or I_WORDS)) for i in range(400)]
    df = documents(spark, rows, clash=True)
    got = I.resampled(df, target(spark, [prose(200, 900 + i, other) for i in range(5)]))
    assert got.columns == df.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == 20 and sum(i % 10 == 0 for i in ids) >= 18


I_WORDS = "river stone amber lantern window garden copper meadow silver harbor".split()
