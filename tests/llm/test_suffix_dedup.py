"""Repeated byte strings against a count of all strings."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from shoal.llm import suffix_dedup as S
from tests.llm.helpers import SMALL, awkward, documents, prose


def brute(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        c = (np.cumsum(cover) > 0)[:len(d)]
        kept = np.frombuffer(d, np.uint8)[~c].tobytes()
        runs = int((np.diff(np.r_[0, c.astype(int)]) > 0).sum())
        out.append((len(d), int(c.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(rows, got, length=200):
    want = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], length))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def hard():
    r = np.random.default_rng(1)
    base = "".join(r.choice(list("abc"), 3000))
    texts = ["a" * 1000, "ab" * 400, "a" * 250, "x" + "ab" * 200, None, "", "a" * 199, "b" * 200, base[:700],
             base[300:900] + "q" + base[1000:1250], base[100:299], base[100:300], base[2000:2201] * 2, "é" * 150 + base[2500:2700]]
    texts += ["z" + base[i:i + int(r.integers(150, 400))] for i in r.integers(0, 2500, 30)]
    return [(i, t) for i, t in enumerate(texts)]


def test_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in df.collect()], S.repeats(df).collect())


def test_periodic_and_overlapping_texts(spark):
    check(hard(), S.repeats(documents(spark, hard())).collect())


@pytest.mark.parametrize("length", [40, 64, 333])
def test_other_lengths(spark, length):
    check(hard(), S.repeats(documents(spark, hard()), length).collect(), length)


def test_pieces_of_long_texts_and_large_blocks(spark, monkeypatch):
    """Tiny shards, and blocks that are given out in parts."""
    monkeypatch.setattr(S, "_SHARD", 700)
    monkeypatch.setattr(S, "_MOST", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        check(hard(), S.repeats(documents(spark, hard())).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 50_000] + [(20, prose(3000, 9)), (21, "z" + prose(3000, 9))]
    check(rows, S.repeats(documents(spark, rows, clash=True)).collect())


def test_empty_table(spark):
    assert S.repeats(documents(spark, [])).collect() == []


def test_texts_without_their_repeats(spark):
    rows = [(1, "start " + prose(60, 3)), (2, "other start, " + prose(60, 3) + " end"), (3, "short"), (4, None)]
    got = S.drop_repeats(documents(spark, rows, clash=True))
    assert got.columns == documents(spark, rows, clash=True).columns
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[3] == "short" and texts[4] is None and len(texts[1]) < 10 and texts[2].endswith(" end")


def test_anchors_depend_on_the_bytes_of_a_string_alone():
    r = np.random.default_rng(2)
    a, b = (r.integers(97, 100, 2000).astype(np.uint8) for _ in range(2))
    b[700:1300] = a[200:800]
    owner = {}
    for k, d in enumerate((a, b)):
        at, lo, hi = S.anchors(d, np.array([0]), np.array([len(d)]), 200)
        owner[k] = {i: int(x) - i for x, p, q in zip(at, lo, hi) for i in range(p, q + 1)}
    assert all(owner[0][200 + i] == owner[1][700 + i] for i in range(401))
