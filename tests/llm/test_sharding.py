"""Shards: balance, groups, slots."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from shoal.llm import sharding as H
from tests.llm.helpers import awkward, documents, prose


def check(rows, got, shards=8):
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_balance_of_all_three(spark):
    rows = [(i, prose(10 + (i * 37) % 300, i + 1)) for i in range(2500)]
    got = H.shard_table(documents(spark, rows)).collect()
    check(rows, got)
    for what in (lambda r: r["size"], lambda r: r["tokens"], lambda r: 1):
        sums = np.bincount([r["shard"] for r in got], [what(r) for r in got], 8)
        assert sums.max() / sums.mean() < 1.02 and sums.min() / sums.mean() > 0.98


def test_equal_texts_stay_together_and_hot_ones_are_split(spark):
    rows = [(i, prose(50, i % 200 + 1)) for i in range(1000)] + [(5000 + i, prose(50, 999)) for i in range(600)]
    got = H.shard_table(documents(spark, rows)).collect()
    check(rows, got)
    text = dict((d, t) for d, t in rows)
    where = defaultdict(set)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
    hot = where.pop(prose(50, 999))
    assert all(len(v) == 1 for v in where.values()) and len(hot) > 1
    sums = np.bincount([r["shard"] for r in got], [r["size"] for r in got], 8)
    assert sums.max() / sums.mean() < 1.05


def test_pack_prefers_the_highest_dot_product_with_room():
    items = np.array([[0.3, 0.0, 0.0], [0.2, 0.0, 0.0], [0.0, 0.4, 0.4], [0.1, 0.1, 0.1]])
    residual = np.full((2, 3), 0.5)
    order = [2, 0, 1, 3]
    for i in order:
        left = residual - items[i]
        fits = (left >= 0).all(axis=1)
        k = int(np.where(fits, residual @ items[i], -np.inf).argmax()) if fits.any() else int(left.min(axis=1).argmax())
        assert H.pack(items, 2)[i] == k
        residual[k] -= items[i]


def test_awkward_rows(spark):
    rows = [r for r in awkward()]
    check(rows, H.shard_table(documents(spark, rows, clash=True)).collect())


def test_empty_table(spark):
    assert H.shard_table(documents(spark, [])).collect() == []


def test_written_shards_hold_every_row(spark, tmp_dir):
    rows = [(i, prose(30, i + 1)) for i in range(200)] + [(None, None), (7, "")]
    df = documents(spark, rows)
    H.write_shards(df, f"{tmp_dir}/shards", files=2)
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.drop("_shard").exceptAll(df).count() == 0 and back.count() == len(rows)
    planned = {r["doc_id"]: r["shard"] for r in H.shard_table(df).collect()}
    assert all(planned[r["doc_id"]] == r["_shard"] for r in back.select("doc_id", F.col("_shard")).collect())


def test_a_third_of_the_rows_is_one_repeated_row(spark):
    rows = [(i, prose(50, i + 1)) for i in range(2000)] + [(None, prose(50, 9999))] * 1000
    got = H.shard_table(documents(spark, rows)).collect()
    check(rows, got)
    sums = np.bincount([r["shard"] for r in got], [r["size"] for r in got], 8)
    assert sums.max() / sums.mean() < 1.1
