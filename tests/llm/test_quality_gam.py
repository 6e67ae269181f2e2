"""The additive model: held-out accuracy, additivity, awkward rows."""

import zlib

import numpy as np
import pytest

from shoal.llm import quality_gam as G
from tests.llm.helpers import awkward, documents, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = G.quality_scores(docs, labels).collect()
    return got, {r["doc_id"]: r["quality"] for r in labels.collect()}, docs.count()


def test_held_out_labels(scored):
    got, labels, n = scored
    assert len(got) == n
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([(s >= 0.7) == (y == 1) for s, y in held]) > 0.93
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = G.fit(docs, labels), G.fit(docs, flipped)
    assert all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_scores_are_sums_of_table_entries():
    r = np.random.default_rng(1)
    x = r.random((900, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)  # an interaction of two features
    m = G.train(x, y)
    assert (0, 1) in m.pairs
    p = m.score(x)
    assert np.mean((p > 0.5) == (y > 0.5)) > 0.97
    for row, got in zip(x[:20], p):
        total = m.base + sum(t[np.searchsorted(c, v, "right")] for t, c, v in zip(m.tables, m.cuts, row))
        for (a, b), t in m.pairs.items():
            total += t[np.searchsorted(m.coarse[a], row[a], "right"), np.searchsorted(m.coarse[b], row[b], "right")]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_awkward_rows(spark):
    rows = [r for r in awkward()]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, None, 1), (None, 1, 0), (9, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    got = G.quality_scores(documents(spark, rows, clash=True), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(str(r["doc_id"]), set()).add(r["score"])
    assert len(by["9"]) == 1 and not [r for r in got if r["doc_id"] is None and r["held_out"]]


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in G.quality_scores(documents(spark, [(1, "a"), (2, prose(30))]), none).collect()} == {0.5}
    assert G.quality_scores(documents(spark, []), none).collect() == []


def test_features_of_whole_texts():
    a = G.text_features(prose(20_000, 2))
    b = G.text_features(prose(20_000, 2) + "!!!")
    assert a != b and len(a) == len(G.FEATURES) and np.isfinite(G.text_features(None)).all()
