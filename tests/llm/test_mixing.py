"""Mixing weights and drawn copies against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.llm import mixing as M
from tests.llm.helpers import awkward, documents, prose


def table(spark):
    rows, n = [], 0
    for source, count in (("big", 400), ("mid", 120), ("small", 40), ("tiny", 8)):
        for _ in range(count):
            rows.append((n, prose(20 + n % 50, n + 1), "en", source))
            n += 1
    return documents(spark, rows), rows


def totals(rows):
    t = {}
    for _, text, _, source in rows:
        t[source] = t.get(source, 0) + len((text or "").split())
    return t


def weights(t, a):
    n = sum(t.values())
    w = {s: (x / n) ** a for s, x in t.items()}
    z = sum(w.values())
    return {s: x / z for s, x in w.items()}


def test_repeat_limit_is_met_by_bisection(spark):
    df, rows = table(spark)
    t = totals(rows)
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        w = weights(t, mid)
        ratio = max(w[s] / t[s] for s in t) / min(w[s] / t[s] for s in t)
        lo, hi = (lo, mid) if ratio <= 3 else (mid, hi)
    src = M.source_tokens(df.select("source", M.tokens(F.col("text")).alias("tokens")))
    assert M.find_exponent(src, repeats=3.0) == pytest.approx(hi, abs=1e-6)


def test_entropy_target(spark):
    df, rows = table(spark)
    src = M.source_tokens(df.select("source", M.tokens(F.col("text")).alias("tokens")))
    a = M.find_exponent(src, entropy=0.8)
    w = weights(totals(rows), a)
    assert -sum(x * math.log(x) for x in w.values()) / math.log(4) == pytest.approx(0.8, abs=1e-6)
    assert M.find_exponent(src, entropy=0.1) == 1.0
    assert M.find_exponent(src, entropy=1.0) == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError):
        M.find_exponent(src)


@pytest.mark.parametrize("budget", [None, 3000])
def test_drawn_tokens_meet_the_weights(spark, monkeypatch, budget):
    monkeypatch.setattr(M, "BLOCK_ROWS", 8)  # many blocks
    df, rows = table(spark)
    got = M.mix_plan(df, repeats=3.0 if budget is None else 2.0, budget=budget).collect()
    t = totals(rows)
    w = weights(t, got[0]["exponent"])
    drawn = budget or max(t[s] / w[s] for s in t)
    longest = 70
    for s in t:
        mine = [r for r in got if r["source"] == s]
        assert all(r["weight"] == pytest.approx(w[s]) for r in mine)
        assert abs(sum(r["tokens"] for r in mine) - drawn * w[s]) <= longest
        copies = np.bincount([r["doc_id"] for r in mine], minlength=1)
        used = [copies[d] if d < len(copies) else 0 for d, _, _, x in rows if x == s]
        assert max(used) - min(used) <= 1  # whole passes, and one partial
        if budget is None:
            assert min(used) >= 1
        assert sorted(r["epoch"] for r in mine) == sorted(e for u in used for e in range(u))


def test_partial_pass_is_a_prefix_of_the_permutation(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 8)
    df, rows = table(spark)
    got = M.mix_plan(df, repeats=2.0, budget=2000).filter("source = 'big'").collect()
    assert {r["epoch"] for r in got} == {0}
    drawn = {r["doc_id"] for r in got}
    order = df.filter("source = 'big'").select("doc_id", M._order(M._hash(F.col("doc_id"), F.col("text")), F.lit(0)).alias("o")).collect()
    unsigned = lambda x: x & (1 << 64) - 1
    block = lambda x: unsigned(x) >> 57
    ranked = [r["doc_id"] for r in sorted(order, key=lambda r: (block(r["o"]), r["o"]))]
    assert drawn == set(ranked[:len(drawn)])


def test_rows_come_back_as_often_as_planned(spark):
    df, _ = table(spark)
    got = M.mix_documents(df)
    assert got.columns == df.columns
    plan = M.mix_plan(df).groupBy("doc_id").count()
    assert got.groupBy("doc_id").count().exceptAll(plan).count() == 0 and got.count() == M.mix_plan(df).count()


def test_awkward_rows(spark):
    df = documents(spark, awkward(), clash=True)
    got = M.mix_documents(df)
    assert got.columns == df.columns
    assert {str(r["doc_id"]) for r in got.select("doc_id").collect()} == {str(r[0]) for r in awkward()}
    assert M.mix_plan(df).filter("source is null").count() >= 1


def test_empty_table_and_empty_texts(spark):
    assert M.mix_plan(documents(spark, [])).collect() == []
    got = M.mix_plan(documents(spark, [(1, None), (2, "", "en", "b")])).collect()
    assert [(r["doc_id"], r["weight"], r["epoch"]) for r in sorted(got)] == [(1, 0.0, 0), (2, 0.0, 0)]


def test_one_source(spark):
    got = M.mix_plan(documents(spark, [(i, prose(30, i)) for i in range(20)])).collect()
    assert len(got) == 20 and got[0]["exponent"] == 1.0
