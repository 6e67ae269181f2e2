"""Quality rules: counts by hand, sketches against exact quantiles."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoal.llm import quality_rules as Q
from tests.llm.helpers import SMALL, awkward, documents, prose


def brute_counts(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    words = "".join(" " if c in spaces else c for c in text).split(" ")
    words = [w for w in words if w]
    lines = [x for x in text.split("\n") if any(c not in spaces for c in x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(inside))


def check(rows, got):
    assert sorted((str(r["doc_id"]), *(r[c] for c in Q.COUNTS[:5])) for r in got) == sorted((str(r[0]), *brute_counts(r[1])) for r in rows)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_a_table(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in df.collect()], Q.quality_rules(df).collect())


def test_awkward_rows(spark):
    rows = [r for r in awkward() if r[1] is None or len(r[1]) < 50_000]
    check(rows, Q.quality_rules(documents(spark, rows, clash=True)).collect())


def test_long_text():
    t = prose(30_000, 5)
    n, chars, *_ = Q.count_text(t)
    assert n == len(t.split()) and chars == sum(map(len, t.split()))


def test_empty_table(spark):
    assert Q.quality_rules(documents(spark, [])).collect() == []
    assert Q.filter_documents(documents(spark, [])).collect() == []


def test_sketch_is_within_its_error_and_merges(spark):
    r = np.random.default_rng(3)
    rows = [(i, f"{'w' * int(n)} " * 30, "en", "a" if i % 3 else "b") for i, n in enumerate(r.integers(3, 40, 600))]
    df = documents(spark, rows).select("lang", "source", Q._counts("text").alias("c"))
    got = {(x["level"], x["source"]): x for x in Q.fences(Q.sketches(df)).collect()}
    rules = Q.Rules(repeat_percent=100)
    got = {(x["level"], x["source"]): x for x in Q.fences(Q.sketches(df, rules), rules).collect()}
    for level, source, some in ((0, "a", lambda i: i % 3), (0, "b", lambda i: not i % 3), (1, None, lambda i: True), (2, None, lambda i: True)):
        x = np.array([len(t.split()[0]) for i, (_, t, *_) in enumerate(rows) if some(i)], float)
        q1, q3 = (np.quantile(x, q, method="inverted_cdf") for q in (0.25, 0.75))
        assert got[level, source]["rows"] == len(x)
        assert got[level, source]["word_length_hi"] == pytest.approx(q3 + 3 * (q3 - q1) + 0.5, rel=0.08)


def test_thresholds_follow_the_group(spark):
    """What is usual in one source is rejected in another; small groups borrow."""
    def text(i, symbols):
        return " ".join(w + ("##" if symbols and k % 3 == 0 else "") for k, w in enumerate(prose(60, i + 1).split()))
    rows = [(i, text(i, True), "en", "code") for i in range(150)] + [(1000 + i, text(i, False), "en", "news") for i in range(300)]
    rows += [(2000, text(900, True), "en", "news"), (2001, text(901, False), "en", "code"), (3000, text(902, False), "en", "rare"),
             (3001, text(903, False), None, None)]
    kept = {r["doc_id"]: r["kept"] for r in Q.quality_rules(documents(spark, rows)).collect()}
    assert all(kept[i] for i in range(150)) and all(kept[1000 + i] for i in range(300))
    assert not kept[2000] and kept[3000] and kept[3001]


def dup_lines(i, share, n=40):
    """A text of which the given share of lines are repeats, short ones between long lines."""
    dups = int(share * n)
    lines = [" ".join(f"w{i}x{k}x{j}" for j in range(12)) for k in range(n - dups - 1)]
    for k in range(dups + 1 if dups else 0):
        lines.insert(2 * k, "read on")
    return "\n".join(lines)


def repeated(i, share, n=400):
    """A text of which the given share of words lies in windows that occur twice."""
    m = int(share * n / 2)
    words = [f"w{i}x{k}" for k in range(n - m)]
    return " ".join(words + words[:m])


@pytest.mark.parametrize("make, ratio, high, low", [(dup_lines, "n_dup_lines", 0.45, 0.4), (repeated, "n_repeat_words", 0.25, 0.22)])
def test_sketches_decide_on_repetition(spark, make, ratio, high, low):
    """What no base rule rejects goes in a clean source and stays in a repetitive one."""
    rows = [(i, make(i, 0.0), "en", "clean") for i in range(150)] + [(1000, make(1000, high), "en", "clean")]
    rows += [(2000 + i, make(2000 + i, low if i % 3 else 0.0), "en", "again") for i in range(150)] + [(3000, make(3000, high), "en", "again")]
    got = {r["doc_id"]: r for r in Q.quality_rules(documents(spark, rows)).collect()}
    assert not got[1000]["base_failed"] and not got[3000]["base_failed"] and got[1000][ratio] > 0
    assert not got[1000]["kept"] and got[3000]["kept"]
    assert all(got[i]["kept"] for i in range(150)) and all(got[2000 + i]["kept"] for i in range(150))


def test_fences_differ_between_groups(spark):
    counted = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("lang", "source", Q._counts("text").alias("c"))
    r = Q.thresholds(counted).agg(*[F.count_distinct(c).alias(c) for c in Q.FENCES]).first()
    assert all(r[c] > 1 for c in Q.FENCES if c != "symbol_ratio_hi")  # symbols: clean texts have none at all


def test_more_groups_than_are_broadcast(spark, monkeypatch):
    rows = [(i, prose(40 + i % 9, i), "en", f"s{i % 7 if i % 3 else 0}") for i in range(300)] + [(500, None, None, None), (501, "## " * 90, "en", "s1")]
    df = documents(spark, rows, clash=True)
    want = {r["doc_id"] for r in Q.filter_documents(df).collect()}
    monkeypatch.setattr(Q, "MAX_GROUPS", 2)
    assert {r["doc_id"] for r in Q.filter_documents(df).collect()} == want and 501 not in want


def test_filter_keeps_what_the_rules_keep(spark):
    rows = [(i, prose(50, i), "en", "a") for i in range(120)] + [(500, "### $$$ %%% " * 30), (501, "short"), (502, None)]
    df = documents(spark, rows, clash=True)
    kept = {r["doc_id"] for r in Q.quality_rules(df).filter("kept").collect()}
    got = Q.filter_documents(df)
    assert got.columns == df.columns and {r["doc_id"] for r in got.collect()} == kept == set(range(120))


def test_labelled_quality_is_separated(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    r = {x["quality"]: x["k"] for x in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert r[1] > 0.9 and r[0] < 0.15
