"""Labels from arbitrary intervals against brute force; nested report parts."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from shoal.config import Thresholds
from shoal.operators import intervals as I
from shoal.operators import report_parts as R
from shoal.operators.windows import flag_windows, window_stats_hopping

T0 = dt.datetime(2024, 1, 1)
SEC = dt.timedelta(seconds=1)


def tables(spark, seed, n=300, m=60, span=20_000):
    r = random.Random(seed)
    business = lambda: r.choice(["a", "a", "a", "b", "c", None])
    reviews = [(i, business(), None if i % 41 == 0 else T0 + r.randrange(span) * SEC) for i in range(n)]
    ivs = []
    for k in range(m):
        s = r.randrange(span)
        e = s + r.choice([0, 1, r.randrange(-5, 500), r.randrange(8000)])
        ivs.append((business(), T0 + s * SEC, None if k % 23 == 0 else T0 + e * SEC, f"k{k % 7}"))
    ivs += ivs[:5] + [(b, s, e, "other") for b, s, e, _ in ivs[5:10]]
    # bounds that are review times, to the instant
    ivs += [("a", t, t, "instant") for _, b, t in reviews[:30] if b == "a" and t is not None]
    return (reviews, ivs, spark.createDataFrame(reviews, "id int, business_id string, event_time timestamp"),
            spark.createDataFrame(ivs, "business_id string, s timestamp, e timestamp, k string"))


def brute(reviews, ivs):
    out = set()
    for i, b, t in reviews:
        hits = [(s, e, k) for c, s, e, k in ivs if c == b and b is not None and t is not None and e is not None and s <= t <= e]
        out.add((i, min(hits) if hits else None))
    return out


@pytest.mark.parametrize("seed, bin_minutes", [(1, 60), (2, 1), (3, 7), (4, 100_000), (5, 13)])
def test_random_intervals(spark, seed, bin_minutes):
    reviews, ivs, rdf, idf = tables(spark, seed)
    got = {(x["id"], None if x["_w"] is None else tuple(x["_w"])) for x in I.covering(rdf, idf, "s", "e", bin_minutes=bin_minutes).collect()}
    assert got == brute(reviews, ivs)


def test_windows_off_the_minute_grid(spark):
    """Windows of 10 minutes every 3, which minute buckets cannot serve."""
    thr = Thresholds(window_minutes=10, slide_minutes=3, grace_minutes=1)
    r = random.Random(8)
    rows = [(str(i), r.choice("ab"), T0 + r.randrange(7200) * SEC, r.choice([1, 1, 2, 5])) for i in range(400)]
    df = spark.createDataFrame(rows, "review_id string, business_id string, event_time timestamp, stars int")
    flagged = flag_windows(window_stats_hopping(df, thr), thr)
    got = {x["review_id"]: (x["label"], x["window_start"]) for x in I.label_by_intervals(df, flagged, grace_minutes=1).collect()}
    fl = [(x["business_id"], x["window_start"], x["window_end"]) for x in flagged.collect()]
    assert fl
    for rid, b, t, _ in rows:
        hits = [s for c, s, e in fl if c == b and s <= t <= e + dt.timedelta(minutes=1)]
        assert got[rid] == (("quarantined", min(hits)) if hits else ("organic", None))


def test_a_busy_business_is_spread(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("hot").alias("business_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 10).alias("event_time"))
    iv = spark.createDataFrame([("hot", 1_700_000_000, 1_700_100_000)], "business_id string, a long, b long").select(
        "business_id", F.timestamp_seconds("a").alias("s"), F.timestamp_seconds("b").alias("e"))
    got = I.covering(df, iv, "s", "e")
    assert got.where("_w is not null").count() == 10_001
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_b" in plan and "_bin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_incidents(spark):
    minute = lambda k: T0 + dt.timedelta(minutes=k)
    rows = [("a", 0, 10, 9), ("a", 1, 11, 12), ("a", 12, 22, 10), ("a", 30, 40, 9), ("b", 5, 15, 20)]
    fl = spark.createDataFrame([(b, minute(s), minute(e), c) for b, s, e, c in rows], "business_id string, window_start timestamp, window_end timestamp, window_review_count long")
    got = sorted(tuple(x) for x in I.incidents(fl).select("business_id", "incident_start", "incident_end", "windows", "max_review_count").collect())
    assert got == [("a", minute(0), minute(24), 3, 12), ("a", minute(30), minute(42), 1, 9), ("b", minute(5), minute(17), 1, 20)]
    rv = spark.createDataFrame([("a", minute(24), 1, True), ("a", minute(25), 1, None), ("a", minute(3), None, None), ("c", minute(3), 1, None)],
                               "business_id string, event_time timestamp, stars int, is_injected boolean")
    rep = [(x["business_id"], x["incident_start"], x["reviews"], x["rated"], x["stars_sum"], x["injected"]) for x in I.incident_report(rv, fl).collect()]
    assert rep == [("a", minute(0), 2, 1, 1, 1)]


def test_empty_tables(spark):
    _, _, rdf, idf = tables(spark, 1)
    assert I.covering(rdf.limit(0), idf, "s", "e").collect() == []
    assert {x["_w"] for x in I.covering(rdf, idf.limit(0), "s", "e").collect()} == {None}


EXPLAINED = "review_id string, business_id string, stars int, text_preview string, top_features array<struct<feature:string,shap_value:double>>"


def explained(spark, sizes):
    rows = [(f"{b}-{i:05d}", b, i % 5 + 1, f"text {i}", [("word", 0.5)] * (i % 3)) for b, n in sizes for i in range(n)]
    return spark.createDataFrame(rows + [("x", None, 1, "t", [])], EXPLAINED)


@pytest.mark.parametrize("piece", [100_000, 70])
def test_parts_are_bounded_and_reassemble(spark, piece):
    df = explained(spark, [("small", 3), ("edge", 50), ("big", 523)])
    parts = R.report_parts(df, 50, piece)
    rows = parts.collect()
    assert all(len(r["reviews"]) == r["n"] <= 50 for r in rows)
    numbers = {}
    for r in rows:
        numbers.setdefault(r["business_id"], []).append(r["part"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in numbers.values())
    back = R.reassembled(parts).select(*df.columns)
    assert back.exceptAll(df).count() == 0 and back.count() == df.count()
    m = {r["business_id"]: (r["parts"], r["reviews"]) for r in R.manifest(parts).collect()}
    assert m["small"] == (1, 3) and m["edge"][1] == 50 and m["big"][1] == 523 and m[None] == (1, 1)
    if piece == 100_000:
        assert [x["review_id"] for x in next(r for r in rows if r["business_id"] == "big" and r["part"] == 2)["reviews"]] == [f"big-{i:05d}" for i in range(50, 100)]


def test_no_row_grows_with_its_business(spark):
    n = 200_000
    df = spark.range(n).select(F.col("id").cast("string").alias("review_id"), F.lit("hot").alias("business_id"), F.lit(1).alias("stars"),
                               F.lit("t").alias("text_preview"), F.array().cast("array<struct<feature:string,shap_value:double>>").alias("top_features"))
    parts = R.report_parts(df, 100, 10_000)
    r = parts.agg(F.max(F.size("reviews")).alias("m"), F.sum("n").alias("n"), F.max("part").alias("p"), F.count(F.lit(1)).alias("c")).first()
    assert r["m"] <= 100 and r["n"] == n and r["p"] == r["c"]


def test_nested_reports_are_written_and_read(spark, tmp_dir):
    df = explained(spark, [("small", 3), ("big", 120)])
    reports = spark.createDataFrame([("small", 3), ("big", 120), (None, 1)], "business_id string, num_flagged_reviews long")
    R.write_nested_reports(reports, R.report_parts(df, 50), tmp_dir)
    got = {r["business_id"]: (r["review_parts"], r["explained_reviews"]) for r in spark.read.json(f"{tmp_dir}/reports").collect()}
    assert got == {"small": (1, 3), "big": (3, 120), None: (1, 1)}
    assert R.reassembled(R.read_nested_parts(spark, tmp_dir, R.report_parts(df, 50).schema)).select(*df.columns).exceptAll(df).count() == 0


@pytest.mark.parametrize("piece", [100_000, 70])
def test_explanations_are_shuffled_once(spark, piece):
    """Neither the sizes of the businesses nor the numbers of the parts move the explanations again."""
    parts = R.report_parts(explained(spark, [("small", 3), ("big", 523)]), 50, piece)
    got = {b: [(r["part"], r["n"]) for r in parts.where(F.col("business_id").eqNullSafe(b)).orderBy("part").collect()] for b in ("small", "big", None)}
    assert got["small"] == [(1, 3)] and got[None] == [(1, 1)]
    assert [p for p, _ in got["big"]] == list(range(1, len(got["big"]) + 1)) and sum(n for _, n in got["big"]) == 523
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and not re.search(r"windowspecdefinition\(business_id#\d+, _piece#\d+L? ASC", plan)
