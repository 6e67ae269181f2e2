"""The rule cases of the original detector's unit tests, run through the
real window aggregation (all rows of a case share one business and minute)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoal.config import REASON_NONE, REASON_RATIO, REASON_UNIFORM, REASON_VELOCITY
from shoal.operators.windows import classify_windows, window_stats, window_stats_hopping

FLAGGED = "flagged"
CASES = [
    ([1, 1, 1, 2, 1, 1, 1, 2, 1], REASON_VELOCITY),
    ([1, 1, 2, 1], REASON_NONE),
    ([4, 5, 4, 5, 4, 4, 5, 4, 5], REASON_NONE),
    ([1] * 8, REASON_RATIO),
    ([1] * 8 + [2], REASON_VELOCITY),
    ([1] * 10, REASON_VELOCITY),
    ([3] * 10, REASON_UNIFORM),
    ([5, 4, 3, 5, 4, 3, 5, 4, 5], REASON_NONE),
    ([2, 2, 2], REASON_NONE),
    ([1] * 5, REASON_RATIO),
    ([1] * 9 + [5], FLAGGED),
    ([1, 1, 1, 1, 4, 5, 4], REASON_NONE),
    ([1] * 4, REASON_NONE),
    ([1, 1, 1, 1, 5], REASON_NONE),          # exactly 80 % negative is not > 80 %
    ([5, 4, 5, 1, 4, 5, 4, 4, 5, 4, 2, 5, 4, 5, 3], REASON_NONE),
    ([1], REASON_NONE),
    ([1, 2, 4, 5, 4, 5, 4, 5, 4, 5], REASON_NONE),
    ([1, 1, 1, 2, 1, 1, 1, 1, 2], FLAGGED),
    ([5, 5, 4, 5, 4, 5, 5, 3, 5, 1], REASON_NONE),
    # own additions
    ([None, None, 1, 1, 1, 1, 1], REASON_NONE),    # NULL stars count as reviews, not as negatives: 5/7
    ([None, 1, 1, 1, 1, 1], REASON_RATIO),         # 5/6 > 80 %
    ([None] * 10, REASON_NONE),                    # no star values: every comparison is NULL
    ([3, 3, 3, 3, 3, 3, 3, 3, 3], REASON_UNIFORM),  # 9 > 8 reviews
    ([3] * 8, REASON_NONE),                        # 8 is not > 8
]


def _rows(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 30)
    rows = []
    for i, (stars, _) in enumerate(CASES):
        for j, s in enumerate(stars):
            rows.append((f"r{i}-{j}", f"b{i:02d}", s, t))
    return spark.createDataFrame(rows, "review_id string, business_id string, stars int, event_time timestamp")


@pytest.mark.parametrize("stats_fn", [window_stats, window_stats_hopping])
def test_rule_cases(spark, stats_fn):
    stats = classify_windows(stats_fn(_rows(spark)))
    got = {r["business_id"]: set() for r in stats.select("business_id").distinct().collect()}
    for r in stats.select("business_id", "anomaly_reason").collect():
        got[r["business_id"]].add(r["anomaly_reason"])
    for i, (stars, want) in enumerate(CASES):
        reasons = got[f"b{i:02d}"]
        assert len(reasons) == 1, (stars, reasons)      # all 10 windows hold the same rows
        reason = reasons.pop()
        if want == FLAGGED:
            assert reason != REASON_NONE, stars
        else:
            assert reason == want, (stars, reason)


def test_empty_window_has_no_row(spark):
    df = spark.createDataFrame([], "review_id string, business_id string, stars int, event_time timestamp")
    assert window_stats(df).count() == 0


def test_ten_windows_per_row_and_boundaries(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)       # exactly on a minute
    df = spark.createDataFrame([("r", "b", 1, t)], "review_id string, business_id string, stars int, event_time timestamp")
    s = window_stats(df).orderBy("window_start").collect()
    assert len(s) == 10
    assert s[-1]["window_start"] == t                       # start is inclusive
    assert s[0]["window_start"] == t - dt.timedelta(minutes=9)  # end is exclusive
    assert s[0]["std_stars"] is None and s[0]["avg_stars"] == 1.0


def test_std_matches_spark_stddev(spark):
    import random
    rnd = random.Random(7)
    t = dt.datetime(2024, 1, 1, 10, 0, 30)
    rows = [(str(i), f"b{i % 5}", rnd.choice([1, 2, 3, 4, 5, None]), t + dt.timedelta(seconds=rnd.randint(0, 900)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars int, event_time timestamp")
    ours = window_stats(df)
    ref = (df.groupBy("business_id", F.window("event_time", "10 minutes", "1 minute").alias("w"))
           .agg(F.stddev("stars").alias("sd"), F.avg("stars").alias("av"), F.count(F.lit(1)).alias("n"))
           .select("business_id", F.col("w.start").alias("window_start"), "sd", "av", "n"))
    j = ours.join(ref, ["business_id", "window_start"]).collect()
    assert len(j) == ours.count() == ref.count()
    for r in j:
        assert r["n"] == r["review_count"]
        for a, b in ((r["sd"], r["std_stars"]), (r["av"], r["avg_stars"])):
            assert (a is None and b is None) or abs(a - b) < 1e-9
