import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from shoal.operators.evaluate import united
from shoal.operators.profile import latency_stats, profile, throughput_stats


def _rows(spark, cohorts):
    t = dt.datetime(2024, 1, 1)
    rows = [(k, t, t + dt.timedelta(microseconds=v)) for k, vs in cohorts.items() for v in vs]
    return spark.createDataFrame(rows, "label string, event_time timestamp, ingestion_time timestamp")


def test_percentiles_match_numpy(spark):
    rnd = random.Random(11)
    vals = {"organic": [rnd.randint(0, 3_599_999_999) for _ in range(997)],
            "quarantined": [rnd.choice([5_000_000, 5_000_001, 17_250_000]) for _ in range(50)]}
    got = {r["cohort"]: r for r in profile(_rows(spark, vals)).collect()}
    vals["combined"] = vals["organic"] + vals["quarantined"]
    for k, vs in vals.items():
        assert got[k]["count"] == len(vs) and got[k]["excluded"] == 0
        assert abs(got[k]["mean_seconds"] - np.mean(vs) / 1e6) < 1e-3 and abs(got[k]["std_seconds"] - np.std(vs) / 1e6) < 1e-3
        for name, p in (("p50", 50), ("p90", 90), ("p95", 95), ("p99", 99)):
            assert abs(got[k][f"{name}_seconds"] - np.percentile(vs, p) / 1e6) < 1e-3, (k, name)


def test_single_value_cohort(spark):
    r = {x["cohort"]: x for x in profile(_rows(spark, {"organic": [42]})).collect()}
    assert r["organic"]["p99_seconds"] == r["combined"]["median_seconds"] == 0.0
    assert r["quarantined"]["count"] == 0 and r["quarantined"]["error"] and r["quarantined"]["throughput_error"]
    assert r["quarantined"]["total_reviews"] == 0


def test_empty_input_gives_every_cohort_its_error(spark):
    got = profile(_rows(spark, {"organic": [1]}).limit(0)).collect()
    assert len(got) == 3 and all(r["error"] and r["throughput_error"] and r["total_reviews"] == 0 for r in got)


def test_latency_stats_and_empty(spark):
    t = dt.datetime(2024, 1, 1)
    lat = [1.5, 2.0, 7.25, 3600.0, -1.0]           # the last two are invalid
    rows = [(t, t + dt.timedelta(seconds=x)) for x in lat] + [(None, t)]
    df = spark.createDataFrame(rows, "event_time timestamp, ingestion_time timestamp")
    r = latency_stats(df).collect()[0]
    v = np.array([1.5, 2.0, 7.25])
    assert r["count"] == 3 and r["error"] is None and r["excluded"] == 3
    assert r["mean_seconds"] == round(v.mean(), 3) and r["std_seconds"] == round(v.std(), 3)
    assert r["p90_seconds"] == round(np.percentile(v, 90), 3) and r["median_seconds"] == 2.0
    e = latency_stats(df.where(F.lit(False))).collect()[0]
    assert e["count"] == 0 and e["error"] and e["excluded"] == 0


def test_throughput_and_cohorts(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 5)
    o = spark.createDataFrame([(t, t), (t, t + dt.timedelta(minutes=1)), (t, None)],
                              "event_time timestamp, ingestion_time timestamp")
    q = spark.createDataFrame([(t, t + dt.timedelta(seconds=3))], "event_time timestamp, ingestion_time timestamp")
    r = throughput_stats(o).collect()[0]
    assert (r["total_reviews"], r["duration_minutes"], r["avg_reviews_per_minute"]) == (3, 2, 1.0)
    p = {x["cohort"]: x for x in profile(united(o, q)).collect()}
    assert p["combined"]["total_reviews"] == 4 and p["quarantined"]["count"] == 1
    assert p["organic"]["count"] == 2 and p["combined"]["max_seconds"] == 60.0
