"""Label join: exact window bounds, earliest window, and equality with a
brute-force range join on random data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shoal.operators.label import label_reviews, organic, quarantined
from shoal.plans.detect import detect

SCHEMA = "review_id string, user_id string, business_id string, stars int, event_time timestamp"
FLAG_SCHEMA = ("business_id string, window_start timestamp, window_end timestamp, window_review_count long, "
               "window_avg_stars double, window_std_stars double, anomaly_reason string")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
US = dt.timedelta(microseconds=1)
M = dt.timedelta(minutes=1)


def _flag(spark, starts):
    return spark.createDataFrame([("b", s, s + 10 * M, 9, 1.0, 0.0, "X") for s in starts], FLAG_SCHEMA)


def test_bounds(spark):
    fl = _flag(spark, [T0])
    times = {"at_start": T0, "before": T0 - US, "end": T0 + 10 * M, "grace_end": T0 + 12 * M,
             "after": T0 + 12 * M + US, "mid": T0 + 5 * M + 30 * dt.timedelta(seconds=1)}
    rv = spark.createDataFrame([(k, "u", "b", 1, t) for k, t in times.items()], SCHEMA)
    got = {r["review_id"]: r["label"] for r in label_reviews(rv, fl).collect()}
    assert got == {"at_start": "quarantined", "before": "organic", "end": "quarantined",
                   "grace_end": "quarantined", "after": "organic", "mid": "quarantined"}


def test_earliest_window_wins(spark):
    fl = _flag(spark, [T0 + 3 * M, T0 + 1 * M, T0 + 5 * M])
    rv = spark.createDataFrame([("r", "u", "b", 1, T0 + 6 * M)], SCHEMA)
    r = label_reviews(rv, fl).collect()[0]
    assert r["window_start"] == T0 + 1 * M


def test_other_business_not_labelled(spark):
    fl = _flag(spark, [T0])
    rv = spark.createDataFrame([("r", "u", "c", 1, T0 + M)], SCHEMA)
    assert label_reviews(rv, fl).collect()[0]["label"] == "organic"


def test_duplicate_ids_keep_one(spark):
    fl = _flag(spark, [T0])
    rv = spark.createDataFrame([("r", "u", "b", 1, T0 + 20 * M), ("r", "u", "b", 1, T0 + M),
                                ("s", "u", "b", 1, T0 + M)], SCHEMA)
    out = label_reviews(rv, fl).orderBy("review_id").collect()
    assert [r["review_id"] for r in out] == ["r", "s"]
    assert out[0]["event_time"] == T0 + M and out[0]["label"] == "quarantined"


def test_matches_brute_force_range_join(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        b = f"b{rnd.randint(0, 6)}"
        t = T0 + dt.timedelta(seconds=rnd.randint(0, 3 * 3600), microseconds=rnd.choice([0, 0, 1, 999999]))
        rows.append((str(i), f"u{i % 17}", b, rnd.choice([1, 1, 2, 3, 4, 5]), t))
    rv = spark.createDataFrame(rows, SCHEMA)
    d = detect(rv)
    ours = d.labelled.select("review_id", "label", "window_start")
    f = d.flagged
    j = (rv.alias("r").join(f.alias("f"), (F.col("r.business_id") == F.col("f.business_id"))
                            & (F.col("r.event_time") >= F.col("f.window_start"))
                            & (F.col("r.event_time") <= F.col("f.window_end") + F.expr("INTERVAL 2 MINUTES")), "left")
         .groupBy("r.review_id").agg(F.min("f.window_start").alias("window_start"))
         .withColumn("label", F.when(F.col("window_start").isNull(), "organic").otherwise("quarantined")))
    brute = j.select("review_id", "label", "window_start")
    assert ours.count() == 3000
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_outputs_have_reference_columns(spark):
    fl = _flag(spark, [T0])
    rv = spark.createDataFrame([("r", "u", "b", 1, T0 + M), ("s", "u", "b", 1, T0 + 60 * M)], SCHEMA)
    lab = label_reviews(rv, fl)
    assert organic(lab).count() == 1 and quarantined(lab).count() == 1
    assert "anomaly_reason" in quarantined(lab).columns and "anomaly_reason" not in organic(lab).columns


def test_earliest_window_decides_among_duplicates_and_missing_ids_are_rejects(spark):
    """An id seen first organic and then inside an attack is quarantined."""
    from shoal.operators.label import missing_ids
    fl = _flag(spark, [T0])
    rv = spark.createDataFrame([("r", "u", "c", 5, T0 - 60 * M), ("r", "u", "b", 1, T0 + M), (None, "u", "b", 1, T0 + M),
                                (None, "v", "b", 1, T0 + M)], SCHEMA)
    got = label_reviews(rv, fl).collect()
    assert [(r["review_id"], r["label"], r["business_id"]) for r in got] == [("r", "quarantined", "b")]
    assert missing_ids(rv).count() == 2
