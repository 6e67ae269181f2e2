from pyspark.sql import functions as F

from shoal.operators.overlay import SCENARIOS, attack_rows, inject_attacks, parse_targets, targets_frame


def test_parse_targets():
    assert parse_targets(" a, ,b ,c,") == ["a", "b", "c"]


def test_scenario_rows(spark):
    for name, (burst, dur) in SCENARIOS.items():
        rows = attack_rows(targets_frame(spark, ["t1"]), name, "2024-01-01 00:00:00").collect()
        assert len(rows) == burst
        assert {r["stars"] for r in rows} <= {1, 2}
        assert len({r["user_id"] for r in rows}) == burst and len({r["review_id"] for r in rows}) == burst
        assert all(r["is_injected"] and r["business_id"] == "t1" for r in rows)
        times = sorted(r["event_time"] for r in rows)
        span = (times[-1] - times[0]).total_seconds()
        assert abs(span - dur * (burst - 1) / burst) < 1e-6


def test_multi_target_runs_in_turn(spark):
    rows = attack_rows(targets_frame(spark, ["a", "b", "c"]), "multi", "2024-01-01 00:00:00")
    per = {r["business_id"]: (r["s"], r["n"]) for r in rows.groupBy("business_id").agg(
        F.min("event_time").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    assert [per[k][1] for k in "abc"] == [30, 30, 30]
    assert (per["b"][0] - per["a"][0]).total_seconds() == 120


def test_overlay_is_flagged(spark):
    from shoal.plans.detect import detect
    base = spark.createDataFrame([], "review_id string, user_id string, business_id string, stars int, "
                                     "text string, event_time timestamp, ingestion_time timestamp, "
                                     "is_injected boolean, sentiment_label double")
    for name in SCENARIOS:
        allr = inject_attacks(base, targets_frame(spark, ["t"]), name, "2024-01-01 00:00:00")
        caught = detect(allr).quarantined.count()
        assert caught == allr.count(), name     # stealth too: windows see all rows, not one trigger
