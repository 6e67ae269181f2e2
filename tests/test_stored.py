"""Stored tables: the same reports, from the files of the wanted days alone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shoal.operators import evaluate as ev
from shoal.plans.detect import detect
from shoal.sources import stored as S

T0 = dt.datetime(2024, 5, 1, 12)


def reviews(spark):
    rows = []
    for day in range(4):
        t = T0 + dt.timedelta(days=day)
        rows += [(f"a{day}-{i}", f"u{i % 9}", "hot", 1, t + dt.timedelta(seconds=3 * i), True) for i in range(30)]
        rows += [(f"q{day}-{i}", f"u{i}", f"b{i % 5}", 1 + i % 5, t + dt.timedelta(minutes=7 * i), None) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id string, user_id string, business_id string, stars int, event_time timestamp, is_injected boolean")
    return df.withColumns({"text": F.lit("t"), "ingestion_time": F.col("event_time") + F.expr("interval 5 seconds"), "sentiment_label": F.lit(0.0)})


@pytest.fixture()
def tables(spark, tmp_dir):
    labelled = detect(reviews(spark)).labelled
    for k in range(3):  # three small appends
        S.store(labelled.where(F.pmod(F.xxhash64("review_id"), F.lit(3)) == k), f"{tmp_dir}/db")
    yield labelled, f"{tmp_dir}/db"
    for t in S.TABLES.values():
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def files(df):
    return {r["f"] for r in df.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_day_reads_one_partition(spark, tables):
    labelled, _ = tables
    day = S.days(spark, "quarantined", "2024-05-02", "2024-05-02")
    want = ev.attack_timeline(labelled.where((F.col("label") == "quarantined") & (F.to_date("event_time") == "2024-05-02")))
    assert same(ev.attack_timeline(day), want) and want.count() == 1
    assert all("event_date=2024-05-02" in f for f in files(day))
    plan = ev.attack_timeline(day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_reports_over_the_tables(spark, tables):
    labelled, _ = tables
    stored = S.labelled_days(spark)
    for report in (ev.confusion_matrix, ev.eval_f1, ev.eval_recall, ev.throughput_per_minute):
        assert same(report(stored), report(labelled))
    some = S.labelled_days(spark, "2024-05-01", "2024-05-02")
    assert same(ev.confusion_matrix(some), ev.confusion_matrix(labelled.where(F.to_date("event_time") <= "2024-05-02")))


def test_days_of_a_join_prune_too(spark, tables):
    wanted = spark.createDataFrame([(dt.date(2024, 5, 3), "x"), (dt.date(2024, 5, 3), "y")], "event_date date, why string").where("why <> 'z'")
    got = S.of_days(spark.table("quarantined_reviews"), wanted)
    assert got.count() == S.days(spark, "quarantined", "2024-05-03", "2024-05-03").count() > 0
    assert "dynamicpruning" in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_statistics(spark, tables):
    S.analyze(spark)
    n = spark.table("organic_reviews").count()
    stats = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED organic_reviews").collect()}
    assert f"{n} rows" in stats["Statistics"]
    part = spark.sql("DESCRIBE EXTENDED organic_reviews PARTITION (event_date = '2024-05-02')").collect()
    assert any("rows" in (r["data_type"] or "") for r in part if r["col_name"] == "Partition Statistics")


def test_compaction_keeps_the_rows(spark, tables, tmp_dir):
    before = spark.table("organic_reviews").cache()
    n, days = before.count(), {str(r["event_date"]): r["files"] for r in S.file_sizes(spark, "organic_reviews").collect()}
    rows = sorted(map(str, before.collect()))
    before.unpersist()
    assert all(f >= 3 for f in days.values())
    assert S.compact(spark, "organic_reviews", f"{tmp_dir}/scratch") == sorted(days)
    after = {str(r["event_date"]): (r["files"], r["small"]) for r in S.file_sizes(spark, "organic_reviews").collect()}
    assert after == {d: (1, 1) for d in days}
    assert sorted(map(str, spark.table("organic_reviews").collect())) == rows and len(rows) == n
    assert S.compact(spark, "organic_reviews", f"{tmp_dir}/scratch") == []


def test_tables_of_another_session(spark, tables):
    _, base = tables
    n = spark.table("quarantined_reviews").count()
    for t in S.TABLES.values():
        spark.sql(f"DROP TABLE {t}")
    S.attach(spark, base)
    assert spark.table("quarantined_reviews").count() == n and spark.sql("SHOW PARTITIONS quarantined_reviews").count() == 4
