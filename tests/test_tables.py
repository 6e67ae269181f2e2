"""Stored tables: appends of one day, retries, reports, views; and every text is read."""

import json
import os

from pyspark.sql import functions as F

from shoal.operators import evaluate as ev
from shoal.plans.detect import detect
from shoal.sources.adapter import review_adapter
from shoal.sources.tables import read_labelled, register_tables, write_labelled, write_reports

SMALL = "/root/testdata/sf0.001"


def test_two_calls_on_one_day_and_a_retry(spark, tmp_dir):
    lab = detect(review_adapter(spark, SMALL, with_text=False)).labelled
    half = F.pmod(F.col("review_id").cast("long"), F.lit(2)) == 0
    for batch, part in ((1, lab.where(half)), (2, lab.where(~half)), (2, lab.where(~half))):
        write_labelled(part, f"{tmp_dir}/t", batch)
    o, q = read_labelled(spark, f"{tmp_dir}/t")
    assert o.count() + q.count() == 1000
    assert {"event_date", "batch_id"} <= set(o.columns)
    back = ev.united(o, q)
    for report in (ev.confusion_matrix, ev.eval_f1, ev.detection_delay, ev.throughput_per_minute):
        assert report(back).collect() == report(lab).collect()
    register_tables(spark, f"{tmp_dir}/t")
    n = spark.sql("SELECT (SELECT count(*) FROM organic_reviews) + (SELECT count(*) FROM quarantined_reviews)").collect()[0][0]
    assert n == 1000


def test_reports_are_not_spread_over_folders_by_business(spark, tmp_dir):
    reports = spark.createDataFrame([("b1", 2), ("b2", 1)], "business_id string, n int")
    expl = spark.createDataFrame([("r1", "b1"), ("r2", "b1"), ("r3", "b2")], "review_id string, business_id string")
    write_reports(reports, expl, reports.agg(F.count("*").alias("total")), f"{tmp_dir}/r")
    assert not [d for d in os.listdir(f"{tmp_dir}/r/explanations") if "=" in d]
    assert spark.read.json(f"{tmp_dir}/r/explanations").count() == 3 and spark.read.json(f"{tmp_dir}/r/reports").count() == 2
    part = [p for p in os.listdir(f"{tmp_dir}/r/index") if p.endswith(".json")][0]
    assert json.loads(open(f"{tmp_dir}/r/index/{part}").read()) == {"total": 2}


def test_every_document_that_a_review_points_at_is_used(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    ids = spark.read.parquet(f"{SMALL}/events.parquet").select((F.col("event_id") % n).alias("doc_id")).distinct()
    want = docs.join(ids, "doc_id").select("text").distinct().count()
    assert review_adapter(spark, SMALL).select("text").distinct().count() == want


def test_entry_imports_without_the_corpus_part():
    """The optional subpackage may be missing."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['shoal.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "assert e.queries() and not [k for k in e.queries() if k.startswith('op') or k == 'pipeline']")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_latency_report_file(spark, tmp_dir):
    from shoal.operators.profile import profile
    from shoal.sources.tables import write_latency_report
    df = spark.createDataFrame([("organic", "2024-01-01 10:00:00", "2024-01-01 10:00:07")], "label string, e string, i string").select(
        "label", F.to_timestamp("e").alias("event_time"), F.to_timestamp("i").alias("ingestion_time"))
    write_latency_report(profile(df), f"{tmp_dir}/latency")
    got = {r["cohort"]: r["count"] for r in spark.read.json(f"{tmp_dir}/latency").collect()}
    assert got == {"organic": 1, "quarantined": 0, "combined": 1}
