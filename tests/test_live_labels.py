"""Labels within the trigger: final rows equal the batch plan, provisional rows
come at once, late and repeated rows are accounted for, state stays bounded."""

import datetime as dt
import glob
import json
import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F

from shoal.config import DEFAULT
from shoal.operators.windows import classify_windows
from shoal.plans.detect import detect
from shoal.streaming import live_labels as L
from shoal.streaming import state as S
from shoal.streaming.detect_stream import start, use_rocksdb_state

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
FIELDS = ("review_id", "business_id", "stars", "date")


@pytest.fixture()
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    use_rocksdb_state(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set(key, old)
    spark.conf.set("spark.sql.shuffle.partitions", parts)


def line(rid, business, stars, seconds):
    t = T0 + dt.timedelta(seconds=seconds)
    return json.dumps(dict(zip(FIELDS, (rid, business, stars, t.strftime("%Y-%m-%d %H:%M:%S")))))


def write(folder, batches, first=0):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 3600
    for i, lines in enumerate(batches, first):
        p = f"{folder}/{i:05d}.json"
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + i, base + i))


def run(spark, folder, base, checkpoint, files=1):
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files).load(folder)
    q = start(L.live_output(lines), L.live_sink(base), checkpoint, available_now=True)
    q.awaitTermination()
    return q


def as_reviews(spark, lines):
    rows = [json.loads(x) for x in lines]
    df = spark.createDataFrame([tuple(r[c] for c in FIELDS) for r in rows], "review_id string, business_id string, stars int, t string")
    return df.withColumn("event_time", F.to_timestamp("t")).drop("t")


ATTRS = ("label", "window_start", "window_end", "window_review_count", "window_avg_stars", "window_std_stars", "anomaly_reason")


def mixed(seed, n=400, minutes=90):
    """Quiet businesses, one burst that positive reviews soften later, edges on whole minutes."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        b = r.choice("abcd")
        rows.append((r.randrange(minutes * 60), f"q{i}", b, r.choice([1, 2, 3, 4, 5, 5, None])))
    for i in range(40):
        rows.append((1500 + i * 2, f"atk{i}", "a", 1))
    for i in range(60):
        rows.append((1600 + i * 5, f"soft{i}", "a", 5))
    for i in range(20):
        rows.append((60 * r.randrange(minutes), f"edge{i}", "a", r.choice([1, 5])))
    for i in range(14):
        rows.append((3000 + 37 * i, f"slow{i}", "b", 1))
    return [line(rid, b, s, t) for t, rid, b, s in sorted(rows)]


def test_python_rules_equal_the_expressions(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        stars = [r.choice([None, 1, 1, 1, 2, 3, 5]) for _ in range(r.choice([0, 1, 4, 5, 8, 9, 12]))]
        some = [s for s in stars if s is not None]
        rows.append((i, len(stars), len(some), sum(some), sum(s * s for s in some), sum(s <= 2 for s in some)))
    df = spark.createDataFrame(rows, "i int, review_count long, n long, s long, ss long, neg_count long")
    from shoal.functions.stats import mean_from_moments, sample_std_from_moments
    st = classify_windows(df.withColumns({"avg_stars": mean_from_moments(F.col("n"), F.col("s")),
                                          "std_stars": sample_std_from_moments(F.col("n"), F.col("s"), F.col("ss"))}))
    got = {x["i"]: (x["review_count"], x["avg_stars"], x["std_stars"], x["anomaly_reason"]) for x in st.collect()}
    assert got == {i: L.window_values(tuple(m), DEFAULT) for i, *m in rows}


def test_final_labels_equal_the_batch_plan(spark, tmp_dir, rocksdb):
    lines = mixed(1)
    size = 50
    batches = [lines[i:i + size] for i in range(0, len(lines), size)]
    tails = [[line(f"tail{k}", "zz", 5, 90 * 60 + 3600 * (k + 1))] for k in range(4)]
    write(f"{tmp_dir}/in", batches + tails)
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    out = spark.read.parquet(f"{tmp_dir}/out").where("review_id not like 'tail%'")
    final = out.where("status = 'final'")
    want = detect(as_reviews(spark, lines)).labelled
    cols = ["review_id", "event_time", *ATTRS]
    assert final.count() == len(lines)
    assert final.select(*cols).exceptAll(want.select(*cols)).count() == 0
    # every accepted row has one provisional label, and the last word before the final one agrees with it
    assert out.where("status = 'provisional'").groupBy("review_id").count().where("count > 1").count() == 0
    assert out.where("status = 'provisional'").count() == len(lines)
    said = L.current_labels(spark, f"{tmp_dir}/out").where("review_id not like 'tail%'")
    assert said.select(*cols).exceptAll(want.select(*cols)).count() == 0
    last = (out.where("status <> 'final'").groupBy("review_id").agg(
        F.max_by("label", F.struct("batch_id", F.col("status") == "revised")).alias("l"),
        F.max_by("window_start", F.struct("batch_id", F.col("status") == "revised")).alias("w")))
    both = last.join(final.select("review_id", "label", "window_start"), "review_id")
    assert both.where("l <> label or not (w <=> window_start)").count() == 0
    assert out.where("status = 'revised' and label = 'quarantined'").count() > 0
    assert out.where("status = 'revised' and label = 'organic'").count() > 0


def test_blitz_is_quarantined_within_two_minutes(spark, tmp_dir, rocksdb):
    """100 reviews in 30 s among quiet traffic, triggers of 30 s of event time."""
    rows = [(30 * i, f"q{i}", "abc"[i % 3], 4) for i in range(60)] + [(600 + 0.3 * i, f"atk{i}", "a", 1) for i in range(100)]
    slices = {}
    for t, rid, b, s in sorted(rows):
        slices.setdefault(int(t) // 30, []).append(line(rid, b, s, int(t)))
    order = sorted(slices)
    write(f"{tmp_dir}/in", [slices[k] for k in order])
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    out = spark.read.parquet(f"{tmp_dir}/out").where("review_id like 'atk%' and label = 'quarantined'")
    first = {r["review_id"]: r["b"] for r in out.groupBy("review_id").agg(F.min("batch_id").alias("b")).collect()}
    assert len(first) == 100
    attack, said = 600, [30 * (order[b] + 1) for b in first.values()]  # the end of the trigger's slice
    assert max(said) - attack < 120


def test_every_line_is_accounted_for_over_a_restart(spark, tmp_dir, rocksdb):
    lines = mixed(3, n=120, minutes=60)
    batches = [lines[i:i + 30] for i in range(0, len(lines), 30)]
    later = [line(f"now{k}", "zz", 5, 4 * 3600 + 60 * k) for k in range(3)]
    late = [line(f"late{k}", "a", 1, 600 + k) for k in range(7)]
    bad = ["{broken", '{"review_id": "x", "business_id": "b", "date": "no"}', "", "   "]
    # late rows are judged by the watermark of the batches before theirs
    first = batches + [[later[0]], [later[1]]]
    second = [late + lines[:0] + [later[1], later[1]] + bad, [later[2]]]
    write(f"{tmp_dir}/in", first)
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    write(f"{tmp_dir}/in", second, len(first))
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    got = L.reconcile(spark, f"{tmp_dir}/out").first().asDict()
    everything = [x for b in first + second for x in b if x.strip()]
    assert got == {"accepted": len(lines) + 3, "late": 7, "duplicate": 2, "rejected": 2, "total": len(everything)}
    names = {r["review_id"] for r in spark.read.parquet(f"{tmp_dir}/out").where("status = 'late'").collect()}
    assert names == {f"late{k}" for k in range(7)}


def test_state_is_bounded_at_a_constant_rate(spark, tmp_dir, rocksdb):
    """Two reviews a minute and business; 13 batches of ten minutes each."""
    batches = [[line(f"r{b}-{k}-{i}", b, 1 + k % 5, 600 * i + 30 * k) for b in "abc" for k in range(20)] for i in range(13)]
    write(f"{tmp_dir}/in", batches)
    q = run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    at = {n: {r["variable"]: r["rows"] for r in S.state_rows(spark, f"{tmp_dir}/ckpt", n).collect()} for n in (7, 12)}
    assert set(at[7]) == {"sums", "held"} and at[7] == at[12]
    # the watermark is 15 minutes behind the batch before; rows last 10 minutes beyond it, sums 22
    assert at[12]["held"] <= 3 * (15 + 10 + 10) and at[12]["sums"] <= 3 * (15 + 22 + 10)
    counts = [n for b, n, *_ in S.progress_rows(q) if 5 <= b <= 12]
    assert len(counts) == 8 and len(set(counts)) == 1
    last = S.read_state(spark, f"{tmp_dir}/ckpt", variable="held", batch_id=12)
    minutes = [r["m"] for r in last.select(F.col("user_map_key.minute").alias("m")).collect()]
    newest = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 60 + 10 * 12 + 9
    assert max(minutes) == newest and min(minutes) + 10 > newest - 10 - 15  # the dropped keys are the expired ones


def test_a_silent_business_leaves_no_state(spark, tmp_dir, rocksdb):
    batches = [[line("one", "gone", 1, 0)], [line("k1", "z", 5, 3600)], [line("k2", "z", 5, 7200)], [line("k3", "z", 5, 10800)]]
    write(f"{tmp_dir}/in", batches)
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    keys = {r["b"] for v in ("sums", "held") for r in S.read_state(spark, f"{tmp_dir}/ckpt", variable=v)
            .select(F.col("key.business_id").alias("b")).collect()}
    assert keys == {"z"}


def test_operators_of_a_checkpoint(spark, tmp_dir, rocksdb):
    write(f"{tmp_dir}/in", [[line("one", "a", 1, 0)]])
    run(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    ops = S.operators(spark, f"{tmp_dir}/ckpt").collect()
    assert [o["operatorName"].startswith("transformWithState") for o in ops] == [True]
    assert not glob.glob(f"{tmp_dir}/out/*/status=final") and shutil.disk_usage(tmp_dir).total
