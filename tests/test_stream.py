"""Stream = batch: reviews replayed as JSON-lines files through the stateful
stream give the same labels as the batch plan; a retried batch rewrites its
own partition; a late row is dropped by the watermark."""

import glob
import os
import shutil
import time

from pyspark.sql import functions as F

from shoal.plans.detect import detect
from shoal.sources.adapter import review_adapter
from shoal.sources.messages import review_wire
from shoal.streaming.detect_stream import label_stream, labelled_sink, parse_stream, start

SMALL = "/root/testdata/sf0.001"


def _write_files(spark, df, folder, tails):
    w = review_wire(df).withColumn(
        "slice", F.floor((F.unix_seconds(F.to_timestamp("date")) - 1704067200) / 600))
    tmp = folder + "_parts"
    for s in sorted(x[0] for x in w.select("slice").distinct().collect()):
        (w.where(F.col("slice") == s).drop("slice").select(F.to_json(F.struct("*")).alias("value"))
         .coalesce(1).write.text(f"{tmp}/{s:06d}"))
    for k, row in enumerate(tails):
        (spark.createDataFrame([row], "review_id string, user_id string, business_id string, stars double, date string")
         .select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.text(f"{tmp}/t{k:03d}"))
    os.makedirs(folder)
    for i, p in enumerate(sorted(glob.glob(f"{tmp}/*/part-*"))):
        shutil.copy(p, f"{folder}/{i:05d}.json")
    _order_by_name(folder)


def _order_by_name(folder):
    """The file source takes files in modification-time order: make it the name order."""
    base = time.time() - 3600
    for i, p in enumerate(sorted(glob.glob(f"{folder}/*.json"))):
        os.utime(p, (base + i, base + i))


def test_stream_equals_batch(spark, tmp_dir):
    r = review_adapter(spark, SMALL, with_text=False)
    tails = [(f"tail{k}", "u", "tailbiz", 5.0, f"2024-01-{2 + k:02d} 00:00:00") for k in range(8)]
    _write_files(spark, r, f"{tmp_dir}/in", tails)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_dir}/in")
    q = start(label_stream(parse_stream(lines)), labelled_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt",
              available_now=True)
    q.awaitTermination()
    o = spark.read.parquet(f"{tmp_dir}/out/organic")
    qq = spark.read.parquet(f"{tmp_dir}/out/quarantined")
    s = (o.select("review_id", F.lit("organic").alias("label"), F.lit(None).cast("timestamp").alias("window_start"),
                  F.lit(None).cast("string").alias("anomaly_reason"))
         .unionByName(qq.select("review_id", F.lit("quarantined").alias("label"), "window_start", "anomaly_reason"))
         .where(~F.col("review_id").startswith("tail")))
    b = detect(r.withColumn("event_time", F.date_trunc("second", "event_time"))).labelled.select(
        "review_id", "label", "window_start", "anomaly_reason")
    assert s.count() == 1000
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_sink_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("r1", "b", "organic", "2024-01-01 10:00:00"), ("r2", "b", "quarantined", "2024-01-01 10:00:00")],
                               "review_id string, business_id string, label string, t string")
    df = df.withColumn("event_time", F.to_timestamp("t")).drop("t")
    sink = labelled_sink(f"{tmp_dir}/out")
    sink(df, 3)
    sink(df, 3)
    sink(df.where(F.col("review_id") == "r1"), 4)
    o = spark.read.parquet(f"{tmp_dir}/out/organic")
    assert sorted((x["review_id"], x["batch_id"]) for x in o.collect()) == [("r1", 3), ("r1", 4)]
    assert spark.read.parquet(f"{tmp_dir}/out/quarantined").count() == 1


def test_scored_stream_with_rocksdb_state(spark, tmp_dir):
    """The stream's sentiment equals the batch model's, with state in RocksDB."""
    from shoal.operators.text_model import hashed_model, score
    from shoal.streaming.detect_stream import score_stream, use_rocksdb_state
    rows = [(f"r{i}", "u", f"b{i % 3}", 1.0 if i % 2 else 5.0, "awful rude terrible" if i % 2 else "great lovely place",
             f"2024-01-01 10:{i:02d}:00") for i in range(20)]
    rows += [(f"tail{k}", "u", "z", 5.0, None, f"2024-01-{2 + k:02d} 00:00:00") for k in range(4)]
    df = spark.createDataFrame(rows, "review_id string, user_id string, business_id string, stars double, text string, date string")
    model = hashed_model(num_features=256).fit(df.where("text is not null").withColumn("label", (F.col("stars") > 3).cast("double")))
    os.makedirs(f"{tmp_dir}/in")
    import json
    for i, r in enumerate(rows):
        with open(f"{tmp_dir}/in/{i:03d}.json", "w") as f:
            f.write(json.dumps(dict(zip(df.columns, r))) + "\n")
    _order_by_name(f"{tmp_dir}/in")
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb_state(spark)
    try:
        lines = spark.readStream.format("text").option("maxFilesPerTrigger", 8).load(f"{tmp_dir}/in")
        q = start(label_stream(score_stream(parse_stream(lines), model)), labelled_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt", available_now=True)
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    got = spark.read.parquet(f"{tmp_dir}/out/organic").where("review_id like 'r%'")
    if glob.glob(f"{tmp_dir}/out/quarantined/*/*/*.parquet"):
        got = got.select("review_id", "sentiment_label").unionByName(
            spark.read.parquet(f"{tmp_dir}/out/quarantined").where("review_id like 'r%'").select("review_id", "sentiment_label"))
    got = {r["review_id"]: r["sentiment_label"] for r in got.collect()}
    want = {r["review_id"]: r["sentiment_label"] for r in score(model, df).where("review_id like 'r%'").collect()}
    assert got == want and len(got) == 20 and None not in got.values()


def test_stream_rejects_are_stored_and_counted(spark, tmp_dir):
    from shoal.sources.tables import reject_counts
    from shoal.streaming.detect_stream import reject_stream, rejects_sink
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write('{"review_id": "a", "business_id": "b", "date": "2024-01-01 10:00:00"}\n{bad\n\n{"review_id": "x", "business_id": "b", "date": "no"}\n')
    lines = spark.readStream.format("text").load(f"{tmp_dir}/in")
    q = start(reject_stream(lines), rejects_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination()
    got = {r["status"]: r["rejects"] for r in reject_counts(spark, f"{tmp_dir}/out").collect()}
    assert got == {"malformed": 1, "bad_date": 1}


def test_micro_batch_labeller(spark, tmp_dir):
    from shoal.streaming.detect_stream import micro_batch_labeller
    rows = [(f"r{i}", f"u{i}", "b", 1, "2024-01-01 10:00:30") for i in range(12)] + [("calm", "u", "c", 5, "2024-01-01 10:00:30")]
    df = spark.createDataFrame(rows, "review_id string, user_id string, business_id string, stars int, t string").withColumn(
        "event_time", F.to_timestamp("t")).drop("t")
    micro_batch_labeller(f"{tmp_dir}/out")(df, 1)
    micro_batch_labeller(f"{tmp_dir}/out")(df.limit(0), 2)
    assert spark.read.parquet(f"{tmp_dir}/out/quarantined").count() == 12
    assert [r["review_id"] for r in spark.read.parquet(f"{tmp_dir}/out/organic").collect()] == ["calm"]


def test_late_row_dropped(spark, tmp_dir):
    # late rows are judged against the watermark of the previous batch, hence
    # one batch ("y") between the row that moves the watermark and the late row
    rows = [("a", "u", "b", 1.0, "2024-01-01 10:00:00"), ("z", "u", "c", 1.0, "2024-01-01 12:00:00"),
            ("y", "u", "e", 1.0, "2024-01-01 12:00:01"), ("late", "u", "b", 1.0, "2024-01-01 10:05:00")]
    rows += [(f"t{k}", "u", "d", 5.0, f"2024-01-0{2 + k} 00:00:00") for k in range(5)]
    folder = f"{tmp_dir}/in"
    os.makedirs(folder)
    import json
    for i, r in enumerate(rows):
        with open(f"{folder}/{i:03d}.json", "w") as f:
            f.write(json.dumps(dict(zip(["review_id", "user_id", "business_id", "stars", "date"], r))) + "\n")
    _order_by_name(folder)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
    q = start(label_stream(parse_stream(lines)), labelled_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt",
              available_now=True)
    q.awaitTermination()
    ids = {x["review_id"] for x in spark.read.parquet(f"{tmp_dir}/out/organic").collect()}
    assert "a" in ids and "z" in ids and "late" not in ids


def test_restart_from_checkpoint(spark, tmp_dir):
    """Stop after part of the files, add the rest, restart on the same
    checkpoint: the output equals one uninterrupted run."""
    r = review_adapter(spark, SMALL, with_text=False).where(F.col("business_id").isin("1", "2", "3"))
    tails = [(f"tail{k}", "u", "tailbiz", 5.0, f"2024-01-{2 + k:02d} 00:00:00") for k in range(8)]
    _write_files(spark, r, f"{tmp_dir}/all", tails)
    files = sorted(glob.glob(f"{tmp_dir}/all/*.json"))
    src = f"{tmp_dir}/in"
    os.makedirs(src)
    half = len(files) // 2
    for p in files[:half]:
        shutil.copy(p, src)
    _order_by_name(src)

    def run():
        lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)
        q = start(label_stream(parse_stream(lines)), labelled_sink(f"{tmp_dir}/out"), f"{tmp_dir}/ckpt",
                  available_now=True)
        q.awaitTermination()
    run()
    for p in files[half:]:
        shutil.copy(p, src)
    base = time.time() - 1800
    for i, p in enumerate(sorted(glob.glob(f"{src}/*.json"))[half:]):
        os.utime(p, (base + i, base + i))
    run()
    o = spark.read.parquet(f"{tmp_dir}/out/organic").select("review_id")
    q = spark.read.parquet(f"{tmp_dir}/out/quarantined").select("review_id")
    got = o.unionByName(q).where(~F.col("review_id").startswith("tail"))
    assert got.count() == r.count() and got.distinct().count() == r.count()
