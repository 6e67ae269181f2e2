import json

from pyspark.sql import functions as F

from shoal.sources.json_lines import (limit_valid, parse_lines, read_lines, read_reviews_json, split_valid_rejected,
                                      status_counts)
from shoal.sources.messages import to_keyed_messages


def _lines(spark, items):
    return spark.createDataFrame([(x,) for x in items], "value string")


GOOD = {"review_id": "r1", "user_id": "u", "business_id": "b", "stars": 4, "text": "ok",
        "date": "2024-01-01 10:00:00"}


def test_valid_bad_blank(spark):
    lines = [json.dumps(GOOD), json.dumps({**GOOD, "review_id": "r2"}), '{"review_id": "r3", "busi', "", "   "]
    good, bad = split_valid_rejected(_lines(spark, lines))
    assert sorted(r["review_id"] for r in good.collect()) == ["r1", "r2"]
    assert [r["status"] for r in bad.collect()] == ["malformed"]


def test_stars_as_double_and_text(spark):
    lines = [json.dumps({**GOOD, "stars": 5.0}), json.dumps({**GOOD, "review_id": "x", "stars": "3"}),
             json.dumps({**GOOD, "review_id": "y", "stars": 4.5})]
    got = {r["review_id"]: r["stars"] for r in split_valid_rejected(_lines(spark, lines))[0].collect()}
    assert got == {"r1": 5, "x": 3, "y": None}


def test_rejects_with_reason(spark):
    lines = [json.dumps({**GOOD, "date": "junk"}), json.dumps({**GOOD, "business_id": None}),
             json.dumps({k: v for k, v in GOOD.items() if k != "review_id"}), "[1, 2]"]
    got = sorted(r["status"] for r in parse_lines(_lines(spark, lines)).collect())
    assert got == ["bad_date", "malformed", "missing_business_id", "missing_review_id"]


def test_status_counts(spark):
    lines = [json.dumps(GOOD), "", "{bad"]
    got = {r["status"]: r["lines"] for r in status_counts(_lines(spark, lines)).collect()}
    assert got == {"valid": 1, "blank": 1, "malformed": 1}


def test_limit_counts_valid_lines_only(spark, tmp_dir):
    lines = []
    for i in range(20):
        lines.append(json.dumps({**GOOD, "review_id": f"r{i:02d}"}))
        if i % 3 == 0:
            lines.append("{not json")
    p = f"{tmp_dir}/in.json"
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    got = [r["review_id"] for r in limit_valid(read_lines(spark, p), 5).collect()]
    assert got == ["r00", "r01", "r02", "r03", "r04"]


def test_keyed_messages(spark):
    df = spark.createDataFrame([("r1", "b9", 4, None)], "review_id string, business_id string, stars int, is_injected boolean")
    m = to_keyed_messages(df).collect()[0]
    assert m["key"] == "b9"
    assert json.loads(m["value"]) == {"review_id": "r1", "business_id": "b9", "stars": 4}


def test_fields_of_another_type_are_null_and_keep_the_row(spark):
    lines = [json.dumps({**GOOD, "review_id": "a", "useful": 3.0, "funny": "1", "cool": 2.5, "is_injected": "true"}),
             json.dumps({**GOOD, "review_id": "b", "useful": "many", "funny": [1], "cool": {"x": 1}, "is_injected": "perhaps"}),
             json.dumps({**GOOD, "review_id": "c", "useful": 7, "is_injected": False})]
    got = {r["review_id"]: (r["useful"], r["funny"], r["cool"], r["is_injected"]) for r in split_valid_rejected(_lines(spark, lines))[0].collect()}
    assert got == {"a": (3, 1, None, True), "b": (None, None, None, None), "c": (7, None, None, False)}


def test_limit_follows_the_order_of_files(spark, tmp_dir):
    """Files of unequal size: Spark packs them by size, the limit reads them by name."""
    for name, n in (("a", 2), ("b", 50), ("c", 5)):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.writelines(json.dumps({**GOOD, "review_id": f"{name}{i:02d}"}) + "\n" for i in range(n))
    got = [r["review_id"] for r in limit_valid(read_lines(spark, tmp_dir), 4).collect()]
    assert got == ["a00", "a01", "b00", "b01"]


def test_batch_scan_of_json_files(spark, tmp_dir):
    with open(f"{tmp_dir}/x.json", "w") as f:
        f.write(json.dumps(GOOD) + "\n{broken\n\n")
    got = read_reviews_json(spark, f"{tmp_dir}/x.json").collect()
    assert [(r["review_id"], r["stars"]) for r in got] == [("r1", 4)] and got[0]["ingestion_time"] is not None


def test_kafka_options():
    from shoal.sources.messages import kafka_sink_options, kafka_source_options
    assert kafka_source_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert kafka_source_options("h:1", "t", "earliest", True)["failOnDataLoss"] == "true"
    assert kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
