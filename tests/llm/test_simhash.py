"""SimHash components against all pairs on small tables."""

import uuid

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shoal.llm import simhash as S
from tests.llm.helpers import SMALL, awkward, documents, prose


def brute_fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, distance=3):
    """Root (least index) of each value."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def check(rows, got):
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = sorted(((d, f"{f:016x}", least.get(r)) for (d, _), f, r in zip(rows, fps, roots)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want


def test_table_matches_all_pairs(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in df.collect()], S.simhash_groups(df).collect())


def test_awkward_rows(spark):
    rows = [r[:2] for r in awkward()]
    check(rows, S.simhash_groups(documents(spark, awkward(), clash=True)).collect())


def test_empty_table(spark):
    assert S.simhash_groups(documents(spark, [])).collect() == []
    assert S.drop_near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("bucket", [1, 4, 256])
def test_links_at_every_bucket_size(spark, bucket):
    r = np.random.default_rng(4)
    centres = r.integers(0, 1 << 63, 12)
    fps = {0}
    for c in centres:
        for _ in range(30):
            v = int(c)
            for b in r.choice(64, r.integers(0, 5), replace=False):
                v ^= 1 << int(b)
            fps.add(v if v < 1 << 63 else v - (1 << 64))
    # a block of values that share one segment and differ in the other
    fps |= {(77 << 32) | int(x) for x in r.integers(0, 1 << 32, 200)} | {(77 << 32) | 5, (77 << 32) | 4, (77 << 32) | 12}
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from shoal.llm.graph import components
    got = {x["node"]: x["root"] for x in components(S.links(df, 3, bucket)).collect()}
    roots = brute_components([f & (1 << 64) - 1 for f in fps])
    want = {}
    for f, k in zip(fps, roots):
        want.setdefault(k, set()).add(f)
    have = {}
    for f in fps:
        have.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))


def test_links_stay_linear_in_a_hot_bucket(spark):
    """Hundreds of values within three bits of each other: a forest, not all pairs."""
    fps = sorted({(1 << a) | (1 << b) for a in range(40) for b in range(a)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    n = S.links(df, 3, 1 << 20).distinct().count()
    assert n <= 66 * len(fps)


def test_long_chain(spark):
    from shoal.llm.graph import components
    n = 300
    df = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    got = components(df).collect()
    assert len(got) == n + 1 and {r["root"] for r in got} == {0}


def test_one_row_of_each_component_stays(spark):
    rows = [(5, prose(200, 1)), (3, prose(200, 1)), (8, prose(200, 1).upper()), (4, prose(200, 2)), (4, prose(200, 2)),
            (None, prose(200, 3)), (None, prose(200, 3)), (9, None), (2, "")]
    got = S.drop_near_duplicates(documents(spark, rows, clash=True))
    assert got.columns == documents(spark, rows, clash=True).columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted([3, 4, None, 2], key=str)


def test_distance_beyond_three_is_refused(spark):
    with pytest.raises(ValueError):
        S.links(spark.range(1).select(F.col("id").alias("fp")), 4)


def test_few_files_for_many_input_splits(spark):
    """The fingerprints of forty splits are few bytes: not a file for every split."""
    from pathlib import Path
    from shoal.llm.common import shared_path
    root = Path(shared_path(spark, "").removeprefix("file:"))
    before = set(root.rglob("part-*"))
    rows = [(i, prose(60, i)) for i in range(120)]
    df = documents(spark, rows).repartition(40)
    check(rows, S.simhash_groups(df).collect())
    folders = {}
    for f in set(root.rglob("part-*")) - before:
        folders[f.parent] = folders.get(f.parent, 0) + 1
    assert folders and max(folders.values()) < 40


@pytest.fixture()
def many_parts(spark):
    """Shuffles of 64 parts that are not merged; gives the number of tasks run since."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    sc, group = spark.sparkContext, f"many-parts-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "")

    def tasks() -> int:
        told = sc.statusTracker()
        stages = {s for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds}
        return sum(i.numTasks for s in stages if (i := told.getStageInfo(s)) and i.numCompletedTasks)

    yield tasks
    sc.setLocalProperty("spark.jobGroup.id", None)
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("spread", [40, 50_000])
def test_rounds_have_tasks_by_their_links(spark, many_parts, spread):
    """Six rounds over 300 links, in a shuffle of many parts, in one task or some for each table."""
    from shoal.llm.graph import components
    links = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000) for i in range(50)] + [(7, 7), (2, 1)]
    got = components(spark.createDataFrame(links, "a long, b long"), spread).collect()
    assert sorted((r["node"], r["root"]) for r in got) == [(i, 0) for i in range(301)] + [(1000 + i, 1000) for i in range(50)]
    assert spread < 300 or many_parts() < 3 * 64


def test_driver_keeps_few_tasks(spark, many_parts):
    """The driver holds a record of each task: most steps read few short rows."""
    rows = [(i, prose(60, i // 2) + " tail" * (i % 2)) for i in range(120)] + [(200 + i, prose(60, 1)) for i in range(30)]
    check(rows, S.simhash_groups(documents(spark, rows)).collect())
    assert many_parts() < 20 * 64
