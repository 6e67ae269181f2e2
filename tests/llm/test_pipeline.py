"""The pipeline's stages, each against plain Python on its own input."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from shoal.llm import decontaminate as D
from tests.llm.helpers import SMALL, awkward, documents
from tests.llm.test_quality_rules import brute_counts
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The input and the written result of every stage."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, out[-1], SMALL).write.parquet(f"{base}/{i}")
        out.append(spark.read.parquet(f"{base}/{i}"))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stage_order_and_columns(staged):
    assert [n for n, _ in P.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination",
                                        "mixing sources to target weights", "sharding"]
    assert all(df.columns == staged[0].columns for df in staged[:-1])


def test_quality_stage(staged):
    before, after = rows(staged[0]), set(rows(staged[1]))
    failed = {(d, t) for d, t in before if (c := brute_counts(t))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert after <= set(before) - failed
    clean = [(d, t) for d, t in before if (d, t) not in failed and not any(c in t for c in "#*$%&|<>")]
    assert len(set(clean) & after) >= 0.98 * len(clean)


def test_near_duplicate_stage(staged):
    before = rows(staged[1])
    roots = brute_components([brute_fingerprint(t) for _, t in before])
    want = defaultdict(list)
    for (d, _), r in zip(before, roots):
        want[r].append(d)
    assert sorted(d for d, _ in rows(staged[2])) == sorted(min(v) for v in want.values())


def test_decontamination_stage(staged, spark):
    items = [b" ".join(D.words(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = rows(staged[2])
    leaked = {d for d, t in before if any(i and i in b" ".join(D.words(t)) for i in items)}
    gone = {d for d, _ in before} - {d for d, _ in rows(staged[3])}
    assert leaked <= gone and len(gone - leaked) <= 0.1 * len(gone) + 1


def test_mixing_stage(staged):
    copies = Counter(d for d, _ in rows(staged[4]))
    source = {r["doc_id"]: r["source"] for r in staged[3].collect()}
    assert set(copies) == set(source)
    per = defaultdict(set)
    for d, s in source.items():
        per[s].add(copies[d])
    assert all(max(v) - min(v) <= 1 for v in per.values())


def test_sharding_stage(staged):
    out = staged[5].collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _ in rows(staged[4]))
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_run_equals_the_stages(staged, spark):
    key = lambda df: sorted((r["doc_id"], r["shard"]) for r in df.select("doc_id", "shard").collect())
    assert key(P.run(spark, SMALL)) == key(staged[5])


def test_stages_stand_awkward_and_empty_tables(spark, tmp_dir):
    for name, rows_ in (("awkward", awkward()), ("empty", [])):
        docs = documents(spark, rows_, clash=True)
        for i, (_, stage) in enumerate(P.STAGES):
            path = f"{tmp_dir}/{name}{i}"
            stage(spark, docs, SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.columns[0] == "doc_id"
