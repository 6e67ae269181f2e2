"""URL verdicts: the cascade is exact, with and without its filters."""

import pytest
from pyspark.sql import functions as F

from shoal.llm import url_filter as U

URLS = ["http://A.Example.ORG/en/123?x=1", "https://example.org/es/x", "https://notexample.org/es/x", "http://x.com/fr/1#top", "http://x.com/de/2",
        "http://com/fr/", "http://other.net", "http://other.net?q=1", "nothing", "", None, "ftp://h/p?q://z/", "://", "http://ORG/", "http://x.org", "http://ü.net/de/",
        "http://a.b.example.org/en/1", "http://example.org/en/2", "x\n://multi.net/line\nbreak"]


def plain(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else "block" if host in listed else "allow"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "r", "k") for i, u in enumerate(urls)], "page_id long, url string, _row string, _host string").drop("_host")


@pytest.mark.parametrize("max_bits", [U.MAX_BITS, 16])
def test_verdicts(spark, max_bits):
    listed = {"other.net", "", "ü.net", "x.org"}
    keys = spark.createDataFrame([(k,) for k in [*listed, "other.net", "unseen.net"]], "key string")
    got = U.judge_pages(pages(spark, URLS * 3), keys, max_bits=max_bits).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == \
        sorted(((i, *plain(u, listed)) for i, u in enumerate(URLS * 3)), key=lambda x: x[0])
    kept = U.allowed_pages(pages(spark, URLS), keys, max_bits=max_bits)
    assert kept.columns == ["page_id", "url", "_row"]
    assert {r["page_id"] for r in kept.collect()} == {i for i, u in enumerate(URLS) if plain(u, listed)[3] == "allow"}


@pytest.mark.parametrize("share", [2, 50])
def test_cascade_is_exact_for_the_universe(spark, share):
    universe = spark.range(20_000).select(F.concat(F.lit("host"), "id", F.lit(".net")).alias("key"))
    listed = universe.filter(F.pmod(F.xxhash64("key"), F.lit(share)) == 0)
    levels = U.cascade(listed, universe)
    assert len(levels) > 1  # false positives are there, and are undone
    got = universe.select("key", U.is_listed(levels, F.col("key")).alias("in"))
    assert got.filter("in").select("key").exceptAll(listed).count() == 0
    assert got.filter("in").count() == listed.count()


def test_no_list_and_no_pages(spark):
    none = spark.createDataFrame([], "key string")
    got = U.judge_pages(pages(spark, URLS), none).collect()
    assert all(r["verdict"] == plain(URLS[r["page_id"]], set())[3] for r in got)
    assert U.judge_pages(pages(spark, ["u"]).limit(0), none).collect() == []


def test_hosts_of_many_variants(spark):
    df = pages(spark, ["http://a.net/?x", "http://a.net/1", "http://b.net/1", "http://b.net/2", "http://b.net/?3", None])
    assert {r["key"] for r in U.query_heavy_hosts(df).collect()} == {"a.net"}


@pytest.mark.parametrize("max_bits", [U.MAX_BITS, 16])
def test_no_python_and_no_join_in_the_plan(spark, max_bits):
    keys = spark.createDataFrame([("other.net",), ("x.org",), ("x.com",)], "key string")
    df = pages(spark, URLS)
    df.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/url-pages")
    plan = U.judge_pages(spark.read.parquet(path), keys, max_bits=max_bits)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Join", "Exchange hashpartitioning(_host"))
