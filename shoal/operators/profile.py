"""Latency and throughput profile per cohort (organic, quarantined, combined).

Exact percentiles without holding a group's values in one task: latencies
are whole microseconds in [0, 3600 s), so a first pass counts rows per second
(at most 3600 rows per cohort), a running sum over those counts locates the
second that holds each wanted rank, and a second pass counts distinct
microsecond values inside those seconds only (at most 10^6 per second). The
rank's value follows from running sums; percentiles interpolate linearly
between the two neighbouring ranks (numpy's default)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.config import LABEL_ORGANIC, LABEL_QUARANTINED
from shoal.functions.numeric import ratio, round_half

PROBS = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
MAX_LATENCY_US = 3600 * 1_000_000
COARSE_US = 1_000_000


def valid_latency(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows with both times, latency in whole microseconds, 0 <= lat < 1 h."""
    lat = F.unix_micros("ingestion_time") - F.unix_micros("event_time")
    return (df.where(F.col("event_time").isNotNull() & F.col("ingestion_time").isNotNull())
            .select(*keys, lat.alias("lat_us"))
            .where((F.col("lat_us") >= 0) & (F.col("lat_us") < MAX_LATENCY_US)))


COHORTS = (LABEL_ORGANIC, LABEL_QUARANTINED, "combined")


def _with_combined(table: DataFrame, keys: list[str], sums: list) -> DataFrame:
    """``table`` (cohort, keys..., sums) plus the cohort ``combined``: grouping
    sets over a table that is already small."""
    cohort = F.coalesce(F.col("cohort"), F.lit("combined")).alias("cohort")
    return table.groupingSets([["cohort", *keys], keys], "cohort", *keys).agg(*sums).select(
        cohort, *keys, *[c for c in table.columns if c not in ("cohort", *keys)])


def values_at_ranks(df: DataFrame, keys: list[str], value: str, ranks: DataFrame,
                    coarse: int = COARSE_US) -> DataFrame:
    """Value at each wanted 0-based rank of ``value`` (ascending) per key.

    ``ranks``: (keys..., name, rank). Returns (keys..., name, value). Pass 1
    counts rows per coarse bucket of ``value``; running sums over those few
    buckets locate each rank's bucket; pass 2 counts distinct values inside
    the located buckets only. No group's values are ever gathered in a task."""
    k = [F.col(c) for c in keys]
    l1 = df.groupBy(*k, F.floor(F.col(value) / F.lit(coarse)).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*k).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    l1 = l1.withColumn("_hi", F.sum("_c").over(w))
    loc = ranks.join(l1, keys, "inner").where(
        (F.col("rank") >= F.col("_hi") - F.col("_c")) & (F.col("rank") < F.col("_hi")))
    loc = loc.select(*k, "name", "_b", (F.col("rank") - (F.col("_hi") - F.col("_c"))).alias("_in"))
    wanted = loc.select(*k, "_b").distinct()
    fine = (df.withColumn("_b", F.floor(F.col(value) / F.lit(coarse)))
            .join(F.broadcast(wanted), keys + ["_b"], "left_semi")
            .groupBy(*k, "_b", F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c2")))
    w2 = Window.partitionBy(*k, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = fine.withColumn("_hi2", F.sum("_c2").over(w2))
    hit = loc.join(fine, keys + ["_b"], "inner").where(
        (F.col("_in") >= F.col("_hi2") - F.col("_c2")) & (F.col("_in") < F.col("_hi2")))
    return hit.select(*k, "name", F.col("_v").alias("value"))


def latency_stats(df: DataFrame) -> DataFrame:
    """One row: count, mean, median, population std, min, max, p50/p90/p95/p99
    (seconds, rounded to 3), and the rows left out because a time is missing or
    the latency lies outside [0, 1 h). An empty or all-invalid input gives ``count``
    0 and an ``error`` text instead of an exception."""
    one = F.lit("all").alias("cohort")
    return _profile_latency(df.select(one, "event_time", "ingestion_time"), ("all",)).drop("cohort")


def _profile_latency(rows: DataFrame, cohorts: tuple[str, ...]) -> DataFrame:
    """Latency block of each of ``cohorts`` for rows (cohort, event_time,
    ingestion_time). Pass 1 groups by whole second; everything but the wanted
    percentiles comes from that table (at most 3,600 rows a cohort). Pass 2 reads
    the rows of the seconds that hold a wanted rank."""
    combined = "combined" in cohorts
    lat = valid_latency(rows, ("cohort",))
    sec = F.floor(F.col("lat_us") / F.lit(COARSE_US))
    us2 = F.col("lat_us").cast("decimal(20,0)") * F.col("lat_us").cast("decimal(17,0)")
    sums = [F.sum("c").alias("c"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    seconds = lat.groupBy("cohort", sec.alias("_b")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("lat_us").alias("s"), F.sum(us2).alias("q"), F.min("lat_us").alias("lo"), F.max("lat_us").alias("hi"))
    all_rows = rows.groupBy("cohort").agg(F.count(F.lit(1)).alias("_rows"))
    if combined:
        seconds = _with_combined(seconds, ["_b"], sums)
        all_rows = all_rows.unionByName(all_rows.agg(F.lit("combined").alias("cohort"), F.sum("_rows").alias("_rows")).select("cohort", "_rows"))
    per = seconds.groupBy("cohort").agg(*sums)
    n, s = F.col("c").cast("double"), F.col("s").cast("double")
    us = F.lit(1_000_000.0)
    variance = (F.col("c").cast("decimal(18,0)") * F.col("q") - F.col("s").cast("decimal(19,0)") * F.col("s").cast("decimal(19,0)")).cast("double")
    moments = per.select(
        "cohort", F.col("c").alias("count"), round_half(s / n / us, 3).alias("mean_seconds"),
        round_half(F.sqrt(F.greatest(variance, F.lit(0.0))) / n / us, 3).alias("std_seconds"),
        round_half(F.col("lo") / us, 3).alias("min_seconds"), round_half(F.col("hi") / us, 3).alias("max_seconds"))

    t = per.select("cohort", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in PROBS.items()])).alias("t"), "c")
    h = (F.col("c") - 1).cast("double") * F.col("t.p")
    t = t.select("cohort", F.col("t.name").alias("name"), (h - F.floor(h)).alias("part"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.floor(h).alias("rank")),
        F.struct(F.lit(1).alias("side"), F.least(F.floor(h) + 1, F.col("c") - 1).alias("rank")))).alias("r"))
    running = Window.partitionBy("cohort").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = seconds.select("cohort", "_b", "c", F.sum("c").over(running).alias("hi_rank"))
    loc = (t.select("cohort", "name", "part", "r.side", "r.rank").join(upto, "cohort")
           .where((F.col("rank") >= F.col("hi_rank") - F.col("c")) & (F.col("rank") < F.col("hi_rank")))
           .select("cohort", "name", "part", "side", "_b", (F.col("rank") - F.col("hi_rank") + F.col("c")).alias("within")))
    wanted = loc.select("_b").distinct()  # two seconds per percentile and cohort at most
    fine = (lat.withColumn("_b", sec).join(F.broadcast(wanted), "_b", "left_semi")
            .groupBy("cohort", "_b", "lat_us").agg(F.count(F.lit(1)).alias("c")))
    if combined:
        fine = _with_combined(fine, ["_b", "lat_us"], [F.sum("c").alias("c")])
    in_second = Window.partitionBy("cohort", "_b").orderBy("lat_us").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fine = fine.withColumn("hi_rank", F.sum("c").over(in_second))
    hit = (loc.join(fine, ["cohort", "_b"]).where((F.col("within") >= F.col("hi_rank") - F.col("c")) & (F.col("within") < F.col("hi_rank")))
           .groupBy("cohort", "name", "part").agg(F.min(F.when(F.col("side") == 0, F.col("lat_us"))).alias("v0"),
                                                  F.min(F.when(F.col("side") == 1, F.col("lat_us"))).alias("v1")))
    quantile = round_half((F.col("v0") + F.col("part") * (F.col("v1") - F.col("v0"))) / us, 3)
    pct = hit.groupBy("cohort").agg(*[F.max(F.when(F.col("name") == k, quantile)).alias(f"{k}_seconds") for k in PROBS])
    listed = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cohorts])).alias("cohort"))
    out = listed.join(moments, "cohort", "left").join(pct, "cohort", "left").join(all_rows, "cohort", "left")
    count = F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    return out.select(
        "cohort", count.alias("count"), "mean_seconds", F.col("p50_seconds").alias("median_seconds"), "std_seconds", "min_seconds", "max_seconds",
        *[f"{k}_seconds" for k in PROBS], (F.coalesce("_rows", F.lit(0)) - count).alias("excluded"),
        F.when(count == 0, F.lit("No valid latency measurements")).alias("error"))


def _profile_throughput(rows: DataFrame, cohorts: tuple[str, ...]) -> DataFrame:
    """Throughput block of each of ``cohorts``, from counts per minute."""
    per_min = rows.groupBy("cohort", F.date_trunc("minute", "ingestion_time").alias("_m")).agg(F.count(F.lit(1)).alias("c"))
    if "combined" in cohorts:
        # a missing minute is a value of its own in the grouping sets
        marked = per_min.withColumn("_timed", F.col("_m").isNotNull()).withColumn("_m", F.coalesce("_m", F.lit("1970-01-01").cast("timestamp")))
        per_min = _with_combined(marked, ["_m", "_timed"], [F.sum("c").alias("c")])
    else:
        per_min = per_min.withColumn("_timed", F.col("_m").isNotNull())
    timed = F.col("_timed")
    got = per_min.groupBy("cohort").agg(
        F.sum("c").alias("total_reviews"), F.count_if(timed).alias("duration_minutes"),
        round_half(ratio(F.sum(F.when(timed, F.col("c"))), F.count_if(timed)), 1).alias("avg_reviews_per_minute"),
        F.max(F.when(timed, F.col("c"))).alias("max_reviews_per_minute"),
        F.min(F.when(timed, F.col("c"))).alias("min_reviews_per_minute"))
    listed = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cohorts])).alias("cohort"))
    zero = F.lit(0).cast("bigint")
    return listed.join(got, "cohort", "left").select(
        "cohort", F.coalesce("total_reviews", zero).alias("total_reviews"), F.coalesce("duration_minutes", zero).alias("duration_minutes"),
        "avg_reviews_per_minute", "max_reviews_per_minute", "min_reviews_per_minute",
        F.when(F.coalesce("duration_minutes", zero) == 0, F.lit("No timed reviews")).alias("throughput_error"))


def throughput_stats(df: DataFrame) -> DataFrame:
    """Rows, non-empty ingestion minutes, mean/max/min rows per minute (mean
    rounded to 1). ``total_reviews`` also counts rows without a time; without any
    timed row ``throughput_error`` says so."""
    return _profile_throughput(df.select(F.lit("all").alias("cohort"), "ingestion_time"), ("all",)).drop("cohort")


def profile(labelled: DataFrame) -> DataFrame:
    """Latency and throughput for the cohorts ``organic``, ``quarantined`` and
    ``combined``; a cohort without rows is there with its error texts."""
    rows = labelled.select(F.col("label").alias("cohort"), "event_time", "ingestion_time")
    return _profile_throughput(rows, COHORTS).join(_profile_latency(rows, COHORTS), "cohort").orderBy("cohort")
