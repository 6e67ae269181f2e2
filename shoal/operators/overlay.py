"""Labelled attack overlay: synthetic negative reviews for target businesses,
added to a review table so detection quality can be measured.

For each target (in ``target_order``) and scenario, ``burst_size`` rows are
spaced ``duration_sec / burst_size`` seconds apart starting at ``start``;
targets follow one another (a multi-target run attacks them in turn). Stars
are 1 (32 of 33) or 2 (1 of 33), every row gets a fresh user and no text (the rules
read none); all choices are md5-derived from (target, scenario, row) so the
overlay is reproducible and engine-independent. It measures the detector; it is not
an operator of its own and no query gives out its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------
SCENARIOS = {
    "blitz": (100, 30),
    "sustained": (200, 600),
    "stealth": (50, 1800),
    "multi": (30, 120),
}
STAR2_ONE_IN = 33      # weights 8,8,8,8 for 1 star and 1 for 2 stars


def scenario(name: str, burst: int | None = None, duration: int | None = None) -> tuple[int, int]:
    b, d = SCENARIOS[name]
    return (burst if burst is not None else b, duration if duration is not None else d)


def _h(seed: Column, salt: str) -> Column:
    """Unsigned 32-bit number from md5(seed || salt)."""
    return F.conv(F.substring(F.md5(F.concat(seed, F.lit(salt))), 1, 8), 16, 10).cast("bigint")


def parse_targets(spec: str) -> list[str]:
    """Comma-separated business ids, trimmed, empties dropped."""
    return [t.strip() for t in spec.split(",") if t.strip()]


def targets_frame(spark: SparkSession, targets: list[str]) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(targets)],
                                 "business_id string, target_order int")


def attack_rows(targets: DataFrame, scenario_name: str, start: Column | str,
                burst: int | None = None, duration: int | None = None) -> DataFrame:
    """Injected reviews. ``targets``: (business_id, target_order); ``start``: a
    timestamp literal text or a column of ``targets`` (per-target start)."""
    n, dur = scenario(scenario_name, burst, duration)
    start_c = F.lit(start).cast("timestamp") if isinstance(start, str) else start
    step_us = int(dur * 1_000_000 // max(n, 1))
    rows = targets.select("business_id", "target_order", start_c.alias("_start"),
                          F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    seed = F.concat_ws("|", F.col("business_id"), F.lit(scenario_name), F.col("i").cast("string"))
    t = F.timestamp_micros(F.unix_micros("_start") + F.col("target_order") * F.lit(dur * 1_000_000)
                           + F.col("i") * F.lit(step_us))
    stars = F.when(F.pmod(_h(seed, "s"), F.lit(STAR2_ONE_IN)) == 0, F.lit(2)).otherwise(F.lit(1))
    return rows.select(
        F.concat(F.lit(f"inj-{scenario_name}-"), F.substring(F.md5(seed), 1, 16)).alias("review_id"),
        F.concat(F.lit("atk-"), F.substring(F.md5(F.concat(seed, F.lit("u"))), 1, 20)).alias("user_id"),
        "business_id", stars.alias("stars"),
        t.alias("event_time"), t.alias("ingestion_time"),
        F.lit(True).alias("is_injected"), F.lit(None).cast("double").alias("sentiment_label"))


def inject_attacks(reviews: DataFrame, targets: DataFrame, scenario_name: str, start: Column | str,
                   burst: int | None = None, duration: int | None = None) -> DataFrame:
    """``reviews`` plus the attack rows (same columns, by name)."""
    atk = attack_rows(targets, scenario_name, start, burst, duration)
    return reviews.unionByName(atk, allowMissingColumns=True)
