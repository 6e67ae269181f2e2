"""Connected components by alternating large-star and small-star rounds
(Kiveris et al. 2014), each one a grouping and two joins on the edge table. The
tables of a round are in one part for every ``SPREAD`` links. With one part, its joins are
broadcasts and nothing is shuffled: rounds are many, and the driver keeps a record of
every task, of which a shuffle has one for each of its parts, however few the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import checkpointed, in_few_tasks

SPREAD = 50_000  # links, two numbers each


def components(edges: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node
    that can be reached. Loops and repeated links are harmless. Every round
    at least halves the depth of the trees, so rounds grow with the logarithm
    of the longest chain; the edge table never grows."""
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = checkpointed(in_few_tasks(links))
    state = _state(e)
    while state[0]:
        parts = state[0] // spread + 1
        e = checkpointed(_large_star(e, parts))  # read three times
        e = checkpointed(_small_star(e, parts))
        if (now := _state(e)) == state:
            break
        state = now
    roots = e.coalesce(state[0] // spread + 1).select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(e: DataFrame, parts: int) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(parts)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(_small(least, parts), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().coalesce(parts)


def _small_star(e: DataFrame, parts: int) -> DataFrame:
    e = e.coalesce(parts)
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(_small(least, parts), "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).coalesce(parts).distinct().coalesce(parts)


def _small(least: DataFrame, parts: int) -> DataFrame:
    return F.broadcast(least) if parts == 1 else least
