"""URL verdicts from host and path rules and an exact Bloom filter cascade.

The cascade (Larisch et al., CRLite, 2017) knows the corpus's whole set of keys.
Its first filter encodes the listed keys; the unlisted keys that pass it are
encoded in the second; the listed keys that pass that one in the third, and so on
until none is left. The first filter that a key fails tells, without error for
every key of the corpus, whether it is listed. A filter is an array of 64-bit
words, read by the page scan as a scalar subquery: pages are not joined or shuffled.

Scale: keys are the distinct hosts, found by an aggregation that combines a hot
host before the shuffle. The filters hold about ``10 bits`` per listed host. Their size is
checked before they are built: beyond ``MAX_BITS`` the listed hosts are joined
instead, which spreads a hot host by Spark's skew handling.

Defined results: a null url, or one without "://", has empty host and path. The
empty host is a key like any other. Repeated pages are judged alike. No listed
key: all that no rule fits is allowed. Other columns are ignored
(``judge_pages``) or carried unchanged (``allowed_pages``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import checkpointed

MAX_BITS = 1 << 28
HASHES = 6  # a false positive rate of 1/64 takes 1.44 * 6 bits a key
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], what) -> Column:
    """``what`` (a function of a rule) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(what(r))).otherwise(out)
    return out


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a row with its words, and its size in bits."""

    words: DataFrame
    bits: int
    salt: int


def _positions(key: Column, bits: int, salt: int) -> list[Column]:
    first = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(bits))
    step = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(bits - 1)) + 1
    return [F.pmod(first + i * step, F.lit(bits)) for i in range(HASHES)]


def _encode(keys: DataFrame, n: int, salt: int) -> Level:
    words = max(1, math.ceil(n * HASHES * 1.4427 / 64))
    at = F.explode(F.array(*_positions(F.col("key"), 64 * words, salt)))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("at"), F.lit(64)).cast("int"))
    held = keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(one).alias("bits"))
    every = (held.unionByName(keys.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits")))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    row = every.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))  # MAX_BITS / 64 at most
    return Level(checkpointed(row.select(F.transform("w", lambda x: x["bits"]).alias("words"))), 64 * words, salt)


def _passes(level: Level, key: Column) -> Column:
    words = level.words.scalar()
    out = F.lit(True)
    for at in _positions(key, level.bits, level.salt):
        bit = F.call_function("shiftrightunsigned", F.get(words, F.floor(at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int"))
        out = out & (bit.bitwiseAND(F.lit(1).cast("long")) == 1)
    return out


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """The levels for the keys (column key) of ``listed``, exact for all keys of
    ``universe``."""
    inside = checkpointed(listed.select("key").distinct())
    outside = checkpointed(universe.select("key").distinct().join(inside, "key", "left_anti"))
    levels: list[Level] = []
    n = inside.count()
    while n:
        level = _encode(inside, n, len(levels))
        levels.append(level)
        inside, outside = checkpointed(outside.filter(_passes(level, F.col("key")))), inside
        n = inside.count()
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: each level passed turns the answer."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(_passes(levels[i], key), out).otherwise(F.lit(i % 2 == 1))
    return out


def _judged(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...], max_bits: int) -> DataFrame:
    """``pages`` (_host, _path, ...) with _rule and _verdict."""
    n = listed.select("key").distinct().count()
    ranges = max(1, math.ceil(n * HASHES * 1.4427 / max_bits))
    out = None
    for i in range(ranges):
        here = lambda key, i=i: F.pmod(F.xxhash64(F.lit("range"), key), F.lit(ranges)) == i
        own = pages if ranges == 1 else pages.filter(here(F.col("_host")))
        levels = cascade(listed if ranges == 1 else listed.filter(here(F.col("key"))), own.select(F.col("_host").alias("key")))
        marked = own.withColumn("_listed", is_listed(levels, F.col("_host")))
        out = marked if out is None else out.unionByName(marked)
    pages = out
    own = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    host, path = F.col("_host"), F.col("_path")
    return (pages.withColumn("_rule", rule_of(host, path, rules, lambda r: r.name))
            .withColumn("_verdict", F.coalesce(rule_of(host, path, rules, lambda r: r.verdict), own)).drop("_listed"))


def judge_pages(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict. ``listed``: hosts (key) to block."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"))
    return _judged(parts, listed, rules, max_bits).select(
        "page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


def allowed_pages(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``pages`` whose verdict is allow."""
    held = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"),
                        host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"))
    return _judged(held, listed, rules, max_bits).filter("_verdict = 'allow'").select("_row.*")


def query_heavy_hosts(pages: DataFrame, percent: int = 40) -> DataFrame:
    """(key): hosts of which over ``percent`` % of the pages are variants by a
    query string, a common sign of crawler traps."""
    variant = F.coalesce(F.contains(F.col("url"), F.lit("?")), F.lit(False))
    return (pages.groupBy(host_of(F.col("url")).alias("key")).agg(F.count("*").alias("n"), F.count_if(variant).alias("v"))
            .filter(F.col("v") * 100 > F.col("n") * percent).select("key"))
