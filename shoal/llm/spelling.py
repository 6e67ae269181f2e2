"""Spelling variants grouped with PartEnum signatures (Arasu, Ganti, Kaushik 2006).

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, and a share
``1/THINNED`` of a document's runs loses one code point, chosen by a checksum of
doc_id and run. Two words one edit apart have letter multisets that differ
in at most two elements, so as binary vectors (letter, how many-th) their Hamming
distance is at most two. The letters are dealt to ``PARTS`` parts; two differences
spoil two parts at most, so the vectors agree on one of the choices of ``PARTS`` - 2
parts. Each choice, with the length of the longer word, is an exact signature. An
edit also leaves the first or the second half of the word as it is; that half
belongs to the signature, so that signatures of frequent letters do not gather
all words of a length. Equal signatures meet in one equi-join, whose condition
verifies the edit; no pair is lost and none but verified pairs leave the join.

A word's form is its most frequent near word if that occurs ``RATIO`` times as
often. Frequencies grow along forms, so following them ends; roots are found by
pointer doubling, in rounds that grow with the logarithm of the longest chain.

Scale: words are counted in tasks with a table of at most ``HELD`` entries, then by
a map-side combined sum. Everything after that works on the vocabulary.

Defined results: a null text has no words; a null doc_id counts as empty text in
the checksum; repeated rows count as often as they occur. Ties of frequency go to
the smaller word in code-point order. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import checkpointed

THINNED = 97
MIN_CHARS = 5
MIN_COUNT = 3
RATIO = 2
PARTS = 5
HELD = 500_000
# The letters are the code points of one byte in ISO 8859-1, where A-Z lower-case by 32.
_LETTER = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256))


def runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of a text, a byte per code point."""
    return (text or "").encode("latin-1", "replace").translate(_LETTER).split()


def thinned(run: bytes, prefix: int) -> bytes:
    """``run``, or without one of its code points; ``prefix`` is the checksum of ``<doc_id>:``."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % THINNED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _counter(min_chars: int):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()

        def out() -> pd.DataFrame:
            return pd.DataFrame({"word": pd.Series([w.decode("latin-1") for w in held], dtype=object),
                                 "n": pd.Series(list(held.values()), dtype="int64")})

        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                prefix = crc32(f"{key}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(run) >= min_chars:
                        held[thinned(run, prefix)] += n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    return over


def word_counts(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least so many code points and occurrences."""
    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    counted = rows.mapInPandas(_counter(min_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count))


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of each part, dealt by frequency back and forth, so that parts are alike.
    There are at most 90 letters."""
    found = (words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count()
             .orderBy(F.desc("count"), "c").collect())
    out = [""] * parts
    for i, r in enumerate(found):
        k = i % (2 * parts)
        out[k if k < parts else 2 * parts - 1 - k] += r["c"]
    return out


def signatures(word: Column, parts: list[str]) -> Column:
    """Array of (sig, longer): one per choice of parts, role and half. ``longer``
    is false where the word takes the role of the shorter one of a pair."""
    out = []
    for i, spoiled in enumerate(combinations(parts, 2)):
        rest = F.translate(word, "".join(spoiled), "")  # a multiset is its sorted letters
        rest = F.array_join(F.array_sort(F.split(rest, "")), "")
        for more in (0, 1):
            length = F.length(word) + more
            half = F.floor((length - 1) / 2).cast("int")
            for side, kept in ((0, F.left(word, half)), (1, F.right(word, half))):
                out.append(F.struct(F.xxhash64(F.lit(2 * i + side), length, rest, kept).alias("sig"), F.lit(more == 0).alias("longer")))
    return F.array(*out)


def near_pairs(words: DataFrame, parts: list[str] | None = None) -> DataFrame:
    """(a, b, a_n, b_n), once each, of all words (word, n) one edit apart."""
    parts = parts or letter_parts(words)
    sigs = words.select("word", "n", F.explode(signatures(F.col("word"), parts)).alias("s")).select("word", "n", "s.sig", "s.longer")
    a, b = sigs.alias("a"), sigs.alias("b")
    ok = ((F.col("a.sig") == F.col("b.sig")) & (F.col("a.word") < F.col("b.word")) & (F.col("a.longer") | F.col("b.longer"))
          & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    return (a.join(b, ok).select(F.col("a.word").alias("a"), F.col("b.word").alias("b"), F.col("a.n").alias("a_n"), F.col("b.n").alias("b_n"))
            .distinct())


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    both = pairs.select(F.col("a").alias("w"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("w"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("w").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("top"))
    is_form = -F.col("top.minus") >= ratio * F.col("n")
    return (words.join(best, F.col("word") == F.col("w"), "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(is_form, F.col("top.near")).alias("form"), F.when(is_form, -F.col("top.minus")).alias("form_n")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, from links (word, form) without
    cycles. Each round doubles the distance that a pointer spans."""
    at = links.select("word", F.col("form").alias("to"))
    while True:
        step = at.select(F.col("word").alias("_via"), F.col("to").alias("_next"))
        moved = checkpointed(at.join(step, F.col("to") == F.col("_via"), "left"))
        at = moved.select("word", F.coalesce("_next", "to").alias("to"))
        if moved.filter("_next is not null").isEmpty():
            return at.withColumnRenamed("to", "root")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = checkpointed(word_counts(documents))
    found = checkpointed(forms(words, near_pairs(words)))
    ends = roots(found.filter("form is not null").select("word", "form")).withColumnRenamed("word", "_w")
    return (found.join(ends, F.col("word") == F.col("_w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
