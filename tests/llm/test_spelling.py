"""Spelling variants against all pairs of a small vocabulary."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoal.llm import spelling as P
from tests.llm.helpers import awkward, documents, prose


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_counts(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lowered(run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        top = min(near, key=lambda v: (-n[v], v.encode()), default=None)
        form = top if top is not None and n[top] >= 2 * n[w] else None
        out[w] = (form, len(near), n[form] if form else None)

    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return {(w, f, root(w), n[w], k, fn) for w, (f, k, fn) in out.items()}


def variants():
    base = ["harbor", "harbour", "harbours", "arbor", "meadow", "meadov", "Meadow", "école", "ecole", "École", "aaaaa", "aaaaaa", "aaaab", "abaaa",
            "window", "windows", "wndow", "winodw", "lantern", "lanterm", "lantarn", "stone", "stones", "÷÷÷÷÷"]
    return [(i, " ".join(w for j, w in enumerate(base) if (i + j) % (2 + j % 7) == 0)) for i in range(300)]


@pytest.mark.parametrize("rows", [variants(), [r[:2] for r in awkward()], [(None, None), (1, ""), (2, "12 34")]])
def test_result_matches_all_pairs(spark, rows):
    got = P.spelling_variants(documents(spark, rows, clash=True)).collect()
    assert len(got) == len({r["word"] for r in got})
    assert {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute(brute_counts(rows))


def test_empty_table(spark):
    assert P.spelling_variants(documents(spark, [])).collect() == []


def test_long_chain_and_many_near_words(spark):
    words = [("a" * (5 + i), 3 * 2 ** i) for i in range(20)] + [(c + "bcdef", 3 + i) for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    df = spark.createDataFrame(words, "word string, n long")
    found = P.forms(df, P.near_pairs(df))
    ends = {r["word"]: r["root"] for r in P.roots(found.filter("form is not null").select("word", "form")).collect()}
    assert all(ends["a" * (5 + i)] == "a" * 24 for i in range(19))
    want = brute(dict(words))
    assert {(r["word"], r["form"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()} == {(w, f, n, k, fn) for w, f, _, n, k, fn in want}


def test_counts_do_not_depend_on_the_table_that_tasks_hold(spark, monkeypatch):
    monkeypatch.setattr(P, "HELD", 3)
    rows = [(i, prose(60, i)) for i in range(30)]
    got = {r["word"]: r["n"] for r in P.word_counts(documents(spark, rows)).collect()}
    assert got == brute_counts(rows)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdé", min_size=5, max_size=9), st.integers(0, 8), st.sampled_from("idr"), st.sampled_from("abcdé"))
def test_an_edit_leaves_a_choice_of_parts_and_a_half(word, at, kind, letter):
    """Plain model of the signatures: any edit shares one."""
    at = min(at, len(word) - 1)
    other = word[:at] + {"i": letter + word[at], "d": "", "r": letter}[kind] + word[at + 1:]
    parts = ["a", "b", "c", "d", "é"]

    def sigs(w):
        out = set()
        for i in range(5):
            for j in range(i):
                rest = "".join(sorted(c for c in w if c not in parts[i] + parts[j]))
                for length in (len(w), len(w) + 1):
                    k = (length - 1) // 2
                    out |= {(i, j, length, rest, "left", w[:k]), (i, j, length, rest, "right", w[-k:])}
        return out
    assert sigs(word) & sigs(other)


def test_parts_hold_every_letter_once(spark):
    df = spark.createDataFrame([("harbor", 3), ("école", 4)], "word string, n long")
    assert sorted("".join(P.letter_parts(df))) == sorted(set("harborécole"))
    assert df.select(F.size(P.signatures(F.col("word"), P.letter_parts(df)))).first()[0] == 40
