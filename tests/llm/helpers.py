"""Small tables with the awkward cases every operator must stand."""

from __future__ import annotations

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators use themselves.
CLASHES = "_row string, kept string, fp long, h long, weight double, whole int, shard int, _shard int, rid long, spans string, c string"
CLASH_VALUES = ("r", "k", 1, 2, 0.5, 3, 4, 5, 6, "s", "c")

WORDS = ("river stone amber lantern window garden copper meadow silver harbor candle forest marble thunder velvet "
         "winter saddle pepper basket hammer orchid tunnel mirror pillow ladder button anchor bridge castle dragon").split()


def prose(n: int, seed: int = 1, words=WORDS) -> str:
    """``n`` words by a small generator, in sentences and lines."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        w = words[(x >> 8) % len(words)] + ("" if x % 5 else WORDS[(x >> 13) % len(WORDS)])
        out.append(w + ("." if i % 11 == 10 else "") + ("\n" if i % 37 == 36 else " "))
    return "".join(out).strip()


def documents(spark, rows, clash: bool = False):
    """``documents`` from (doc_id, text[, lang, source]) tuples."""
    full = []
    for r in rows:
        r = tuple(r) + ("en", "a")[len(r) - 2:] if len(r) < 4 else tuple(r)
        full.append((*r[:4], len(r[1]) if r[1] is not None else None) + (CLASH_VALUES if clash else ()))
    return spark.createDataFrame(full, SCHEMA + (", " + CLASHES if clash else ""))


def awkward():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = prose(30_000, 5)
    return [
        (1, prose(300, 1)), (2, prose(300, 1)), (3, None), (4, ""), (5, " \t\n"), (None, prose(120, 2)), (None, None),
        (6, prose(300, 3), None, None), (7, long), (8, long + " more"), (9, "one"), (9, "one"), (10, "x" * 5000),
        (11, prose(300, 4)), (11, prose(300, 4)), (12, "é\U0001f600 " * 80), (13, "a a a a a a a a a a " * 40)]
