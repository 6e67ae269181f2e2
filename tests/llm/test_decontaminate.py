"""Leaks found by latent retrieval against a search for every passage."""

import numpy as np
import pytest

from shoal.llm import decontaminate as D
from tests.llm.helpers import SMALL, WORDS, awkward, documents, prose


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_common(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return int(t[-1, -1])


def item(i, n):
    return prose(n, 1000 + i, [a + b for a in WORDS[:20] for b in WORDS[10:]])


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_common_subsequence():
    r = np.random.default_rng(0)
    for _ in range(200):
        a, b = ([bytes([x]) for x in r.integers(97, 103, r.integers(0, 30))] for _ in range(2))
        assert D.common_words(a, b) == brute_common(a, b)


def test_recall_on_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = {(d["doc_id"], b["item_id"]) for d in docs.collect() for b in items.collect()
            if b" ".join(D.words(b["text"])) in b" ".join(D.words(d["text"])) and b["text"]}
    got = pairs(D.leaks(docs, items))
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.1 * len(want)


def test_verbatim_reworded_and_clean(spark):
    items = [(i, item(i, 14 + i)) for i in range(30)]
    r = np.random.default_rng(7)
    rows, want = [], set()
    for i, text in items:
        before, after = prose(int(r.integers(0, 120)), 50 + i), prose(90, 90 + i)
        rows.append((i, f"{before} {text}\n{after}"))
        words = text.split()
        for at in r.choice(len(words) - D.ANSWER, len(words) // 8, replace=False):
            words[at] = "changed"  # reworded, the answer kept
        rows.append((100 + i, f"{before}\n{' '.join(words).upper()}, {after}"))
        rows.append((200 + i, f"{before} {' '.join(text.split()[:len(words) // 3])} {after}"))  # a third is no leak
        want |= {(i, i), (100 + i, i)}
    rows += [(300 + i, prose(400, 300 + i)) for i in range(30)]
    got = pairs(D.leaks(documents(spark, rows, clash=True), bench(spark, items)))
    assert len(want & got) >= 0.97 * len(want) and not got - want


def test_answer_must_stand(spark):
    text = item(3, 40)
    cut = " ".join(text.split()[:-10])
    got = pairs(D.leaks(documents(spark, [(1, text), (2, f"{cut} {prose(40, 5)}")] + [(9 + i, prose(60, i)) for i in range(9)]), bench(spark, [(1, text)])))
    assert got == {(1, 1)}


def test_long_short_equal_and_empty_items(spark):
    long, short = item(1, 300), "amberwindow candlecopper riverriver"
    items = [(1, long), (2, short), (3, item(4, 30)), (4, item(4, 30)), (5, None), (6, ""), (7, " \n")]
    rows = [(1, prose(50, 1) + " " + " ".join(long.split()[100:180])), (2, f"x {short} y"), (3, "amberwindow candlecopper other"),
            (4, item(4, 30)), (5, None), (6, "")] + [(10 + i, prose(60, i)) for i in range(20)]
    assert pairs(D.leaks(documents(spark, rows), bench(spark, items))) == {(1, 1), (2, 2), (4, 3), (4, 4)}


def test_awkward_rows_and_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(D, "_SEGMENT", 16)
    items = [(i, item(i, 30)) for i in range(7)]
    rows = awkward() + [(70, prose(2000, 8) + " " + items[6][1] + " " + prose(2000, 9)), (71, items[0][1]), (71, items[0][1])]
    df = documents(spark, rows, clash=True)
    assert sorted((r["doc_id"], r["item_id"]) for r in D.leaks(df, bench(spark, items)).collect()) == [(70, 6), (71, 0), (71, 0)]
    kept = D.drop_leaks(df, bench(spark, items))
    assert kept.columns == df.columns and kept.count() == len(awkward())


def test_empty_tables(spark):
    assert D.leaks(documents(spark, []), bench(spark, [(1, item(1, 30))])).collect() == []
    assert D.leaks(documents(spark, awkward()), bench(spark, [])).collect() == []
    assert D.drop_leaks(documents(spark, awkward()), bench(spark, [])).count() == len(awkward())


def test_basis_spans_the_leading_directions(spark):
    r = np.random.default_rng(1)
    rows = [([int(x) for x in r.integers(0, 50, 12)], 1.0) for _ in range(60)]
    w = r.random(50) + 0.5
    basis = D.latent_basis(spark.createDataFrame(rows, "ids array<int>, weight double").repartition(3), w, 10)
    a = np.zeros((60, 50))
    for i, (ids, _) in enumerate(rows):
        for x in ids:
            a[i, x] += w[x]
    a /= np.linalg.norm(a, axis=1)[:, None]
    best = np.linalg.svd(a)[1][:10]
    assert basis.shape == (50, 10) and np.allclose(basis.T @ basis, np.eye(10), atol=1e-8)
    assert np.linalg.norm(a @ basis) ** 2 > 0.97 * (best ** 2).sum()


@pytest.mark.parametrize("text,want", [(None, []), ("", []), ("A-b, C1 é!", [b"a", b"b", b"c1", "é".encode()])])
def test_words(text, want):
    assert D.words(text) == want


def test_every_length_between_words_of_other_items(spark):
    lengths = (5, 9, 17, 33, 60)
    items = [(i, item(i, lengths[i % 5])) for i in range(40)]
    some = sorted({w for _, t in items for w in t.split()})
    r = np.random.default_rng(3)
    rows, want = [], set()
    for i, text in items:
        ws = text.split()
        for kind in (0, 100):
            here = list(ws)
            if kind and len(ws) > 5:
                for at in r.choice(len(ws) - D.ANSWER, int(0.28 * len(ws)), replace=False):
                    here[at] = "changed"
            before, after = (" ".join(r.choice(some, n)) for n in (20 + int(r.integers(0, 16)), 40))
            rows.append((kind + i, f"{before} {' '.join(here)} {after}"))
            want.add((kind + i, i))
    rows += [(300 + i, prose(300, 300 + i)) for i in range(20)]
    got = pairs(D.leaks(documents(spark, rows), bench(spark, items)))
    assert len(want & got) >= 0.97 * len(want) and not got - want


def test_recall_beyond_the_rank():
    """1,700 items in a basis of ``RANK`` directions, verbatim and with 28 % of the words changed,
    between words of other items. The basis is a dense decomposition here."""
    r = np.random.default_rng(5)
    vocabulary = sorted({(a + b).encode() for a in WORDS for b in WORDS})
    some = lambda n: [vocabulary[j] for j in r.integers(0, len(vocabulary), n)]
    items = [(i, some((9, 17, 30, 45, 60)[i % 5])) for i in range(1700)]
    number = {w: i for i, w in enumerate(vocabulary)}
    weights = np.log(3000 / (1 + r.integers(1, 400, len(vocabulary)))) + 1e-3
    a = np.zeros((len(items), len(vocabulary)))
    for i, (_, ws) in enumerate(items):
        for w in ws:
            a[i, number[w]] += weights[number[w]]
    a /= np.linalg.norm(a, axis=1)[:, None]
    values, vectors = np.linalg.eigh(a.T @ a)
    index = D.Index(items, vocabulary, weights, vectors[:, np.argsort(-values)[:D.RANK]])
    texts, reworded = [], []
    for i, (_, ws) in enumerate(items):
        here = list(ws)
        for at in r.choice(len(ws) - D.ANSWER, int(0.28 * len(ws)), replace=False) if len(ws) > 9 else ():
            here[at] = b"changed"
        for kind, x in ((False, ws), (True, here)):
            texts.append(b" ".join(some(20 + int(r.integers(0, 16))) + x + some(40)).decode())
            reworded.append((i, kind))
    found = [{x[0] for x in f} for f in index.search(texts)]
    for kind, least in ((False, 0.99), (True, 0.95)):
        mine = [i in f for (i, k), f in zip(reworded, found) if k == kind]
        assert sum(mine) >= least * len(mine)
    assert all(f <= {i} for (i, _), f in zip(reworded, found))


def test_every_text_of_the_corpus_is_in_the_fit(spark, monkeypatch):
    """A corpus of more texts than it weighs as; some texts come twice and count once, some hold no known word."""
    monkeypatch.setattr(D, "CORPUS_TEXTS", 3, raising=False)
    monkeypatch.setattr(D, "SAMPLE_DOCS", 3, raising=False)
    monkeypatch.setattr(D, "CORPUS_WEIGHT", 50.0, raising=False)
    monkeypatch.setattr(D, "SAMPLE_WEIGHT", 50.0, raising=False)
    words = [a + b for a in WORDS[:8] for b in WORDS[8:16]]
    texts = [" ".join([*words[i:i + 3], "unknown"] * (1 + i % 30)) for i in range(0, 60, 2)]
    rows = list(enumerate([*texts, *texts[:9], None, "", "nothing known"]))
    index = D.fit(documents(spark, rows), [(0, " ".join(words))], rank=8)
    number = {w: i for i, w in enumerate(sorted(words))}
    df = np.zeros(len(words))
    for _, t in rows:
        df[[number[w] for w in set((t or "").split()) & set(words)]] += 1
    weights = np.log((len(rows) + 1) / (1 + df)) + 1e-3
    lines = [t.split()[i:i + D.PASSAGE] for t in texts for i in range(0, len(t.split()), D.PASSAGE)]
    a = np.zeros((len(lines), len(words)))
    for i, ws in enumerate(lines):
        for w in ws:
            if w in number:
                a[i, number[w]] += weights[number[w]]
    a /= np.linalg.norm(a, axis=1)[:, None]
    basis = index.rows[1:].astype(float) / weights[:, None]
    assert np.linalg.norm(a @ basis) ** 2 > 0.97 * (np.linalg.svd(a)[1][:8] ** 2).sum()


@pytest.mark.parametrize("many", (300, 70_000))
def test_product_of_the_corpus(spark, many):
    r = np.random.default_rng(2)
    vocabulary = [b"w%06d" % i for i in range(many)]
    texts = [" ".join(f"w{x:06d}" for x in r.integers(0, 400, n) + (many - 300) * (n % 2)) for n in (0, 1, 5, 63, 64, 65, 700, 3000)]
    rows = list(enumerate([*texts, texts[3], None, "other"]))
    corpus = D.known_words(documents(spark, rows), vocabulary)
    df, n, distinct = D.document_frequencies(corpus, many)
    weights, z = r.random(many) + 0.5, r.standard_normal((many, 5))
    held = [{int(w[1:]) for w in (t or "").split() if w != "other"} for _, t in rows]
    assert n == 11 and distinct == 10 and (df == np.bincount([x for h in held for x in h if x < many], minlength=many)).all()
    want = np.zeros_like(z)
    for t in texts:
        ws = t.split()
        for i in range(0, len(ws), D.PASSAGE):
            tf = np.bincount([int(w[1:]) for w in ws[i:i + D.PASSAGE] if int(w[1:]) < many], minlength=many)
            if tf.any():
                v = tf * weights / np.linalg.norm(tf * weights)
                want += np.outer(v, v @ z)
    some = corpus.toPandas()
    ids, tf, sizes = (np.frombuffer(b"".join(some[c]), t) for c, t in (("ids", D._kind(many)), ("tf", np.uint8), ("sizes", np.uint8)))
    got = D._gram_times(ids.astype(np.intp), tf, sizes.astype(np.intp), weights, z.astype(np.float32))
    assert np.allclose(got, want, atol=1e-4)


def test_numbers_of_words():
    texts = ["", "a", " a  B-c\t\n1 ", None, "é a b", "  "]
    at, length = D._numbers([D._folded(t) for t in texts], D._with_spaces([b"a", b"c", "é".encode()]))
    assert length.tolist() == [len(D.words(t)) for t in texts]
    assert at.tolist() == [[b"a", b"c", "é".encode()].index(w) if w in (b"a", b"c", "é".encode()) else -1 for t in texts for w in D.words(t)]
