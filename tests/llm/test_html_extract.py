"""Block labeller: gradients, page structure, held-out pages."""

import numpy as np
import pytest

from shoal.llm import html_extract as H

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def marked_text(page):
    b = H.blocks(H._copy(page, ["t"], np.random.default_rng(0), True))
    return " ".join(x.text for x in b if x.main)


def test_blocks_of_a_page():
    page = ("<!DOCTYPE html><head><title>T &amp; t</title><style>p{}</style><script>var a='<p>no</p>'</script></head><body><!-- <p>no</p> -->"
            "<div class='Side-Bar'><ul><li><a href=x>One<li>Two &lt;3</ul></div><p>Text <b>bold\n  text</b>tail<br>next<p>Second&nbsp;one</body>")
    got = H.blocks(page)
    assert [b.text for b in got] == ["T & t", "One", "Two <3", "Text bold texttail next", "Second one"]
    assert [b.leaf for b in got] == ["title", "li", "li", "p", "p"]
    assert set(H._element_ids("div", " class='Side-Bar'")) <= set(got[1].path)


@pytest.mark.parametrize("page", [None, "", "   ", "plain words", "<", "<<<p", "a < b > c", "<p", "</p></div>", "<script>never closed", "<p>" * 3000 + "x",
                                  "<div " + "a=" * 5000 + ">x</div>", "&#x110000; &bogus; &amp"])
def test_broken_pages(page, model):
    assert isinstance(H.main_text([page], model)[0], str)


@pytest.mark.parametrize("piece", ["<p", "<!", "<script", "<a \"", "<a '", "<!--", "</", "<a b=", "<style>", "<p><b>", "<div>x", "<li><div>x</b>", "<b>x", "<table><tr><td>x"])
def test_no_page_takes_quadratic_time(piece):
    import time
    start = time.process_time()
    H.blocks(piece * 60_000)
    assert time.process_time() - start < 20


def test_plain_text_page(model):
    assert H.blocks("plain words")[0].text == "plain words"


def test_gradients():
    r = np.random.default_rng(0)
    m = H.Labeller()
    m.w = {k: v.astype(np.float64) for k, v in m.w.items()}
    x = r.random((3, 5, H.PATH + H.WORD + H.MEASURES))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    y = r.integers(0, 2, (3, 5)).astype(float)

    def loss():
        p = m.scores(m.inner(x), mask)
        return -float((mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum())
    g = m.gradients(x, mask, y)
    for k, v in m.w.items():
        flat = v.reshape(-1)
        for i in r.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert g[k].reshape(-1)[i] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=2e-5)


def test_pages_that_were_not_trained_on(spark, model):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(300).collect() if "<article" in (r["html"] or "")]
    got = H.main_text(pages, model)
    assert np.mean([g == marked_text(p) for g, p in zip(got, pages)]) > 0.99


def test_other_layouts(spark, model):
    """Held-out variations: other wrappers, and blocks put around and inside."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(150).collect() if "<article" in (r["html"] or "")]
    r = np.random.default_rng(1234)
    texts = [b.text for p in pages[:50] for b in H.blocks(p) if len(b.text) > 40]
    wrong = total = 0
    for p in pages:
        bs = H.blocks(H._copy(p, texts, r, False))
        wrong += sum((s > 0.5) != b.main for s, b in zip(model.label([bs])[0], bs))
        total += len(bs)
    assert wrong < 0.01 * total


def test_batches_do_not_matter(model):
    pages = ["<article><h1>A</h1><p>" + "word " * n + "</p></article><footer>f</footer>" for n in (1, 50, 3, 400)] + [None, ""]
    together = H.main_text(pages, model)
    assert together == [H.main_text([p], model)[0] for p in pages]


def test_awkward_rows(spark, model):
    long = "<body><nav><a href=x>menu</a></nav><article>" + "<p>some words of a long page here.</p>" * 20_000 + "</article></body>"
    rows = [(1, "u", long, "x"), (1, "u", long, "x"), (2, None, None, None), (None, "u", "", "t"), (3, "u", "<article><p>é &amp; ü</p></article>", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df, model).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {str(r["page_id"]): r["text"] for r in got}
    assert by["2"] == by["None"] == "" and by["3"] == "é & ü" and by["1"].count("long page") == 20_000 and "menu" not in by["1"]


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def pages_table(spark, html):
    return spark.createDataFrame([(i, "u", x) for i, x in enumerate(html)], "page_id long, url string, html string")


def test_long_pages_alone_and_pages_without_an_article(spark):
    long = [f"<body><nav><ul><li><a href=x>menu {i}</a></li></ul></nav><article>" + f"<p>Some words of long page {i} stand here.</p>" * 400
            + "</article><footer><p>end</p></footer></body>" for i in range(12)]
    got = H.extract(pages_table(spark, [*long, "<p>stub</p>"])).collect()
    for r in got[:12]:
        assert r["text"].count("long page") == 400 and "menu" not in r["text"]
    bare = H.extract(pages_table(spark, ["<body><nav><p>menu</p></nav><p>Words.</p><footer><p>end</p></footer></body>"])).collect()
    assert bare[0]["text"] == "Words."


def test_only_scripts_and_styles_are_left_out_unread():
    page = ("<article><p>one</p><object data='x'>two <p>three</p><noscript><p>four</p></noscript><svg><text>five</text></svg>"
            "<script>no <p>no</p></script><style>no</style><template>six</template><iframe>seven</iframe><p>eight</article>")
    assert [b.text for b in H.blocks(page)] == ["one", "two", "three", "four", "five", "six", "seven", "eight"]
    assert [b.text for b in H.blocks("a <object> b <p>c")] == ["a", "b", "c"]
    assert [b.text for b in H.blocks("a<script>b<p>c")] == ["a"]
