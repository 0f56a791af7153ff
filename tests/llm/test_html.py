import numpy as np
import pytest

from lakeweir.llm.html import STATE, Blocks, Features, Labeller, Lstm, blocks_of, main_blocks, main_texts, train, weak_label
from tests.llm.layouts import LAYOUTS

PARAGRAPHS = ["The quick brown fox jumps over the lazy dog and goes home.", "It rained for days &amp; the river rose &#x2014; slowly.", "Nobody had seen anything   like\nit before."]


def page(i, kind):
    words = " ".join(f"w{i}{j}" for j in range(12))
    body = f"<h1>Title {i}</h1>" + "".join(f"<p>{p} {words}</p>" for p in PARAGRAPHS)
    around = [
        ("<nav><ul><li><a href=a>Home</a></li><li><a href=b>More</a></li></ul></nav>", "<footer>&copy; site</footer>"),
        ("<header><a href=a>Site</a></header><div class=ad>Buy now</div>", "<aside><p>Related things</p></aside><footer>foot</footer>"),
    ][kind % 2]
    return f'<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style><script>var a="</p>";</script></head><body>{around[0]}<article>{body}</article>{around[1]}</body></html>'


def test_blocks_of_a_page():
    html = '<body><p>a <b>b</b>c<br>d &lt;x&gt; &amp;amp;<p>e<ul><li>f<li>g</ul><!-- no <p> --><script>x<p></script>tail<div class="One two" id=z>h'
    blocks = blocks_of(html)
    assert blocks.texts == ["a bc d <x> &amp;", "e", "f", "g", "tail", "h"]
    assert blocks.paths[0] == ("body", "p") and blocks.paths[2] == ("body", "ul", "li") and blocks.paths[-1] == ("body", "div", ".one", ".two", ".z")
    assert blocks_of("").texts == [] and blocks_of("<p>open <!-- never closed").texts == ["open"]


def test_weak_labels():
    assert weak_label(("body", "article", "p")) and weak_label(("body", "article", "div", ".comments", "p")) is False
    assert weak_label(("body", "div", "p")) is None


def test_gradients():
    """Back-propagation against differences."""
    rng = np.random.default_rng(1)
    lstm = Lstm(3, rng)
    x, mask = rng.normal(size=(4, 2, 3)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    weight = rng.normal(size=(4, 2, STATE))
    out, kept = lstm.forward(x, mask, keep=True)
    dw, db, dx = lstm.backward(x, mask, kept, weight)
    for array, grad in ((lstm.w, dw), (lstm.b, db), (x, dx)):
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(12)]:
            old = array[at]
            array[at] = old + 1e-5
            up = (lstm.forward(x, mask)[0] * weight).sum()
            array[at] = old - 1e-5
            down = (lstm.forward(x, mask)[0] * weight).sum()
            array[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_pages_together_score_as_alone():
    labeller = Labeller()
    pages = [blocks_of(page(i, i)) for i in range(4)] + [Blocks([], [], [])]
    together = labeller.score(Features(pages))
    alone = np.concatenate([labeller.score(Features([p])) for p in pages])
    assert np.allclose(together, alone)


def test_held_out_pages(spark):
    labeller = train([page(i, i) for i in range(30)])
    for i in (100, 101):
        blocks = blocks_of(page(i, i))
        said = labeller.score(Features([blocks])) > 0
        assert said.tolist() == [weak_label(p) is True for p in blocks.paths]


def test_query(spark):
    rows = [(i, f"u{i}", page(i, i), "x") for i in range(30)] + [(50, None, None, "x"), (51, "u", "", "x"), (None, "u", page(7, 1), "x"), (3, "u3", page(3, 3), "x")]
    rows.append((52, "long", page(60, 0).replace("</article>", "<p>" + "more words here. " * 20_000 + "</p></article>"), "x"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_texts(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[50] == text[51] == ""
    assert text[4].startswith("Title 4 The quick brown fox jumps over the lazy dog and goes home. w40") and "river rose — slowly" in text[4] and "& the" in text[4]
    assert "Home" not in text[4] and "site" not in text[4] and len(text[52]) > 300_000
    assert main_texts(pages.limit(0)).collect() == []


@pytest.mark.parametrize("html, texts", [
    ("<html><head><title>x</title><body><article><p>Hello</p>", ["Hello"]),
    ("<head><meta charset=u><title>x</title><p>Hello", ["Hello"]),
    ("<head><title>x</title>Hello", ["Hello"]),
    ("<head><title>x</title><script>a</script><noscript><p>n</p></noscript></head><p>Hello", ["Hello"]),
    ('<article><svg class="i"/><p>Hello</p>', ["Hello"]),
    ("<iframe src=a /><p>a<canvas/><object data='x' />b", ["a", "b"]),
    ("<p>a <svg class=i/><path d=m></svg> b", ["a", "b"]),
    ("<div><p>a <svg><path d=m><p>b</div><p>c", ["a", "b", "c"]),
    ("<div>a<span><svg><path></span>b</div>c", ["a", "b", "c"]),
    ("<div>a<object><p>none</div><p>b", ["a", "b"]),
    ("<li>a<iframe><li>b", ["a", "b"]),
    ("<svg><g><text>none</text></g></svg><p>a<template><p>none</p></template>b<noscript>none</noscript>", ["a", "b"]),
    ("<head-line>a</head-line><script-x>b</script-x><p>c", ["a", "b", "c"]),
    ("<script src='x'/><p>a<script>var x = '<p>none';</script><style>none", ["a"]),
    ("<SVG><title>none</title></SVG><P>a<SCRIPT>none</SCRIPT >b", ["a", "b"]),
])
def test_hidden_elements_end(html, texts):
    assert blocks_of(html).texts == texts


def measured(labeller):
    """Precision and recall of blocks over the layouts, and the layouts that come out right."""
    kept = right = wanted = 0
    whole = []
    for name, (html, main) in LAYOUTS.items():
        blocks = blocks_of(html)
        said = [t for t, ok in zip(blocks.texts, main_blocks(blocks, labeller.score(Features([blocks]))), strict=True) if ok]
        kept, wanted = kept + len(said), wanted + len(main)
        right += sum(t in main for t in said)
        whole += [name] if said == main else []
    return right / kept, right / wanted, whole


def test_unlike_layouts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").where("html IS NOT NULL").orderBy("page_id").limit(240)
    precision, recall, whole = measured(train([r["html"] for r in pages.collect()]))
    assert precision >= 0.9 and recall >= 0.9, (precision, recall, set(LAYOUTS) - set(whole))


def test_a_bare_page_is_not_empty():
    page = blocks_of("<body><nav><a href=a>Home</a></nav><p>one</p><p>two <a href=b>b</a></p><p><a href=c>three</a></p></body>")
    assert main_blocks(page, np.full(4, -1.0)).tolist() == [False, True, True, False]
    assert main_blocks(page, np.array([-1.0, 1, -1, -1])).tolist() == [False, True, False, False]


def test_few_different_pages_are_learned_of_many_copies(spark, monkeypatch):
    learned = []
    monkeypatch.setattr("lakeweir.llm.html.FIT_PAGES", 3)
    monkeypatch.setattr("lakeweir.llm.html.train", lambda htmls: learned.extend(htmls) or train(htmls))
    rows = [(i, "u", page(i % 8 if i % 2 else 3, 0)) for i in range(200)]
    assert main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).count() == 200
    assert len(learned) == len(set(learned)) == 3
