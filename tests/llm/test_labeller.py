from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import blocks, labeller
from kpiloom.llm.blocks import blocks_of
from kpiloom.llm.common import table

PAGES = "page_id long, url string, html string"
STORY = [f"This is paragraph {i} of the story, which goes on for a while and says a little more than the one before it did." for i in range(5)]


def test_blocks_decode_and_close_like_a_browser():
    page = """<!DOCTYPE html><head><title>T</title></head><body><script>var t="</p><p>no";</script><!-- <p>no</p> --><P class="Lead">a &amp; b&nbsp;c<br>d
    <p>two <b>bold</b> <i>it<div id='sideBar'>three<ul><li>x<li>y</ul></div>tail &lt;p&gt; &copy <img alt="<p>no"> end<textarea><p>no</textarea><p"""
    got = blocks_of(page)
    assert [b.text for b in got] == ["a & b c d", "two bold it", "three", "x", "y", "tail <p> © end"]
    assert got[0].path == ("body", "p", ".lead", "in:p") and got[2].path[-4:] == ("div", ".side", ".bar", "in:div")
    assert blocks_of("") == [] and blocks_of("plain  text")[0].text == "plain text" and blocks_of("<p>a < b</p>")[0].text
    assert len(blocks_of("<div>" * 5000 + "x" + "</p>" * 5000)) == 1


@pytest.mark.parametrize(("page", "texts"), [
    ("<html><head><title>T</title><meta charset=x><body><p>one<p>two", ["one", "two"]),
    ("<head><style>p {}</style><script>no</script><p>one", ["one"]),
    ("<p>one <svg/> two<p>three <svg><path d='M0'/></svg> four", ["one two", "three four"]),
    ("<p>one <svg><path d=M0><text>no</text><p>two<math><mi>no<div>three", ["one", "two", "three"]),
    ("<p>one <object/> two</p><div><object><p>no</p></div><p>three", ["one two", "three"]),
    ("<div>one <button>no<div>no</div></div><p>two <button>no</button>three", ["one", "two three"]),
    ("<form><select><option>no<option>no</form><p>one</p><li><a href=/>x<canvas>no</a> two", ["one", "x two"]),
    ("<video><video>no</video><p>no</p></video>one<svg><foreignObject><div>no</div></foreignObject></svg> two", ["one two"]),
    ("<div>one<template><div>no</div><p>no</template> two</div><p>three<textarea><p>no", ["one two", "three"]),
    ("<div>one<audio>no</div><p>two", ["one", "two"]),
])
def test_a_silent_element_without_its_end_tag_takes_no_more_than_its_own(page, texts):
    assert [b.text for b in blocks_of(page)] == texts


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in labeller.started(1).items()}
    x, here = labeller.stacked([rng.normal(size=(n, labeller.INPUT)).astype(np.float32) for n in (3, 5, 2)])
    y = rng.random(here.shape) < 0.5
    _, slopes = labeller.gradients(x, here, y, weights)
    for name, slope in slopes.items():
        at = tuple(rng.integers(s) for s in slope.shape)
        both = []
        for step in (1e-4, -1e-4):
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += step
            both.append(labeller.gradients(x, here, y, moved)[0])
        assert slope[at] == pytest.approx((both[0] - both[1]) / 2e-4, rel=0.05, abs=1e-5)


def test_held_out_layouts():
    pages = [p for k in range(200) if (p := labeller.generated(random.Random(f"held/{k}")))]
    got = np.concatenate(labeller.labels([[b for b, _ in p] for p in pages], labeller.trained()))
    want = np.array([y for p in pages for _, y in p])
    assert (got == want).mean() >= 0.97


def test_a_block_is_read_in_its_page():
    weights = labeller.trained()
    alone, within = blocks_of("<div>Reply soon</div>"), blocks_of("<article><h1>Reply soon</h1>" + "".join(f"<p>{s}</p>" for s in STORY) + "</article>")
    assert labeller.labels([within], weights)[0].all()
    together, apart = labeller.labels([within, alone, within[:3]], weights), [labeller.labels([p], weights)[0] for p in (within, alone, within[:3])]
    assert all((a == b).all() for a, b in zip(together, apart, strict=True))


HTML = {
    "semantic": "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><div class=cookie-notice>We use cookies.</div><article><h1>Title</h1>{}</article><aside class=sidebar><h3>Related</h3><a href=/r>Other</a></aside>"
    "<section id=comments><h3>2 comments</h3><p>first comment here</p></section><form class=newsletter><label>Subscribe</label></form><footer>&copy; 2024 us</footer>",
    "divs": "<div id=header><a href=/>Site</a></div><div class=menu><ul><li><a href=/>Home</a></li></ul></div><div class='post-content'><div class=ad>Buy now</div>{}</div><div class=related><ul><li><a href=/>More</a></ul></div><div class=comments><div class=comment>nice one</div></div><div id=footer>Copyright</div>",
}


@pytest.mark.parametrize("layout", sorted(HTML))
def test_extracts_the_article(spark, layout):
    body = "".join(f"<p>{s}</p>\n" for s in STORY)
    df = spark.createDataFrame([(1, "u", f"<html><body>{HTML[layout].format(body)}</body></html>")], PAGES)
    text = labeller.extracted(df).first().text.split("\n")
    assert [t for t in text if t != "Title"] == STORY


def test_nulls_repeated_rows_long_pages_clashing_columns_and_no_rows(spark):
    long = "<nav><a href=/>Home</a></nav><article>" + "".join(f"<p>{STORY[i % 5]} {i}" for i in range(8000)) + "</article><footer>© 2024</footer>"
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>  "), (3, "u", long), (3, "u", long), (4, "u", "<script>x</script>")]
    df = spark.createDataFrame(rows, PAGES).withColumns({"text": F.lit("mine"), "n_chars": F.lit("x")})
    got = labeller.extracted(df).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id != 3] == [""] * 4
    a, b = (r.text for r in got if r.page_id == 3)
    assert a == b and len(a.split("\n")) >= 7990
    assert labeller.extracted(df.limit(0)).collect() == []


def test_query_on_the_small_table(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, d, "pages").collect()}
    right = total = 0
    for r in labeller.query(spark, d).collect():
        want = [b.text for b in blocks_of(pages[r.page_id]) if "article" in b.path]
        got = r.text.split("\n")
        right, total = right + len(set(want) & set(got)), total + max(len(set(want)), len(set(got)))
    assert right >= 0.99 * total


def test_hidden_inline_elements_have_no_text():
    page = ('<p>one <span style="display: none">no <b>not</b> <span>no</span></span>two <b hidden>no</b><i class="hidden">three</i> <em HIDDEN>no</em>'
            '<span aria-hidden="true">four</span> <span style="visibility:hidden">no</p><p>five <a href="x" title="hidden" >six</a> <img hidden> <b title="a hidden gem" style="font-style: display">seven</b></p>')
    assert [b.text for b in blocks.blocks_of(page)] == ["one two three four", "five six seven"]


def test_every_word_of_a_block_counts():
    words = [f"w{k}" for k in range(40)]
    one, other = ([blocks.Block(" ".join(x), ("p", "in:p"), 0)] for x in (words, [*words[:20], "casino", *words[21:]]))
    first, second = labeller.vectors(one), labeller.vectors(other)
    assert (first[:, labeller.PATH:labeller.PATH + labeller.WORDS] != second[:, labeller.PATH:labeller.PATH + labeller.WORDS]).any()
    digits = labeller.vectors([blocks.Block("a" * 300 + " " + "1" * 50, ("p", "in:p"), 0)])
    assert abs(digits[0, labeller.PATH + labeller.WORDS + 6] - 50 / 351) < 1e-6


def network_step_by_step(x, weights):
    """The bidirectional pass of one page, a block and a number at a time."""
    import math

    sig, hidden = lambda v: 1 / (1 + math.exp(-v)), labeller.HIDDEN
    states = []
    for side, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h, c, out = [0.0] * hidden, [0.0] * hidden, {}
        for t in order:
            gate = [sum(x[t][k] * weights["x" + side][k][g] for k in range(len(x[t]))) + sum(h[k] * weights["h" + side][k][g] for k in range(hidden)) + weights["c" + side][g] for g in range(4 * hidden)]
            c = [sig(gate[hidden + k]) * c[k] + sig(gate[k]) * math.tanh(gate[3 * hidden + k]) for k in range(hidden)]
            h = [sig(gate[2 * hidden + k]) * math.tanh(c[k]) for k in range(hidden)]
            out[t] = h
        states.append(out)
    return [sig(sum(v * w for v, w in zip([*states[0][t], *states[1][t]], weights["w"], strict=True)) + weights["o"][0]) for t in range(len(x))]


def test_the_network_against_a_step_by_step_version():
    rng = np.random.default_rng(5)
    weights = {k: v.astype(float) for k, v in labeller.started(3).items()}
    x = rng.normal(0, 1, (5, labeller.INPUT))
    got, _ = labeller.forward(x[:, None, :], np.ones((5, 1), bool), weights)
    assert np.allclose(got[:, 0], network_step_by_step(x.tolist(), {k: v.tolist() for k, v in weights.items()}), atol=1e-5)
