"""Extraction against marked-up articles, held-out made pages and a brute-force decoder; odd markup."""

from __future__ import annotations

import html
import itertools
import re

import numpy as np
import pytest

from stationlake.llm import html_crf as H

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return H.fit(H.training_pages(pages[:100]))


def article(page):
    """The article of a given page by plain expressions."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in parts if x)


def test_whole_articles(spark, pages):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in H.extract(rows).collect()}
    assert len(got) == len(pages)
    for r in rows.collect():
        assert got[r.page_id].text == article(r.html)
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(got[r.page_id].text))


def test_layouts_not_seen(pages, model):
    """Held out: other articles in newly made layouts, with and without landmarks."""
    rng, wrong, total, exact = np.random.default_rng(12345), 0, 0, 0
    others = [b.text for p in pages[150:200] for b in H.leaf_blocks(p) if len(b.text) < 400]
    for page in pages[100:250]:
        own = [b.text for b, y in zip(H.leaf_blocks(page), H.by_landmarks(H.leaf_blocks(page)), strict=True) if y]
        made, want = H.made_page(rng, own[0], own[1:8] or own, others)
        got = model.labels(H.leaf_blocks(made))
        assert len(got) == len(want)
        wrong, total, exact = wrong + sum(map(int.__ne__, got, want)), total + len(want), exact + (got == want)
    assert wrong / total < 0.01 and exact / 150 > 0.9


def test_region_kinds(model):
    """Every kind of region that is not the article, by elements and by names."""
    text = "The council met on Tuesday to discuss the plan, and most members spoke in favour of it."
    for around in ("<header><p>Example News</p></header>", "<nav><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></nav>",
                   "<div class='cookie-banner'><p>We use cookies.</p><button>Accept all</button></div>",
                   "<aside><h3>Related articles</h3><a href=/x>More on the plan</a></aside>", "<div class=ad>Buy now, limited offer</div>",
                   "<form><label>Email</label><input><button>Subscribe</button></form>",
                   "<section id=comments><h3>2 comments</h3><div class=comment><p>Great piece, I agree with all of it.</p></div></section>",
                   "<footer>&copy; 2024 Example. All rights reserved.</footer>", "<script>var x = '<p>no</p>'</script><style>p{}</style>"):
        body = f"<article><h1>A plan</h1><p>{text}</p><p>{text}</p></article>"
        for page in (f"<body>{around}{body}</body>", f"<body>{body}{around}</body>"):
            assert H.main_text(page, model) == f"A plan\n\n{text}\n\n{text}", page


def test_blocks():
    def texts(page):
        return [b.text for b in H.leaf_blocks(page)]

    assert texts("<p>a<p>b<b>c</b> d<br>e") == ["a", "bc d e"]
    assert texts("<ul><li>x<li>y</ul>z") == ["x", "y", "z"]
    assert texts("<p>1 &lt; 2 &amp; &copy &#233; < 3 <4</p>") == ["1 < 2 & © é < 3 <4"]
    assert texts("a<!-- <p>no</p> -->b<!doctype x><?pi?></>c") == ["abc"]
    assert texts("<script>if (a</b) '</p>'</script >x<title>t</title>y<textarea>z</textarea>") == ["xy", "z"]
    assert texts('<p title="a > b" class=\'x\'>in</p><img alt="<p>">out') == ["in", "out"]
    assert texts('<p title="open>one</p>two<b') == ["one", "two"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("<p> \n </p> <div>\t</div>") == [] == texts(None) == texts("") == texts("<!-- open")
    block = H.leaf_blocks("<div class='post-Body mainText' id=x2><p>t<a href=/>uv</a></p></div>")[0]
    assert set(block.around) == {"div", ".post", ".body", ".main", ".text", ".x", ".2", "p"}
    assert (block.tag, block.linked, block.inside[0]) == ("p", 2, "div")


def test_decoder_and_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    blocks = H.leaf_blocks("<p>one, two</p><div class=ad>x</div><p>three four five.</p><li>six</li><p>7</p>")
    for _ in range(20):
        m = H.Field(rng.normal(size=H.SIZE), rng.normal(size=(2, 2)))
        u = m.unary(H.features(blocks))
        score = {y: sum(a * b for a, b in zip(y, u, strict=True)) + sum(m.pair[a, b] for a, b in itertools.pairwise(y))
                 for y in itertools.product((0, 1), repeat=len(u))}
        assert tuple(m.labels(blocks)) == max(score, key=score.get)
        z = sum(map(np.exp, score.values()))
        prob, pairs = m.marginals(u)
        for k in range(len(u)):
            assert np.isclose(prob[k], sum(np.exp(s) for y, s in score.items() if y[k]) / z)
        assert np.isclose(pairs.sum(), len(u) - 1)
        assert np.isclose(pairs[1, 0], sum(np.exp(s) * sum(p == (1, 0) for p in itertools.pairwise(y)) for y, s in score.items()) / z)


def test_null_empty_long_and_repeated_rows(spark, model):
    long = "<article><p>" + "word, " * 200_000 + "end.</p></article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<nav>Home</nav>"), (4, "u", long), (5, "u", "<article><p>A b.</p></article>"),
            (5, "u", "<article><p>A b.</p></article>"), (None, "u", "<article><p>A b.</p></article>")]
    got = H.extract(spark.createDataFrame([(*r, 1, "t") for r in rows], SCHEMA + ", n_chars int, text string"), model).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.url, r.text, r.n_chars))
    assert by[1] == [(None, "", 0)] and by[2] == [("u", "", 0)] and by[3] == [("u", "", 0)]
    assert by[4][0][1] == " ".join(("word, " * 200_000 + "end.").split())
    assert by[5] == [("u", "A b.", 4)] * 2 and by[None] == [("u", "A b.", 4)]


def test_empty_table_and_no_labelled_page(spark):
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []
    text = "Prices rose by 4 % last year, according to the office. Nobody was surprised by that."
    page = f"<div id=menu><a href=/>Home</a></div><div class=content><p>{text}</p><p>{text}</p></div><div class=footer>&copy; 2024</div>"
    got = H.extract(spark.createDataFrame([(1, "u", page)], SCHEMA)).collect()
    assert got[0].text == f"{text}\n\n{text}"
