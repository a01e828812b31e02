"""Main text against the known structure of the given pages, and the model against exact enumeration."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from smogline.llm import html as H
from smogline.llm import queries
from tests.llm.fixtures import SF, got, rows_of


def article(source):
    """The given pages mark their article; its blocks are its headings and paragraphs."""
    inner = re.search(r"<article>(.*)</article>", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_query_equals_the_articles(spark):
    want = [{"page_id": r["page_id"], "url": r["url"], "text": article(r["html"]), "n_chars": len(article(r["html"]))}
            for r in rows_of("pages")]
    assert got(queries.QUERIES["op5_html_extraction"](spark, SF), "page_id") == sorted(want, key=lambda r: str(r["page_id"]).zfill(20))


def seeds():
    counts = {}
    for source in H.SEED_PAGES:
        page = H.parse(source)
        for k, n in H.counts_of(page, H.marked(page)).items():
            counts[k] = counts.get(k, 0) + n
    return H.model_from(counts)


def test_marginals_equal_enumeration():
    model, rng = seeds(), np.random.default_rng(1)
    parents = np.array([-1, 0, 0, 1, 1, 4])
    depths = np.array([0, 1, 1, 2, 2, 3])
    rows, own = np.repeat(np.arange(6), 2), rng.integers(0, H.SIGNS, 12)
    model.sign[own] = rng.normal(size=(12, 3))
    weight = np.zeros((6, 3))
    for states in itertools.product(range(3), repeat=6):
        log = model.start[states[0]] + sum(model.step[states[p], states[i]] for i, p in enumerate(parents) if i)
        log += sum(model.sign[s, states[r]] for r, s in zip(rows, own, strict=True))
        weight[np.arange(6), states] += np.exp(log)
    assert np.allclose(model.marginals(parents, depths, rows, own), weight / weight.sum(1, keepdims=True))


def test_seed_pages_give_their_articles():
    texts = H.extract_texts(list(H.SEED_PAGES), seeds())
    for page, text in zip(map(H.parse, H.SEED_PAGES), texts, strict=True):
        labels = H.marked(page)
        assert text == "\n\n".join(t for n, t, _ in page.blocks if labels[n] == H.CONTENT)


def test_parser_on_awkward_markup():
    blocks = lambda s: [t for _, t, _ in H.parse(s).blocks]
    assert blocks("<p>a<p><b>b<br>c &amp; d&#233;<p>e") == ["a", "b c & dé", "e"]
    assert blocks("<script>if (a<b) x='</p>'</script>x<!-- <p>no</p> -->y<style>p{}</style >z") == ["xy z"]
    assert blocks("<ul><li>1<li>2</ul>3 < 4 <p title='a>b'>5</p></nope><div/>6<hr>7") == ["1", "2", "3 < 4", "5", "6", "7"]
    assert blocks("<p class=\"open>text</p>") == ["text"]
    assert blocks("") == [] and blocks("<script>never closed") == []
    assert blocks("<a href=x>l</a> t<!-- open") == ["l t"]
    assert blocks("<div>" * 3000 + "deep") == ["deep"]


def test_hidden_elements_open_closed_and_nested():
    blocks = lambda s: [t for _, t, _ in H.parse(s).blocks]
    three = "<p>Three and four.</p><p>Five.</p>"
    for tag in ("button", "svg", "select", "template"):
        assert blocks(f"<p>One two.</p><{tag}>x{three}") == ["One two.", "Three and four.", "Five."]
        assert blocks(f"<div><p>One.</p><{tag}>x</div>{three}") == ["One.", "Three and four.", "Five."]
        assert blocks(f"<p>One <{tag}>x<p>y</p>z</{tag}> two.") == ["One", "two."]
        assert blocks(f"<p>One <{tag}>x <{tag}>inner</{tag}> y</{tag}>two.") == ["One two."]
        assert blocks(f"<p>One <{tag} a='>'/>two </{tag}>three") == ["One two three"]
    assert blocks("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p>") == ["Let x=1 be."]
    assert blocks("<p>See <object data=x>the <b>film</b></object> here</p><object>open<p>on</p>") == ["See the film here", "open", "on"]
    assert blocks("<p>a<script>b</p><p>c") == ["a"] and blocks("<p>a<SCRIPT>b</script\n>c<textarea><p>x</textarea>d") == ["a c d"]
    assert blocks("<svg><button>x</svg>y</button>z") == ["yz"]
    page = H.parse("<div><button><div><ul><li>x</ul></button><p>y")
    assert page.tags == ["#page", "div", "p"] and page.parents == [-1, 0, 1]


def test_attributes_and_tags_that_never_end():
    blocks = lambda s: [t for _, t, _ in H.parse(s).blocks]
    assert blocks("<p title = 'a>b' class=\"c>\">1<p x=it's>2<p \" >3") == ["1", "2", "3"]
    assert blocks("a < b <c") == ["a < b <c"] and blocks("<p>a</p><p title='x'") == ["a", "<p title='x'"]
    assert blocks("<!doctype html><?php x ?></ >a") == ["a"]


@pytest.mark.parametrize("piece", ["<b ", "<a \"", "<p title=\"x", "<div>", "<p>", "</div><div>", "<a x=\">\"", "<a ='>", "<script ",
                                   "<button>", "<svg><div>", "</svg>", "<!--", "<![", "</", "&amp", "= ", "<li><ul>", "<select>x</select>",
                                   "<script>x</script ", "<div class='", "<p class=a id=b>x "])
def test_time_grows_with_the_length(piece):
    began = time.process_time()
    for end in ("", ">"):
        H.parse(piece * (5_000_000 // len(piece)) + end)
    assert time.process_time() - began < 60


def test_many_and_deep_elements_in_time():
    model, began = seeds(), time.process_time()
    texts = H.extract_texts(["<div>" * 100_000 + "deep", "<article>" + "<p>Some prose, a sentence.</p>" * 30_000], model)
    assert len(texts[1]) == 30_000 * 25 - 2 and time.process_time() - began < 60


def test_nulls_repeats_long_and_empty_tables(spark):
    long = "<body><article>" + "<p>Prose of the article, a sentence.</p>" * 5000 + "</article><footer>end</footer></body>"
    pages = spark.createDataFrame([(0, None, None, 1), (1, "u", "", 2), (1, "u", long, 3), (1, "u", long, 3), (None, "v", "plain &lt; text", 4)],
                                  "page_id long, url string, html string, text int")
    model = H.train(pages)
    rows = sorted(((r["page_id"] is None, r["n_chars"]) for r in H.extract(pages, model).collect()))
    assert rows == [(False, 0), (False, 0), (False, 5000 * 35 - 2), (False, 5000 * 35 - 2), (True, 12)]
    assert H.extract(pages.limit(0), H.train(pages.limit(0))).collect() == []
