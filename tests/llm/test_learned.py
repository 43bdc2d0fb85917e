"""Extraction and the trained operators: given pages, held-out accuracy, exact inference, edge rows."""

import html
import itertools
import re

import numpy as np
import pytest

from tests.conftest import SMALL
from turnout.llm import html_extract, line_quality, toxicity
from turnout.llm.learning import held_out, taught_sample

LARGE = "/root/testdata/sf0.1"


def article(page):
    """The text of the given pages' one article, read off its own template."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1] if found else "")
    texts = (" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_extracts_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    got = html_extract.extract(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


TEXT = "Some words of running text that make a long paragraph on this page, and then a few words more. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<nav><a href=x>menu</a></nav>", ""), ("plain", "plain"),
    ("<body><div id='main-menu'><a href=1>One</a></div><p>" + TEXT + "</p><p>Short.</p><div class='sidebar'>side</div><div class=footer>(c)</div>",
     TEXT.strip() + "\nShort."),
    ("<header>Site</header><main><h1>T</h1><p>a&nbsp;b &lt;i&gt; &#233;&eacute</p><aside>no</aside><section id='comments'><p>c</p></section></main><p>" + TEXT,
     "T\na b <i> éé"),
    ("<article><p>x<script>if (a < b) { '</p>' }</script> y</p><style>p{}</style><form>f <input> g</form><p>a < b & c</p></article>", "x y\na < b & c"),
    ("<div class=ad>never closed<article><p>kept</p><div class='ad box'>buy</div><p>cut off <b>here", "kept\ncut off here"),
    ("<article><!-- <p>no</p> --><p title='a > b'>yes</p><!-- open <p>no", "yes"),
    ("<ul><li><a href=1>" + "one " * 40 + "</a></li></ul><p>" + TEXT, TEXT.strip()),
    ("<div class='cookie-notice'>" + TEXT + "</div><div>" + TEXT + "</div>", TEXT.strip()),
])
def test_page(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("inside, text", [
    ("<section id='social-history'><p>a</p></section>", "a"), ("<h2 id='search-results-discussed'>a</h2><p>b</p>", "a\nb"),
    ("<section id=login><p>a</p></section>", "a"), ("<p data-id='share-3' data-class=ad title='class=ad'>a</p>", "a"),
    ("<h2 id=comments>a</h2><p class='social-history related'>b</p><div class='notice-of-1812 share widget'>c</div>", "a\nb\nc"),
    ("<figure><table><tr><td>1<td>2</table><pre>code</pre><figcaption>caption</figcaption></figure>", "1\n2\ncode\ncaption"),
    ("<pre>x = 1 <span class='token comment'># one</span></pre>", "x = 1 # one"),
    ("<div class='ad-banner'>no</div><div class='entry-footer'>no</div><div class='login'>a</div><div class='banner'>b</div>", "a\nb"),
    ("<p><label>l</label> <button>b</button> <math><mi>x</mi></math></p>", "l b x"),
    ("<div class='ad-slot'>no</div><div class='Comments-area x'>no</div><div class='cookie-notice'>no</div><ul class=siteMenu><li>no</ul>"
     "<div role=navigation>no</div><div id=respond>no</div><div class='page-footer'>no</div>", ""),
])
def test_article_loses_only_what_is_no_text(inside, text):
    page = f"<body><button>no</button><figure>no</figure><article><p>first</p>{inside}<p>last</p></article></body>"
    assert html_extract.main_text(page) == "\n".join(t for t in ("first", text, "last") if t)


AD = "<div class=ad>buy</div>"


@pytest.mark.parametrize("page, text", [
    (f"<h1>Title</h1>{AD}<p>{TEXT}</p>{AD}<p>Short.</p>{AD}<p>{TEXT}</p>{AD}<p>The end.</p><div>(c) site</div>",
     f"Title\n{TEXT.strip()}\nShort.\n{TEXT.strip()}\nThe end."),
    (f"<div>Site</div>{AD}<h1><a href=1>Title</a></h1><h2>Sub</h2>{AD}<p>{TEXT}</p>", f"Title\nSub\n{TEXT.strip()}"),
    (f"<p>{TEXT}</p><p>See <a href=1>the long list of sources</a></p><ul><li><a href=2>menu</a></ul><p>{TEXT}</p><p><a href=3>All.</a></p>",
     f"{TEXT.strip()}\nSee the long list of sources\n{TEXT.strip()}"),
    (f"<div>Site</div><nav>n</nav><p>{TEXT}</p><nav>n</nav><p>Home</p>", TEXT.strip()),
])
def test_short_runs_beside_the_text(page, text):
    assert html_extract.main_text(page) == text


MENU = "<ul>" + "".join(f"<li><a href={k}>More about {k}</a></li>" for k in range(5)) + "</ul>"


@pytest.mark.parametrize("page, text", [
    ("<article><p>a</p><p title='the hidden gem'>b</p><p hidden>no</p><p style='display : none'>no</p><p aria-hidden=true>c</p></article>", "a\nb\nc"),
    ("<article><p>a</p><div><form><input>f<p>g</div><p>b</p><aside>no<p>no</article><p>out", "a\nb"),
    ("<body><div class='social-history'><p>" + TEXT + "</p></div>", TEXT.strip()),
    ("<body><div class='widget-area'>" + TEXT + "</div><div class=footer>(c)</div>", TEXT.strip()),
    ("<body><div class='widget-area'>" + TEXT + "</div><p>" + TEXT + "Main.</p>", TEXT + "Main."),
    ("<main><article><p>story</p></article><div><p>teaser</p></div></main>", "story"),
    ("<main><p>story</p><article></article></main>", "story"),
])
def test_probes(page, text):
    assert html_extract.main_text(page) == text


def test_blocks_decide_inside_articles():
    """Three or more lines of links in a row are a menu; fewer, or links in text, are text."""
    page = f"<article><p>first</p>{MENU}<p>second <a href=1>with a link</a></p><p><a href=2>One</a></p><p><a href=3>Two</a></p><p>last</p></article>"
    assert html_extract.main_text(page) == "first\nsecond with a link\nOne\nTwo\nlast"
    assert html_extract.main_text(f"<article>{MENU}</article>") == "\n".join(f"More about {k}" for k in range(5))


def line_blocks(lines, window=3, surge=80):
    """The text between surge and dive points of plain lines, straight from the definition."""
    sums = [sum(map(len, lines[i:i + window])) for i in range(len(lines))]
    kept, i = [], 0
    while i < len(lines):
        j = i
        while j < len(lines) and sums[j] > 0:
            j += 1
        if j > i and max(sums[i:j]) > surge:
            kept += [x for x in lines[i:min(j - 1 + window, len(lines))] if x]
        i = max(j, i + 1)
    return "\n".join(kept)


def test_line_blocks_against_plain_version(monkeypatch):
    """Pages without an article, made of paragraphs, short lines and dropped elements: the blocks alone decide."""
    import random
    random.seed(6)
    different = 0
    for _ in range(300):
        parts, lines, paragraphs = [], [], 0
        for _ in range(random.randint(1, 14)):
            kind = random.choice(["long", "short", "nav", "nav"])
            if kind == "nav":
                parts.append("<nav><a href=1>menu</a></nav>")
                lines += [""] * html_extract.WINDOW
            else:
                text = " ".join(random.choice(["word", "and", "more", "text"]) for _ in range(30 if kind == "long" else 3))
                paragraphs += kind == "long"
                parts.append(f"<div>{text}</div>")
                lines.append(text)
        if not paragraphs:
            continue
        runs = line_blocks(lines)
        got = html_extract.main_text("<body>" + "".join(parts))
        first, last = runs.split("\n")[0], runs.split("\n")[-1]
        full = [x for x in lines if x]
        # what stands between two runs stays as well
        assert got.split("\n")[0] == first and got.split("\n")[-1] == last and set(runs.split("\n")) <= set(got.split("\n"))
        different += got != "\n".join(full)
    assert different > 50  # without the blocks every line would stay


def test_extract_edge_rows(spark):
    rows = [(None, None, None), (1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, "<p>" + "word " * 50000)]
    got = html_extract.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string"))
    assert sorted(r.n_chars for r in got.collect()) == [0, 1, 1, 249999]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    counts = np.array([3, 0, 5, 1])
    score, move = rng.normal(size=9), rng.normal(size=(2, 2))
    good, moves, log_z = line_quality.Chains(counts).marginals(score, move)
    at, want_good, want_moves, want_z = 0, [], np.zeros((2, 2)), 0.0
    for n in counts:
        part = {}
        for labels in itertools.product((0, 1), repeat=int(n)):
            part[labels] = np.exp(sum(score[at + i] * y for i, y in enumerate(labels)) + sum(move[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(part.values())
        want_z += np.log(z) if n else 0
        for i in range(n):
            want_good.append(sum(p for y, p in part.items() if y[i]) / z)
        for y, p in part.items():
            for a, b in zip(y, y[1:]):
                want_moves[a, b] += p / z
        at += n
    assert np.allclose(good, want_good) and np.allclose(moves, want_moves) and np.isclose(log_z, want_z)


@pytest.fixture(scope="module")
def large(spark):
    docs, labels = spark.read.parquet(f"{LARGE}/documents.parquet"), spark.read.parquet(f"{LARGE}/labels.parquet")
    return docs, labels


def judged(scored, labels, column, label):
    known = labels.withColumnRenamed(label, "label").select("doc_id", "label")
    rows = scored.filter("held_out").select("doc_id", column).join(known, "doc_id").select(column, "label").collect()
    return np.array([[float(a), b] for a, b in rows]).T


def test_line_quality_held_out(large):
    docs, labels = large
    scored = line_quality.score(docs, line_quality.train(docs, labels))
    score, label = judged(scored, labels, "score", "quality")
    assert ((score >= 0.5) == label).mean() > 0.98
    assert 0 <= score.min() and score.max() <= 1


def test_toxicity_held_out(large):
    docs, labels = large
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert scored.columns == ["doc_id", "held_out", "p_quality", "p_toxic", "toxic"]
    said, label = judged(scored, labels, "toxic", "toxic")
    assert said[label == 1].mean() >= 0.88 and said[label == 0].sum() <= 6


def test_later_links_learn_from_texts_their_earlier_links_have_not_seen():
    """The out-of-fold step, one text at a time, and the chain's use of earlier probabilities."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(1, 60, rng.integers(1, 12))).astype(np.uint64) for _ in range(90)]
    first = np.array([int((r < 8).any()) for r in rows])
    second = np.array([int(f and (r > 40).any()) for f, r in zip(first, rows)])
    fold = np.arange(90) % 3
    texts = toxicity.Texts(rows, np.arange(1, 60, dtype=np.uint64))
    none = np.zeros((90, 0))
    got = toxicity.outside_chances(texts, none, first.astype(float), fold, 3)
    dense = np.zeros((90, 59))
    for i, r in enumerate(rows):
        dense[i, r.astype(int) - 1] = 1
    for k in range(3):
        # a link fitted on the other folds alone, on texts that do not hold this fold at all
        away = [i for i in range(90) if fold[i] != k]
        w, d = toxicity.fit_link(toxicity.Texts([rows[i] for i in away], np.arange(1, 60, dtype=np.uint64)), np.zeros((60, 0)), first[away].astype(float), np.arange(60))
        for i in np.flatnonzero(fold == k):
            assert abs(got[i] - 1 / (1 + np.exp(-(dense[i] @ w + d[0])))) < 1e-9
    # changing the labels of a fold leaves the chances of its texts as they were
    flipped = np.where(fold == 1, 1 - first, first).astype(float)
    assert np.allclose(toxicity.outside_chances(texts, none, flipped, fold, 3)[fold == 1], got[fold == 1])
    chain = toxicity.fit_chain(rows, {"a": first, "b": second}, fold)
    assert chain.names == ["a", "b"] and [len(d) for d in chain.dense] == [1, 2] and chain.dense[1][1] != 0


def test_teaching_rows(spark, large):
    docs, labels = large
    rows = taught_sample(docs, labels, "quality", 300)
    assert rows.count() == 300 and rows.filter(held_out()).count() == 0
    again = taught_sample(docs.repartition(7), labels.repartition(5), "quality", 300)
    assert rows.exceptAll(again).count() == 0


def test_a_repeated_doc_id_teaches_once(spark, docs_of):
    """A taught doc_id with a third of all rows, and texts of any length: one row of it, and bounded lines."""
    rows = [(1, f"copy {k}\n" * 30) for k in range(200)] + [(1, None)] + [(k, f"text {k}\n" * 3000) for k in range(10, 60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in (1, *range(10, 60))], "doc_id long, quality int, toxic int")
    taught = taught_sample(docs_of(rows), labels, "quality", 1000)
    ids = [r.doc_id for r in taught.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids
    mine = taught.filter("doc_id = 1").first()
    again = taught_sample(docs_of(rows[::-1]).repartition(5), labels, "quality", 1000).filter("doc_id = 1").first()
    assert mine == again and mine.text is not None
    marked = line_quality.map_arrow(taught, line_quality._marker(50), "label int, bins binary, lengths binary").collect()
    assert all(len(r.lengths) <= 8 * 50 for r in marked) and sum(len(r.lengths) == 8 * 50 for r in marked) == len(ids) - 1


EDGES = [(None, None), (1, None), (2, ""), (3, "\n \n"), (3, "\n \n"), (4, "word " * 30000), (5, "line\n" * 3000), (6, "日本 😀")]


def test_trained_operators_on_edge_rows(spark, docs_of, large):
    docs, labels = large
    quality, chain = line_quality.train(docs.limit(300), labels), toxicity.train(docs.limit(300), labels)
    for rows in (EDGES, []):
        got = line_quality.score(docs_of(rows), quality).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) <= 1
        got = toxicity.score(docs_of(rows), chain).collect()
        assert len(got) == len(rows) and all(0 <= r.p_toxic <= 1 for r in got)


def test_trained_operators_without_labels(spark, docs_of):
    labels = spark.createDataFrame([(None, None, None), (1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    scored = line_quality.score(docs_of(EDGES), line_quality.train(docs_of(EDGES), labels))
    assert all(r.predicted == 1 for r in scored.collect())
    for some in (labels, labels.limit(0)):
        assert toxicity.score(docs_of(EDGES), toxicity.train(docs_of(EDGES), some)).count() == len(EDGES)
    scored = line_quality.score(docs_of(EDGES), line_quality.train(docs_of(EDGES), labels.limit(0)))
    assert all(abs(r.score - 0.5) < 1e-9 for r in scored.collect())
