"""Toxicity, quality and page text, on the given tables' held-out fifth and on awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import SCHEMA, frame
from tidemark.llm import html_text, quality, toxicity
from tidemark.llm.linear import auc, fit_logistic, predict

DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")


def test_logistic_fit_is_at_a_minimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = (x @ [1, -2, 0, 3] + rng.normal(size=500) > 0).astype(float)
    w = fit_logistic(x, y, 0.5)
    gradient = x.T @ (predict(x, w) - y) + 0.5 * w[:-1]
    assert np.abs(gradient).max() < 0.05 and auc(predict(x, w), y) > 0.95
    assert auc(np.array([1.0, 1.0]), np.array([0, 1])) == 0.5 and auc(np.ones(2), np.ones(2)) == 0.5


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    got = toxicity.classify(docs, labels).withColumnRenamed("toxic", "predicted").join(labels, "doc_id")
    rows = got.filter(toxicity.held_out("doc_id")).select("p_toxic", "predicted", "toxic").collect()
    y = np.array([r.toxic for r in rows])
    assert auc(np.array([r.p_toxic for r in rows]), y) > 0.85
    assert not any(r.predicted for r in rows if not r.toxic)


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(1)
    x = (rng.random((400, 3)) < 0.3).astype(float)
    first = x[:, 0]
    weights = toxicity.fit_chain(x, [first, np.maximum(first, x[:, 1])], np.arange(400) % 4)
    assert [len(w) for w in weights] == [4, 5]
    p = toxicity.Chain({b"a": 0, b"b": 1, b"c": 2}, ["one", "two"], weights).probabilities(x)
    assert auc(p[:, 1], np.maximum(first, x[:, 1])) > 0.99


def test_toxicity_takes_awkward_rows(spark):
    docs = frame(spark, clashing=True)
    labels = spark.createDataFrame([(0, 1), (0, 0), (3, 0), (None, 1), (99, 1), (7, None), (8, 5)], "doc_id bigint, toxic int")
    got = toxicity.classify(docs, labels, keep=("text", "word")).collect()
    assert len(got) == docs.count() and all(0 <= r.p_toxic <= 1 for r in got) and {r.word for r in got} == {"2"}
    none = labels.limit(0)
    assert not any(r.toxic for r in toxicity.classify(docs, none).collect())
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_quality_on_held_out_rows(spark):
    # Some 825 held-out rows; the smaller table has 70 with ten negatives, too few for a steady figure.
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    y, s = np.array([r.quality for r in rows]), np.array([r.score for r in rows])
    assert auc(s, y) > 0.95 and ((s >= 0.3) == y).mean() > 0.9


def test_quality_ignores_negative_and_held_out_labels(labelled):
    docs, labels = labelled
    changed = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    model = quality.train(docs, labels)
    assert np.allclose(model.weights, quality.train(docs, changed.filter("quality = 1")).weights)
    assert 0.5 < model.prior < 0.98


def test_quality_takes_awkward_rows(spark):
    docs = frame(spark, clashing=True)
    got = quality.classify(docs, spark.createDataFrame([(0, 1), (2, 1), (None, 1), (99, 1)], "doc_id bigint, quality int")).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(spark.createDataFrame([], SCHEMA), none).count() == 0


PAGE = """<!doctype html><html><head><title>T</title><style>p{x:"</p>"}</style></head><body><div class="site-nav-2"><a href=/a>Menu one</a></div>
<div class="cookie-notice"><p>We use cookies</p></div><div class=wrap><div class="post-123"><h1>Big &amp; small&nbsp;title</h1><p>First <b>bold</b>
 words<p>Second &lt;para&#8230;<ul><li>one<li>two</ul><form><p>Sign up</form><div class="comments"><article><p>A long reader comment that goes on and on
 and on, longer than all the article</article></div></div></div><aside>Side</aside><script>var a="<p>no</p>"</script><footer>Foot</footer></body>"""


def test_page_without_the_rest():
    page = html_text.read_page(PAGE)
    assert html_text.main_text(page, []) == "Big & small title\nFirst bold words\nSecond <para…\none\ntwo"


@pytest.mark.parametrize("source", ["", "plain < text & more", "<p>open", "</div></p>", "<!-- never closed <p>x", "<script>x", "<a href='x>y", "<article>"])
def test_broken_markup_does_not_crash(source):
    html_text.main_text(html_text.read_page(source), [])


@pytest.mark.parametrize("tag", ["head", *html_text.HIDDEN])
def test_an_element_left_open_does_not_hide_the_article(tag):
    page = f"<html><{tag}><title>x</title><body><article><p>One</p><{tag}>left open<p>Two</p><{tag}>gone</{tag}><p>Three</article>"
    got = html_text.main_text(html_text.read_page(page), []).split("\n")
    assert {"One", "Two", "Three"} <= set(got) and "x" not in got and (tag == "head" or "gone" not in got)


@pytest.mark.parametrize("body, want", [
    ("<div id=x><h1>Title of it</h1><p>An introduction<ul><li>{0}<li>{0}</ul></div>", ["Title of it", "An introduction", "{0}", "{0}"]),
    ("<div><section class=a><p>{0}{0}{0}</section><section class=b><p>{0}</section></div>", ["{0}{0}{0}", "{0}"]),
    ("<div><div class=a><p>{0}{0}{0}</div><div class=b><blockquote>{0}</blockquote></div></div><div class=c>tiny</div>", ["{0}{0}{0}", "{0}"])])
def test_the_vote_holds_all_parts_of_an_article_without_a_name(body, want):
    text = "many words of it " * 9
    page = html_text.read_page(f"<body>{body.format(text)}</body>")
    assert html_text.main_text(page, []).split("\n") == [x.format(text).strip() for x in want]


def test_lists_do_not_win_a_host(spark):
    text = "many words of it " * 9
    lists = f"<body><div class=a><h1>Title</h1><ul><li>{text}<li>{text}</ul></div>"
    prose = f"<body><div class=a><p>{text}<p>{text}<ul><li>short</ul></div>"
    rows = [(i, "https://h.example/", prose if i == 9 else lists) for i in range(10)]
    got = {r.page_id: r.main_text for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[9] == "\n".join([text.strip(), text.strip(), "short"]) and got[0].startswith("Title\n")


def test_the_host_decides_where_a_page_is_unsure(spark, monkeypatch):
    page = "<body><div class=story>{}</div><div class=extra>{}</div></body>"
    long, short = "word " * 80, "tiny"
    rows = [(i, f"https://h.example/{i}", page.format(long, short)) for i in range(8)] + [(8, "https://h.example/8", page.format(short, long)),
            (9, "https://other.example/", page.format(short, long)), (10, None, None), (11, "https://h.example/x", "<p>no container"), (8, "https://h.example/8", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "'y' AS winners", "'z' AS text")
    for most in (html_text.MOST_BROADCAST, -1):
        monkeypatch.setattr(html_text, "MOST_BROADCAST", most)
        got = sorted((r.page_id, r.main_text) for r in html_text.extract_main_text(df).collect())
        # A winner that holds little of a page doesn't count for it.
        assert (8, long.strip()) in got and (8, "") in got and (9, long.strip()) in got and (10, "") in got and (11, "no container") in got
        assert len(got) == len(rows)
    assert html_text.extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("body, want", [
    # An article's own header, and sections whose class holds a word of the site's parts.
    ("<article><header class=entry-header><h1>Title</h1></header><p>Text</article>", "Title\nText"),
    ("<article><div class=article-header><h1>Title</h1></div><section class=social-history><p>Text</section></article>", "Title\nText"),
    ("<article><h1>Title</h1><p>Text<div class=comments><p>No</div><div class=ad-slot>No</div><form>No</form><footer>No</footer></article>", "Title\nText"),
    # Blocks and inline elements judged by their names; hidden ones.
    ("<article><p>One<p class=advert>No<p>Two <span class=ad>no</span>end<p role=alert class=cookie-notice>No</p><p hidden>No</p></article>", "One\nTwo end"),
    ("<article><p>One<div hidden>No</div><p>Two <a class=skip-link href=x>no</a>end<p data-x='hidden'>Three</article>", "One\nTwo end\nThree"),
    ("<article><p>One <span class=ad>left open<p>Two</article>", "One left open\nTwo"),
    # Several articles, with and without classes of their own; a reader's comment is none.
    ("<article class=a><p>One</article><article class=b><p>Two</article><div class=comments><article><p>No</article></div>", "One\nTwo"),
    ("<div class=x><main><h1>T</h1><article class=a><p>One</article></main></div><article class=related><p>No</article>", "T\nOne"),
    # A short title beside the container that wins.
    ("<div class=wrap><h1>Short</h1><div class=story><p>" + "many words of it " * 9 + "</div></div>", "Short\n" + ("many words of it " * 9).strip()),
    ("<div class=wrap><h1>Short</h1><div class=x><p>" + "many words of it " * 9 + "<p>b</div></div>", "Short\n" + ("many words of it " * 9).strip() + "\nb"),
    ("<h1>Site</h1><article><h2>Own</h2><p>Text</article>", "Own\nText"),
    ("<article><p><a href=x>All of it is a link</a></article>", "All of it is a link")])
def test_what_belongs_to_the_article(body, want):
    assert html_text.main_text(html_text.read_page(f"<html><head><title>t</title></head><body>{body}</body></html>"), []) == want


def test_a_winner_counts_where_it_holds_most_of_a_page(spark):
    long = "many words of it " * 9
    rows = [(i, f"https://h.example/{i}", f"<body><div class=story><p>{long}</div><div class=rest><p>end {i}</div>") for i in range(9)]
    rows.append((9, "https://h.example/9", f"<body><div class=story>tiny</div><div class=long><p>{long}</div>"))
    got = {r.page_id: r.main_text for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert long.strip() in got[9] and all(long.strip() in got[i] for i in range(9))


def test_a_very_long_page(spark):
    body = "".join(f"<p>paragraph {i} of a long page</p>" for i in range(60_000))
    df = spark.createDataFrame([(1, "https://h.example/", f"<body><article>{body}</article></body>")], "page_id bigint, url string, html string")
    text = html_text.extract_main_text(df).first().main_text
    assert text.count("\n") == 59_999 and text.endswith("paragraph 59999 of a long page")


def test_given_pages_give_their_articles(spark):
    import html
    import re
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    got = {r.page_id: r.main_text for r in html_text.extract_main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
