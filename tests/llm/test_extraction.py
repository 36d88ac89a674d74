from collections import Counter

from tallyward.llm import extraction
from tallyward.llm.extraction import extract_pages, host_of, main_text
from pyspark.sql import functions as F
from tests.llm.conftest import CLASHING

SCHEMA = "page_id bigint, url string, html string"


def _page(body, kind="article"):
    return (
        "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body class='has-sidebar'>"
        "<div class='cookie-notice'>We use cookies</div><header>Site</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        f"<!-- ad --><div class=\"ad\">Buy now</div><{kind}>{body}</{kind}><section id='comments'><p>first!</p></section>"
        "<form><p>Subscribe<input></p></form><aside>More</aside><footer>&copy; host</footer></body></html>"
    )


def test_article_of_a_single_page():
    html = _page("<h1>A &amp; B</h1><p><b>One\n  two<br>three<p>four &lt;five&gt;</p><div class='share'>Share</div><ul><li>six<li>seven</ul>")
    assert main_text(html, None) == "A & B\nOne two three\nfour <five>\nsix\nseven"


def test_cut_off_and_odd_markup():
    assert main_text("<article><p>a < b and c > d<p title='x>y'>e<!-- f", None) == "a < b and c > d\ne"
    assert main_text("<article>x</span>y</p>z<script>never closed", None) == "xy\nz"
    assert main_text("", None) == "" and main_text("plain text", None) == "plain text"


def test_template_of_a_host(spark):
    """No markup tells the parts apart: only what the pages share does."""
    words = [f"word{k}" for k in range(500)]
    rows = []
    for k in range(24):
        own = " ".join(words[(7 * k + j) % 500] for j in range(60))
        html = f"<html><body><div><p>Welcome to our site</p></div><table><tr><td>{own}</td></tr></table><center>All about us</center><pre>page {k}</pre></body></html>"
        rows.append((k, "https://Example.org:8080/x", html))
    rows += [(100, "https://other.org/", "<p>lonely page</p>"), (101, None, None), (102, "no url", "")]
    got = {r.page_id: r for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k in range(24):
        assert got[k].text == " ".join(words[(7 * k + j) % 500] for j in range(60))
        assert got[k].n_chars == len(got[k].text)
    assert got[100].text == "lonely page" and got[101].text == "" and got[102].text == ""


def test_copies_of_a_page_are_no_template(spark):
    html = _page("<h1>Title</h1><p>One text in many copies.</p>")
    rows = [(k, "http://a.b/", html) for k in range(30)]
    pages = spark.createDataFrame([r + ("x", "y") for r in rows], SCHEMA + ", host string, template string")
    assert {r.text for r in extract_pages(pages).collect()} == {"Title\nOne text in many copies."}
    assert extract_pages(pages.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["https://User@WWW.A.org:80/x", "http://b.org?x#y", "c.org/x", None, "ftp://d"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(host_of(F.col("u"))).collect()] == ["www.a.org", "b.org", "", "", "d"]


def test_near_copies_keep_their_text(spark):
    """Copies that differ outside the article only, among a few other pages; with the article marked and without."""
    long = "One text in many copies that is long enough to tell the page by it."
    rows = []
    for k in range(40):
        own = f"<h1>Title</h1><p>{long}</p><p>Its second paragraph.</p><h2>End</h2>"
        if k >= 30:
            own = f"<h1>Own {k}</h1><p>Page {k} has words of its own, which no other page of this host has.</p>"
        html = _page(own).replace("Home", f"Home {k}").replace("Buy now", f"Buy {k}")
        rows.append((k, f"http://a.b/?{k}", html))
        rows.append((100 + k, f"http://c.d/?{k}", f"<html><body><div>{own}</div><pre>seen {k} times</pre></body></html>"))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k in range(30):
        assert got[k] == f"Title\n{long}\nIts second paragraph.\nEnd"
        assert got[100 + k].startswith(f"Title\n{long}\nIts second paragraph.\nEnd")
    assert got[30] == "Own 30\nPage 30 has words of its own, which no other page of this host has."


def test_marks_around_the_article():
    """A class or id that only tells what is there besides, or that stands around the article, leaves nothing out."""
    text = "<h1>Title</h1><p>Words of the article, a good many of them.</p>"
    kept = "Title\nWords of the article, a good many of them."
    side = "<div class='sidebar'><p>side</p></div><section class='related'><article>Another one, and it is longer than the first. Yes, longer it is by far.</article></section>"
    assert main_text(f"<div class='content has-sidebar'><article>{text}</article></div>{side}", None) == kept
    assert main_text(f"<div id='page-with-nav'><div>{text}</div></div><div id='nav'>menu</div>", None) == kept
    assert main_text(f"<div class='overlay'><div class='widget'><main>{text}</main></div>{side}</div>", None) == kept
    assert main_text(f"<div class='modal'>{text}</div>{side.replace('article', 'div')}", None) == kept
    widget = "<div class='elementor-widget elementor-widget-text-editor'>"
    assert main_text(f"{widget}<h1>Title</h1></div>{widget}<p>One.</p></div>{widget}<p>Two.</p></div>", None) == "Title\nOne.\nTwo."
    card = "<div class='sidebar'><article>a card</article></div>"
    assert main_text(f"<div class='content'>{text}</div>{card}", None) == kept
    inner = f"<article>{text}<div class='share-buttons'>Share this</div><div class='newsletter'><p>Sign up now</p></div></article>"
    assert main_text(f"<div class='no-sidebar'>{inner}<div id='comments'><article>{'first! ' * 50}</article></div></div>", None) == kept


def test_short_sections_of_a_host(spark):
    """Nothing marks the article: titles, a lead before a fixed byline, short sections, and sources in links all stay."""
    words = [f"word{k}" for k in range(500)]
    rows, texts = [], []
    for k in range(30):
        parts = [" ".join(words[(7 * k + 31 * s + j) % 500] for j in range(12)) for s in range(6)]
        sections = "".join(f"<h3>Section {s}</h3><p>{parts[s]}</p>" for s in range(1, 6))
        links = "".join(f"<a href='/{k}/{j}'>source {k} {j}</a> " for j in range(3))
        html = (
            f"<html><body><div><p>Welcome to our site</p></div><ul><li><a href='/{k}'>go to {k}</a></li></ul><h1>Title {k}</h1>"
            f"<p>{parts[0]}</p><table><tr><td>By the staff of this site</td></tr></table>{sections}<ol><li>{links}</li></ol>"
            f"<blockquote>Page {k} ends with these last words.</blockquote><center>All about us</center><pre>page {k}</pre></body></html>"
        )
        rows.append((k, "https://e.org/x", html))
        sources = " ".join(f"source {k} {j}" for j in range(3))
        texts.append("\n".join([f"Title {k}", *parts, sources, f"Page {k} ends with these last words."]))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k] for k in range(30)] == texts


def test_edge_rows(spark):
    """Long, empty and missing html, repeated rows and columns named like the operator's own."""
    long = "<article>" + "<p>a long paragraph of a long page</p>" * 50_000 + "</article>"
    rows = [(1, "http://a.b/1", long), (2, "http://a.b/2", "<article><p>x</p></article>"), (2, "http://a.b/2", "<article><p>x</p></article>")]
    rows += [(None, None, "<p>no id</p>"), (3, None, None), (4, "", ""), (5, "http://a.b/5", " \n "), (6, "http://a.b/6", "<" * 1000)]
    names = [c for c in CLASHING if c not in {"page_id", "url", "html"}] + ["text", "n_chars", "pages", "classes", "slots", "all", "low", "high", "words"]
    names = sorted(set(names))
    pages = spark.createDataFrame([r + ("x",) * len(names) for r in rows], SCHEMA + "".join(f", `{c}` string" for c in names))
    got = extract_pages(pages).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == "\n".join(["a long paragraph of a long page"] * 50_000)
    assert texts[2] == "x" and texts[None] == "no id" and texts[3] == texts[4] == texts[5] == ""
    assert all(r.n_chars == len(r.text) for r in got)


def test_large_templates_are_joined(spark, monkeypatch):
    """Beyond the size that is sent to all tasks the same comes from a join."""
    rows = [(k, f"http://h{k % 2}.org/", _page(f"<p>own words {k} and some more</p>", "div")) for k in range(40)]
    pages = spark.createDataFrame(rows, SCHEMA)
    sent = sorted(map(tuple, extract_pages(pages).collect()))
    monkeypatch.setattr(extraction, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, extract_pages(pages).collect())) == sent
