import html
import random
import re

import pytest

from almsbook.llm import html_extract as he
from almsbook.llm.queries import QUERIES
from frames import prose

SCHEMA = "page_id long, url string, html string, text string, n_chars string, extra int"

BEFORE = [
    "<nav><ul><li><a href='/a'>Home, sweet home</a><li><a href='/b'>News</a></ul></nav>",
    "<header><h1>The Daily Site</h1><p>Slogan, of the site, for all.</p></header>",
    '<div id="cookie-banner">We use cookies, many cookies, to serve you, and to please you.</div>',
    '<div class="ad">Buy this, and that, and that too, today.</div>',
    '<aside><p>Aside, with commas, many, many, many of them, so it scores.</p></aside>',
    '<div role="alert">Notice: closed on Monday, Tuesday, and Sunday.</div>',
    '<script>var t = "</p><article>not, this, text</article>";</script><style>p > a {color: red}</style>',
    "<!-- <article>a comment, of the page, with text</article> -->",
]
AFTER = [
    "<footer>&copy; The Site, all rights reserved, everywhere.</footer>",
    '<div id="comments"><h2>3 Comments</h2><div class="comment"><p>I, for one, agree, and say so at length, again, and again, and again.</p></div></div>',
    '<section><h3>Reader comments (12)</h3><p>First, of all, comments, without any class, to go by.</p></section>',
    '<div class="sidebar"><h3>Popular</h3><p>Sidebar text, with commas, here, there, and everywhere, at some length.</p></div>',
    '<form><p>Subscribe, please, now, to our letters.</p><input type="text"><button>Go, go</button></form>',
    '<ul class="relatedPosts"><li><a href="/x">Other, story</a></li><li><a href="/y">More, stories</a></li></ul>',
    "<div><ul><li><a href='/x'>Unnamed menu, one</a></li><li><a href='/y'>Unnamed menu, two</a></li></ul></div>",
]


def article(seed):
    """Blocks of an article as markup, and its text."""
    rng = random.Random(seed)
    shapes = ["<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>", "<pre>{}</pre>", "<p class='lead'>{}<br>\n"]
    texts = [", ".join(prose(seed * 1000 + i * 10 + k, rng.randint(3, 30)) for k in range(rng.randint(1, 4))) + "." for i in range(rng.randint(3, 12))]
    texts[1] += " Tom & Jérôme < 3 \"quotes\" – ½"
    markup = "\n".join(rng.choice(shapes).format(html.escape(t).replace(" ", rng.choice([" ", "\n  ", "&#32;"]), 2)) for t in texts)
    return markup, " ".join(texts)


@pytest.mark.parametrize("shell", [
    "<article><h1>{title}</h1>{body}</article>", "<main><article class='post no-comments category-menu'><header><h1>{title}</h1></header>{body}</article></main>",
    "<main><h1>{title}</h1>{body}</main>", "<div class='page'><div id='content'><h1>{title}</h1>{body}</div></div>", "<div><h1>{title}</h1><div>{body}</div></div>",
    "<div class='layout with-sidebar'><section><h1>{title}</h1>{body}</section></div>", "<form id='aspnet'><article><h1>{title}</h1>{body}</article></form>",
])
def test_article_among_furniture(shell):
    for seed in range(12):
        rng = random.Random(seed)
        body, text = article(seed)
        title = prose(seed + 500, 6)
        before, after = rng.sample(BEFORE, rng.randint(0, len(BEFORE))), rng.sample(AFTER, rng.randint(0, len(AFTER)))
        page = f"<!DOCTYPE html><html><head><title>T, t</title></head><body>{''.join(before)}{shell.format(title=title, body=body)}{''.join(after)}"
        assert he.main_text(page + rng.choice(["", "</body></html>"])) == " ".join(f"{title} {text}".split()), (seed, page)


def test_furniture_inside_an_article_goes():
    page = f"<body><article><h1>Title</h1><p>One, two.</p>{''.join(BEFORE[2:6])}<p>Three <b>fo</b>ur <a href='/'>five</a>.</p>{''.join(AFTER)}</article>"
    assert he.main_text(page) == "Title One, two. Three four five."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""), ("<nav><a>x</a></nav>", ""), ("plain words, only", "plain words, only"),
    ("<p>a<p>b</b></i></div>c", "a bc"), ("1 < 2 <3 &amp &am &copy2 &#x41; &nosuch; &#xD800;", "1 < 2 <3 & &am ©2 A &nosuch; �"), ("<p>x<script>if (a</b>", "x"),
    ("<article>A.</article><div class='ad'>Much, much, much longer, advert, text, than the article</div>", "A."),
    ("<p>no&nbsp;break\t\tand wide</p>", "no break and wide"), ("<article><p>a<br>b<wbr>c<img src='>'>d</p></article>", "a bcd"),
    ("<article><pre><span class='hljs-comment'># kept, code</span></pre><span class='ad'>gone</span></article>", "# kept, code"),
    ("<table><tr><td><a href=/>Menu</a><td><p>Text, of a page, laid out in tables, as it was done.</table>", "Text, of a page, laid out in tables, as it was done."),
    ("<article><section><p>Short.</section><section><p>" + "long, " * 200 + "</section></article>", "Short. " + ("long, " * 200).strip()),
])
def test_small_pages(page, text):
    assert he.main_text(page) == text


def test_long_and_deep_pages():
    words = "word, " * 200_000
    assert he.main_text(f"<div>{words}</div>") == words.strip()
    assert he.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert he.main_text("<p>a" * 20_000) == " ".join("a" * 20_000)
    for evil in ("<b>" * 20_000, "<" * 20_000, "<!--" * 20_000, "<a href=\"x" * 20_000, "<p " + "= " * 20_000, "</div>" * 20_000, "&" * 20_000):
        he.main_text(evil)


def test_rows(spark):
    page = "<article><p>A b.</p></article>"
    rows = [(1, "u", page, "x", "y", 1), (1, "u", page, "x", "y", 1), (None, None, page, None, None, None), (2, "v", None, None, None, None), (3, "", "", None, None, 0)]
    found = he.extract(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [(1, "u", "A b.", 4)] * 2 + [(None, None, "A b.", 4), (2, "v", "", 0), (3, "", "", 0)]))
    assert he.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tables_against_their_own_template(spark, sf_dir):
    """The tables' pages hold one article each, which a pattern finds."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r["page_id"]: r for r in QUERIES["op13_html_extract"](spark, sf_dir).collect()}
    assert found.keys() == pages.keys()
    for page_id, page in pages.items():
        inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
        assert found[page_id]["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert found[page_id]["n_chars"] == len(found[page_id]["text"])
