from __future__ import annotations

import html
import json
import re
import time

from regiontally.llm.html_extract import align, events, expression, extract, extract_pages, fold, infer_wrappers, main_path, op10_html_extract
from tests.conftest import SF001

LAYOUT = """<html><head><title>t</title><script>var a="</p><article>no</article>";</script></head><body>
<header><h2>Site</h2></header><div id="cookie-notice">We use cookies</div><ul class="menu"><li><a href="/">Home</a></ul>
<div class="content"><h1>{title}</h1>{paras}<div class="ad">Buy</div><form>Name <input></form></div>
<aside>Side</aside><div class="comments"><p>Nice!</p></div><footer>All rights</footer></body></html>"""


def test_query_matches_the_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    rows = op10_html_extract(spark, SF001).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id] or "<article>", re.S).group(1)
        blocks = re.sub(r"</?b>", "", re.sub(r"</?(p|h1)>|<br>", "\0", inner)).split("\0")
        assert r.text == "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert r.n_chars == len(r.text)


def test_layout_without_article_element(spark):
    rows = []
    for i in range(8):
        paras = "".join(f"<p>Para {i}.{k} &amp; <b>bold</b>\n  text" for k in range(1 + i % 3))
        rows.append((i, "http://h.example.org/x", LAYOUT.format(title=f"Title {i}", paras=paras)))
    rows += [(100, None, "<p>bare"), (101, "http://h.example.org/y", None), (102, "not a url", ""), (103, "http://[bad", "plain &lt; text"),
             (104, "http://h.example.org/z", "<div>" * 3000 + "deep" + "</div>" * 10)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, parts string")
    got = {r.page_id: r.text for r in extract_pages(frame).collect()}
    for i in range(8):
        assert got[i].split("\n") == [f"Title {i}", *[f"Para {i}.{k} & bold text" for k in range(1 + i % 3)]]
    assert (got[100], got[101], got[102], got[103], got[104]) == ("bare", "", "", "plain < text", "deep")
    assert extract_pages(frame.filter("1 = 0")).count() == 0


def test_wrapper_of_a_host_covers_its_pages(spark):
    rows = [(f"http://h.example.org/{i}", f"<body><article>{'<p>x' * (i % 4)}{'<h2>y</h2>' * (i % 2)}</article></body>") for i in range(200)]
    (wrapper,) = infer_wrappers(spark.createDataFrame(rows, "url string, html string")).collect()
    parts = json.loads(wrapper.parts)
    assert main_path(parts) == "body/article"
    article = parts[0][4][0]
    assert [(p[0], p[2], p[3]) for p in article[4]] == [("p", 1, 1), ("h2", 0, 1)]


def test_alignment_makes_optional_and_repeated_groups():
    p, h, t = ["p", 0, 0, 0, []], ["h1", 0, 0, 0, []], ["table", 0, 0, 0, []]
    assert [(x[0], x[2], x[3]) for x in align([h, p], [h, t, p])] == [("h1", 0, 0), ("table", 0, 1), ("p", 0, 0)]
    assert [(x[0], x[2]) for x in fold([h, p, p, p])] == [("h1", 0), ("p", 1)]


def test_articles_at_paths_of_their_own(spark):
    inner = "<header>Own head {i}</header><p>Text {i}</p><ul><li><a href='/'>Link {i}</a></li></ul>"
    rows = []
    for i in range(8):  # ids of the page, two layouts, and articles 20 levels down
        article, body = inner.format(i=i), "home" if i % 2 else "single"
        rows.append((i, "http://ids.example.org/x", f"<body><p>Out</p><article id='post-{i}'>{article}</article></body>"))
        rows.append((i + 100, "http://two.example.org/x", f"<body class='{body}'><p>Out</p><article>{article}</article></body>"))
        rows.append((i + 200, "http://deep.example.org/x", f"<body><p>Out</p>{'<div>' * 19}<article>{article}</article>{'</div>' * 19}</body>"))
        slug = "abcdefgh"[i]
        rows.append((i + 300, "http://slug.example.org/x", f"<body><p>Out</p><article class='slug-{slug}'>{article}</article></body>"))
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {p: f"Own head {p % 100}\nText {p % 100}\nLink {p % 100}" for p, _, _ in rows}


def test_copies_of_an_unmarked_page_keep_their_text(spark):
    copy = "<body><h1>T</h1><p>only paragraph</p></body>"
    rows = [(i, "http://c.example.org/x", copy) for i in range(9)]
    rows += [(i, "http://d.example.org/x", f"<body><div>Template</div><p>Paragraph {i}</p></body>") for i in range(20, 26)]
    got = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "T\nonly paragraph" for i in range(9)} | {i: f"Paragraph {i}" for i in range(20, 26)}


HOSTS = {
    # article element with ids that sound like a sidebar's, maths, a table, a label and a script inside a paragraph
    "papers.example.org": (
        "<body><nav>Menu</nav><article><h2 id='related-work'>Related work {i}</h2><section id='search-methods'><p>Search {i}</p></section>"
        "<p class='share-price'>Price {i}</p><p>Sum <math><mi>x</mi><mo>+</mo><mn>{i}</mn></math> ends<script>no()</script> here</p>"
        "<table><tr><td>cell {i}</td></tr></table><label>Label {i}</label><div class='share'><a href='/t'>Tweet</a> <a href='/p'>Post</a></div>"
        "<div class='related'><h3>More</h3><a href='/{i}'>Other piece {i}</a></div></article><footer>F</footer></body>",
        "Related work {i}\nSearch {i}\nPrice {i}\nSum x+{i} ends here\ncell {i}\nLabel {i}",
    ),
    # no mark at all: the template's strings are those that the pages have in common
    "plain.example.org": (
        "<body><div><b>Site name</b></div><div><ul><li>Home</li><li>About us</li></ul></div><div><h1>Title {i}</h1><p>First {i}<p>Second {i}</div>"
        "<table><tr><td>Powered by tables</td></tr></table></body>",
        "Title {i}\nFirst {i}\nSecond {i}",
    ),
    # a group of a doubtful class that holds the author's own words
    "essays.example.org": ("<body><main><h1>T {i}</h1><div class='related'><p>Prose of page {i} about kin</p></div></main></body>", "T {i}\nProse of page {i} about kin"),
    # content class, reader comments and adverts inside
    "blog.example.org": (
        "<body><div class='content'><p>Post {i}</p><p class='advert'>Buy {i}</p><section id='comments'><p>Nice {i}</p></section>"
        "<div class='widget'>Same on all pages</div></div></body>",
        "Post {i}",
    ),
    # strings 20 levels down
    "deep.example.org": ("<body>" + "<div>" * 20 + "<i>Template</i><p>Text {i}</p>" + "</div>" * 20 + "</body>", "Text {i}"),
}


def test_wrappers_decide_what_is_template(spark):
    rows, truth = [], {}
    for h, (host, (layout, text)) in enumerate(HOSTS.items()):
        for i in range(2 + h):
            rows.append((100 * h + i, f"https://{host}/{i}", layout.replace("{i}", str(i))))
            truth[100 * h + i] = text.replace("{i}", str(i))
    # one page alone has nothing to be aligned with: its doubtful class counts
    rows.append((900, "https://alone.example.org/", "<article><p>Own</p><div class='share'>Tell others</div></article>"))
    # the author's group, on one of the host's pages only, stays
    rows += [(910 + i, "https://once.example.org/", f"<article><p>P {i}</p>" + "<div class='promo'>My promotion</div>" * (i == 0)) for i in range(3)]
    truth |= {900: "Own", 910: "P 0\nMy promotion", 911: "P 1", 912: "P 2"}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_pages(frame).collect()}
    assert got == truth
    without = {p: extract(page, "", frozenset()) for p, _, page in rows}
    changed = {p // 100 for p in truth if without[p] != truth[p]}
    assert {0, 1, 3, 4} <= changed


def test_alignment_of_long_lists():
    def page(n, extra):
        return expression(list(events("<body>" + "<h2>a</h2><p>b</p>" * n + extra + "<ul><li>c</ul>" + "</body>")))

    start = time.time()
    whole = align(page(25_000, "<hr>"), page(20_000, "<table><td>x</table>"))
    assert time.time() - start < 30
    keys = [p[0] for p in whole[0][4]]
    assert keys.count("h2") == 25_000 and keys[-1] == "ul" and {"hr", "table"} <= set(keys)
    a, b = [[k, 0, 0, 0, []] for k in "xaybzc"], [[k, 0, 0, 0, []] for k in "aqbcr"]
    assert [(p[0], p[3]) for p in align(a, b)] == [("x", 1), ("a", 0), ("y", 1), ("q", 1), ("b", 0), ("z", 1), ("c", 0), ("r", 1)]
