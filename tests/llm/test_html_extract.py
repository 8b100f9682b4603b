from __future__ import annotations

import html as H
import re

import pytest

from chatlake.llm import html_extract as X
from chatlake.llm.common import table

SCHEMA = "page_id long, url string, html string, host string, path string, text string, v string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", "t", "v") for r in rows], SCHEMA)


def texts(html):
    return [t for _, t, _ in X.blocks(html)]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a<p>b", ["a", "b"]),
        ("<p>a <b>b<i>c</b> d</p>e", ["a bc d", "e"]),
        ("<p>a&amp;b &lt;x&gt; &eacute; &#233; &#x41; &am</p>", ["a&b <x> é é A &am"]),
        ("<p> a \n\t b&nbsp;c<br>d </p>", ["a b c d"]),
        ("<script>var a='<p>x</p>';</script><p>b</p><style>p{}</style>", ["b"]),
        ("<script>never closed <p>x</p>", []),
        ("<!-- <p>x</p> --><p>y</p><!-- open <p>z", ["y"]),
        ("<nav><p>x</p></nav><div class='site-footer'>f</div><div id=sidebar-left>s</div><p>y</p>", ["y"]),
        ("<div class='ad'><p>buy</p><div>more</div></div><p>y</p>", ["y"]),
        ("<div class='address'><p>kept</p></div>", ["kept"]),
        ("<form><p>x</p><textarea><p>z</textarea></form><p>y</p>", ["y"]),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>y</p></article>", ["Title", "y"]),
        ("<article><p>y</p><section class='comments'><p>first!</p></section></article>", ["y"]),
        ("<div role=navigation>x</div><div hidden>z</div><p>y", ["y"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p title='a > b'>x</p><p title=\"unclosed>y</p>", ["x", "y"]),
        ("a < b and <3 <p>c</p>", ["a < b and <3", "c"]),
        ("<p>x</div></p></span>y", ["x", "y"]),
        ("plain text", ["plain text"]),
        ("", []),
        ("<p>cut off in a ta<p", ["cut off in a ta"]),
    ],
)
def test_blocks(html, expected):
    assert texts(html) == expected


PAGE = (
    "<html><body class='has-sidebar'><div class='top'><a href='/'>Home</a></div><div id='c' class='post-{n} body'>"
    "<h1>T{n}</h1><p>Some longer text of page {n}.</p><p>And more &amp; more of it.</p></div>"
    "<div class='extra'>{extra}</div></body></html>"
)


def test_consensus_decides_where_a_page_alone_would_go_wrong(spark):
    rows = [(n, "http://h.example/x", PAGE.format(n=n, extra="short")) for n in range(8)]
    rows.append((99, "HTTP://H.example:80/y", PAGE.format(n=99, extra="A very long extra box. " * 40)))
    out = {r.page_id: r for r in X.extract(pages(spark, rows)).collect()}
    assert {r.path for r in out.values()} == {"body/div.body.post-#"} and {r.host for r in out.values()} == {"h.example"}
    assert out[99].text == "T99\nSome longer text of page 99.\nAnd more & more of it."


def test_awkward_rows_and_both_joins(spark):
    rows = [
        (1, None, None),
        (2, "no url", ""),
        (2, "no url", ""),
        (None, "http://a/", "<article><p>x</p></article>"),
        (3, "http://a/", "<div><p>other template</p></div>"),
        (4, "http://b/", "<p>" + "long " * 100_000 + "</p>"),
    ]
    docs = pages(spark, rows)
    small = sorted(map(str, X.extract(docs).collect()))
    large = sorted(map(str, X.extract(docs, broadcast_hosts=0).collect()))
    assert small == large and len(small) == len(rows)
    out = {(r.page_id, r.text) for r in X.extract(docs).select("page_id", "text").collect()}
    assert {(1, ""), (2, ""), (None, "x"), (3, "other template"), (4, ("long " * 100_000).strip())} == out
    assert X.extract(pages(spark, [])).count() == 0


def test_given_pages_match_the_article_cut_out_by_hand(spark, sf_small):
    def by_hand(html):
        article = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        parts = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", p))).split()) for p in parts]
        return "\n".join(filter(None, parts))

    source = table(spark, sf_small, "pages")
    expected = {r.page_id: by_hand(r.html) for r in source.collect()}
    assert {r.page_id: r.text for r in X.extract(source).collect()} == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<article><h1>T</h1><div class=content><p>{long}</p></div></article>", "T\n{long}"),
        ("<article><h1>T</h1><section class=a>{long}</section><section class=b>short</section></article>", "T\n{long}\nshort"),
        ("<div class=post><h1>T</h1><div class=intro>lead</div><div class=content>{long}</div></div>", "T\nlead\n{long}"),
        ("<article><p>lead</p><table><tr><td>{long}</td></tr></table><p>end</p></article>", "lead\n{long}\nend"),
        ("<div class=post><p>lead</p><blockquote>{long}</blockquote></div>", "lead\n{long}"),
        ("<div id=page><div class=top><a href=/>Home</a> <a href=/a>A</a></div><div class=content>{long}</div></div>", "{long}"),
    ],
)
def test_title_lead_and_sibling_sections_stay(spark, page, expected):
    rows = [(n, "http://h.example/x", page.format(long=f"A long text of page {n}. " * 20)) for n in range(3)]
    out = {r.page_id: r.text for r in X.extract(pages(spark, rows)).collect()}
    assert out == {n: expected.format(long=(f"A long text of page {n}. " * 20).strip()) for n in range(3)}


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<div id=page class='has-sidebar'><p>y</p></div><p>z</p>", ["y", "z"]),
        ("<div class='content-with-sidebar no-comments'><p>y</p></div><p>z</p>", ["y", "z"]),
        ("<div class='post category-social tag-ads'><p>y</p></div><p>z</p>", ["y", "z"]),
        ("<div class='page-sidebar'><article><p>y</p><div class=comments>c</div></article></div><p>z</p>", ["y", "z"]),
        ("<article><p>y</p><div class=comments><article>c</article></div></article>", ["y"]),
        ("<nav class=menu><article>n</article></nav><p>y</p>", ["y"]),
        ("<p class='market-share'>a <span class='related-term'>b</span></p><p class=ad>c</p>", ["a b"]),
        ("<div class='layout-widget'><p>y</p></div>", ["y"]),
    ],
)
def test_names_of_wrappers_do_not_lose_the_article(html, expected):
    assert texts(html) == expected


LONG = "A long text of the page. " * 20


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<form><div class=nav>m</div><div class=content><h1>T</h1><p>{long}<input><label>l</label></div></form><footer>f</footer>", ["T", "{long}"]),
        ("<form><p>{long}</p></form><p>y</p>", ["{long}", "y"]),
        ("<form><label>Name</label> Sign in to read on</form><p>{long}</p>", ["{long}"]),
        ("<form class=login-form><p>{long}</p></form><p>y</p>", ["y"]),
        ("<div role=form><p>x</p></div><p>{long}</p>", ["{long}"]),
        ("<div class=banner><h1>T</h1><p>{long}</p></div><p>y</p>", ["T", "{long}", "y"]),
        ("<div class=comments><h1>T</h1><p>{long}</p></div><p>y</p>", ["y"]),
        ("<article><section id=social-housing>a</section><div class=share-price>b</div><div class=banner-year>c</div></article>", ["a", "b", "c"]),
        ("<article><p>y</p><ul class=commentlist><li>c</ul><div class=commentBody>c</div></article>", ["y"]),
        ("<div class=adbox>a</div><div class=cookieBar>b</div><div class=shareButtons>c</div><div class=sideNav__nav>d</div><p>y</p>", ["y"]),
        ("<article><p>y</p><div class=cookie-recipes>z</div></article><div class=cookie-law>c</div>", ["y", "z"]),
        ("<p>y</p><p style='color: red; display: none'>h</p><div style=visibility:hidden>h</div><div aria-hidden=true>h</div>", ["y"]),
        ("<p>y</p><p style='display: block' aria-hidden=false>z</p>", ["y", "z"]),
    ],
)
def test_what_is_left_out_is_weighed(html, expected):
    assert texts(html.format(long=LONG)) == [e.format(long=LONG).strip() for e in expected]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<h1>T {n}</h1><div class=body><p>{long}</p></div><div class=extra>x</div>", "T {n}\n{long}"),
        ("<h1>T {n}</h1><p>lead</p><p><a href=/>All pages</a></p><div class=body><p>{long}</p></div>", "T {n}\nlead\n{long}"),
        ("<h1><a href=/>Site</a></h1><div class=body><p>{long}</p></div>", "{long}"),
        ("<h1>Site</h1><div class=body><h1>T</h1><p>{long}</p></div>", "T\n{long}"),
    ],
)
def test_headline_before_the_winning_container(spark, page, expected):
    rows = [(n, "http://h.example/x", page.format(n=n, long=LONG * 2)) for n in range(3)]
    out = {r.page_id: r.text for r in X.extract(pages(spark, rows)).collect()}
    assert out == {n: expected.format(n=n, long=(LONG * 2).strip()) for n in range(3)}


def test_several_templates_on_one_host(spark):
    article = "<article><h1>T{n}</h1><p>{long}</p></article><div class=extra>x</div>"
    server = "<form><div class=nav>m</div><div class=content><h1>T{n}</h1><p>{long}</p></div></form><div class=site-footer>f</div>"
    plain = "<h1>T{n}</h1><div class=body><p>{long}</p></div><div class=sideBar>s</div>"
    rows = [(n, "http://h.example/x", (article, server, plain)[n % 3].format(n=n, long=LONG)) for n in range(12)]
    out = {r.page_id: r.text for r in X.extract(pages(spark, rows)).collect()}
    assert out == {n: f"T{n}\n{LONG.strip()}" for n in range(12)}
