"""Wrapper inference and text extraction on made hosts and on the given pages."""

from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from chartweave.llm import queries
from chartweave.llm.wrappers import extract_text, infer_wrappers

from .conftest import prose

DATA = "/root/testdata/sf0.01"


@pytest.fixture()
def pages(spark):
    def make(rows):
        ddl = "page_id LONG, url STRING, html STRING, host STRING, wrapper INT, id STRING"
        return spark.createDataFrame([(*r, "h", 1, "i") for r in rows], ddl).repartition(3)

    return make


def _page(n: int, kind: str):
    rng = random.Random(n)
    blocks = [" ".join(prose(n * 50 + k, rng.randrange(5, 30)).split()) for k in range(rng.randrange(1, 6))]
    paragraphs = "".join(f"<p>{html.escape(b)}</p>\n" for b in blocks)
    menu = "".join(f'<li><a href="/{k}">{prose(n + k, 2)}</a></li>' for k in range(rng.randrange(2, 7)))
    promo = f'<div class="promo-box">{prose(n, 6)}</div>' if n % 3 else ""
    if kind == "article":
        body = f"<header>x{n}</header><nav><ul>{menu}</ul></nav><article>{paragraphs}<div class='comments'><p>{prose(n, 9)}</p></div></article>"
    else:  # nothing names the content; menus, notices and a line that all pages share are around it
        body = f"<div id='top{n}'><ul>{menu}</ul></div><div id='w'><p class='q'>All pages say this.</p>{paragraphs}</div>"
        body += f"<form><p>{prose(n, 4)}</p></form><div class='cookie-notice'>{prose(n, 5)}</div>"
    return f"<html><head><title>t</title></head><body><!-- <p>no</p> -->{promo}{body}<footer>f{n}</footer><script>x='<p>'</script></body></html>", blocks


@pytest.mark.parametrize("kind", ["article", "plain"])
def test_main_text(pages, kind):
    made = [_page(n, kind) for n in range(12)]
    rows = [(n, f"https://{kind}.example/{n}", page) for n, (page, _) in enumerate(made)]
    got = {r.page_id: r.text for r in extract_text(pages(rows)).collect()}
    assert got == {n: "\n".join(blocks) for n, (_, blocks) in enumerate(made)}


@pytest.mark.parametrize("address", ["https://mixed.example/", ""])
def test_each_page_of_a_mixed_host_has_its_own_section(pages, address):
    made = []
    for n in range(24):
        page, blocks = _page(n, "article" if n % 3 == 0 else "plain")
        if n % 3 == 1:
            page = page.replace("<div id='w'><p class='q'>All pages say this.</p>", "<main>").replace("</div><form>", "</main><form>")
        made.append((page, blocks))
    made += [(None, []), ("", []), ("<h1>Out of order</h1>", ["Out of order"])]
    rows = [(n, address + str(n), page) for n, (page, _) in enumerate(made)]
    got = {r.page_id: r.text for r in extract_text(pages(rows)).collect()}
    assert got == {n: "\n".join(blocks) for n, (_, blocks) in enumerate(made)}


def test_loose_signs_leave_text_in_place(pages):
    inner = (
        "<h2><a href='/a'>Linked heading</a></h2><div class='share-price'>up</div><div class='side-by-side'>pair</div>"
        "<div class='legal'>law</div><div class='share-buttons'>no</div><div class='site-footer'>no</div>"
        "<ul><li><a href='/r'>Reference one</a></li></ul><table><tr><td><a href='/t'>Link table</a></td></tr></table>"
    )
    want = "Linked heading\nup\npair\nlaw\nReference one\nLink table"
    rows = [
        (1, "http://a.x/", f"<body class='no-sidebar'><article class='comments-open'>{inner}</article></body>"),
        (2, "http://b.x/", f"<body class='header-fixed menu'><main id='header'>{inner}</main></body>"),
        (3, "http://c.x/", "<body class='sidebar'><div class='share-price side-by-side'><p>plain</p></div></body>"),
        (4, "http://d.x/", "<div><a href='/1'>first linked page</a> <a href='/2'>second linked page</a></div><div>few words</div>"),
    ]
    got = {r.page_id: r.text for r in extract_text(pages(rows)).collect()}
    assert got == {1: want, 2: want, 3: "plain", 4: "few words"}


def test_copies_within_a_host_keep_their_text(pages):
    copy = "<body><div id='old'><h2>Title</h2><p>one</p><p>two</p></div></body>"
    rows = [(n, "http://some.x/", copy if n < 6 else f"<body><div id='new'><p>text {n}</p></div></body>") for n in range(12)]
    got = {r.page_id: r.text for r in extract_text(pages(rows)).collect()}
    assert got == {n: "Title\none\ntwo" if n < 6 else f"text {n}" for n in range(12)}


def test_wrapper_is_a_union_free_expression(pages):
    rows = [
        (1, "http://a.b:80/x", "<body><ul><li>1</li><li>2</li></ul><h2>a</h2><p>b</p><h2>c</h2><p>d</p></body>"),
        (2, "HTTP://u@A.B/y", "<body><ul><li>1</li></ul><div>new</div><h2>a</h2><p>b</p><h2>e</h2><p>f</p></body>"),
    ]
    (r,) = infer_wrappers(pages(rows)).collect()
    assert r.host == "a.b"
    assert r.pattern == "<page><body><ul>(<li>#</>)+</>(<div>#</>)?(<h2>#</><p>#</>)+</></>"


def _unknown(n: int, kind: str, comments: int):
    """A page whose comments, advert and lines around the text have class names that say nothing."""
    rng = random.Random(n)
    blocks = [" ".join(prose(n * 70 + k, rng.randrange(20, 50)).split()) for k in range(rng.randrange(2, 6))]
    told = "".join(
        f"<div class='zq'><div><span class='k'>Reader {chr(65 + k)}</span> {k + 1} May 2020</div><p>{prose(n * 90 + k, 12)}</p></div>"
        for k in range(comments)
    )
    inner = "".join(f"<p>{b}</p>" for b in blocks) + "<div class='xy'>Follow us for more</div>"
    inner += f"<section class='qq'><h3>{comments} said</h3>{told}</section>" if comments else ""
    start, end = {"article": ("<article>", "</article>"), "main": ("<main>", "</main>"), "plain": ("<div class='w'>", "</div>")}[kind]
    return f"<html><body>{start}<h1>Title {n}</h1>{inner}{end}</body></html>", [f"Title {n}", *blocks]


@pytest.mark.parametrize("kind", ["article", "main", "plain"])
def test_wrapper_decides_inside_sections(pages, kind):
    made = [_unknown(n, kind, n % 4) for n in range(16)]
    rows = [(n, f"https://{kind}.example/{n}", page) for n, (page, _) in enumerate(made)]
    got = {r.page_id: r.text for r in extract_text(pages(rows)).collect()}
    assert got == {n: "\n".join(blocks) for n, (_, blocks) in enumerate(made)}
    alone = [(n, f"https://{kind}{n}.example/", page) for n, (page, _) in enumerate(made)]
    by_itself = {r.page_id: r.text for r in extract_text(pages(alone)).collect()}
    # a page with two or more comments shows them itself; the line and a single comment only the host's pages tell
    assert all(by_itself[n] != got[n] for n in got)
    assert all("Reader A" in by_itself[n] for n in got if n % 4 == 1)


def test_known_words_in_longer_names(pages):
    kinds = ("id='disqus_thread'", "class='post-comments'", "class='user-comments'", "class='ad-slot'", "class='reader-replies'")
    inner = "".join(f"<div {k}><p>out</p></div>" for k in kinds)
    rows = [(n, "http://k.x/", f"<article><p>text {n}</p>{inner}<div class='post'>kept {n}</div></article>") for n in range(3)]
    assert {r.text for r in extract_text(pages(rows)).collect()} == {f"text {n}\nkept {n}" for n in range(3)}


def test_dated_lists_that_are_no_comments_stay(pages):
    def page(n):
        log = "".join(f"<div class='e'><h3>Version {n}.{k}</h3><div>Ann {n}, {k + 1} May 2020</div><p>change {n} {k} and more words</p></div>" for k in range(3))
        table = "".join(f"<tr><td class='author'>Ann {n}</td><td class='date'>{k + 1} May 2020</td></tr>" for k in range(3))
        cited = "".join(f"<li>Smith {n}, {k + 1} May 2020</li>" for k in range(3))
        posts = "".join(f"<div class='b'><div>Ann {n}, {k + 1} May 2020</div><p>{prose(n * 9 + k, 9)}</p></div>" for k in range(3))
        log = f"<h2>Summary</h2><ul><li>salt</li><li>spice {n}</li></ul><table><tr><th>Born</th></tr></table>" + log
        return f"<article><p>intro {n}</p>{log}<table>{table}</table><ul>{cited}</ul>{posts}<p>the end {n}</p></article>"

    rows = [(n, "http://d.x/", page(n)) for n in range(8)]
    for r in extract_text(pages(rows)).collect():
        want = [" ".join(html.unescape(x).split()) for x in re.split("<[^>]*>", page(r.page_id))]
        assert r.text == "\n".join(x for x in want if x)


def test_pages_that_differ_in_little_keep_their_text(pages):
    same = "".join(f"<p>{prose(k, 30)}</p>" for k in range(4))
    rows = [(n, "http://near.x/", f"<article><h1>Same title</h1>{same}<h2>odd {n}</h2></article>") for n in range(9)]
    for r in extract_text(pages(rows)).collect():
        assert r.text.split("\n") == ["Same title", *(" ".join(prose(k, 30).split()) for k in range(4)), f"odd {r.page_id}"]


def test_menus_at_any_depth_are_left_out(pages):
    page = "<div>" * 2500 + "<nav>Menu</nav><p>deep</p>" + "</div>" * 2500
    rows = [(n, "http://deep.x/", page) for n in range(2)] + [(2, "http://deep.x/", "<p>flat</p>")]
    assert sorted(r.text for r in extract_text(pages(rows)).collect()) == ["deep", "deep", "flat"]


def test_odd_pages(pages):
    deep = "<div>" * 3000 + "bottom" + "</div>" * 3000
    rows = [
        (1, None, None), (2, "", ""), (3, "no address", "just &amp; text &lt;b&gt;\xa0 here"), (None, "http://n.x/", "<p>a"),
        (4, "http://d.x/", f"<p>before</p>{deep}<p>after</p>"), (5, "http://c.x/", "<p>one<br>two <b>bo</b>ld<p>three</div><"),
        (5, "http://c.x/", "<p>one<br>two <b>bo</b>ld<p>three</div><"), (6, "http://l.x/", "<p>" + "word " * 200_000 + "</p>"),
        (7, "http://s.x/", "<script>never closed <p>x</p>"),
    ]
    got = sorted(((r.page_id, r.text) for r in extract_text(pages(rows)).collect()), key=repr)
    assert got == sorted(
        [
            (1, ""), (2, ""), (3, "just & text <b> here"), (None, "a"), (4, "before\nbottom\nafter"),
            (5, "one two bold\nthree<"), (5, "one two bold\nthree<"), (6, ("word " * 200_000).strip()), (7, ""),
        ],
        key=repr,
    )
    assert extract_text(pages(rows).limit(0)).count() == 0


def test_copies_of_one_page_keep_their_text(pages):
    rows = [(n, "http://same.x/", "<div><p>one text</p></div>") for n in range(9)]
    assert {r.text for r in extract_text(pages(rows)).collect()} == {"one text"}


def test_query(spark):
    given = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = queries.op5_page_wrappers(spark, DATA).collect()
    assert len(rows) == len(given)
    for r in rows:
        inner = re.search("<article>(.*)</article>", given[r.page_id], re.S)[1]
        parts = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split(r"</?(?:p|h\d)>", inner)]
        assert r.text == "\n".join(" ".join(x.split()) for x in parts if x.strip())
        assert r.n_chars == len(r.text)


def test_hosts(pages):
    rows = [(1, "http://a.x?q=http://b.x/", ""), (2, "https://U:p@B.x:8080/", "")]
    assert {r.host for r in infer_wrappers(pages(rows)).select(F.col("host")).collect()} == {"a.x", "b.x"}
