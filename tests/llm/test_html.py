"""Main text: the table's articles word for word, other layouts, malformed markup."""

import html as html_lib
import re
import time
from collections import Counter

from sitewatch.llm import html_extract as H

from .helpers import SMALL


def test_table_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


LONG = "A paragraph with enough words in it to be told apart from menus and the like. " * 3


def test_what_is_not_the_article():
    page = f"""<html><head><title>T</title><style>p {{}}</style></head><body>
    <header><h1>Site</h1><a href=/>Home</a></header>
    <div class="cookie-banner">We use cookies to make this a long and friendly sentence.</div>
    <div id=wrap><main><h1>Title</h1><p>{LONG}</p><p>Short.</p>
    <aside>Read also: {LONG}</aside><div class="ad-box ads">{LONG}</div>
    <form><label>Your mail</label><input name=a><button>Go</button></form>
    <ul><li><a href=1>one more</a><li><a href=2>two more</a><li><a href=3>three more</a></ul>
    <ul><li>A point</li><li>Another point</li></ul>
    <script>var x = "<p>no</p>";</script><p hidden>unseen</p>
    <p>{LONG}<br>After&nbsp;the &lt;break&gt;</p>
    <section class="comments"><h2>Comments</h2><p>{LONG}</p></section></main></div>
    <div class=sidebar><p>{LONG}</p></div><footer>&copy; {LONG}</footer></body></html>"""
    long = LONG.strip()
    assert H.extract(page).split("\n") == [
        "Title", long, "Short.", "one more", "two more", "three more", "A point", "Another point",
        f"{long} After the <break>"]


def test_no_article_element():
    page = f"""<body><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>Old</a></ul>
    <div><div class=box><h2>Head</h2><p>{LONG}<p>Tiny<p>{LONG}</div></div>
    <div><a href=4>Next</a></div></body>"""
    assert H.extract(page).split("\n") == ["Head", LONG.strip(), "Tiny", LONG.strip()]
    flat = f"<p><a href=1>Home</a> <a href=2>News</a><h1>Head</h1><p>{LONG}<p>Tiny<p>{LONG}<p>End."
    assert H.extract(flat).split("\n") == ["Head", LONG.strip(), "Tiny", LONG.strip(), "End."]


def test_wrappers_are_no_asides():
    long = LONG.strip()
    body = f"<h1>Title</h1><p>{LONG}</p><p>{LONG}</p>"
    junk = f"<div class='sidebar-left'><p>{LONG}</p></div><div id=comment-list><p>{LONG * 2}</p></div>"
    for wrapper in ("div class='has-sidebar'", "div class='content no-sidebar'", "div class='with-comments'",
                    "form id=aspnetForm", "form", "div class=widget", "div class=right-sidebar"):
        for inner in (body, f"<article>{body}</article>"):
            page = f"<body><{wrapper}>{inner}{junk}</{wrapper.split()[0]}><div>End</div></body>"
            got = H.extract(page).split("\n")
            assert got[:3] == ["Title", long, long] and len(got) <= 4, (wrapper, got)
    page = f"<div class='search'><main>{body}</main></div><p>{LONG}</p>"
    assert H.extract(page).split("\n") == ["Title", long, long]
    # comments stay asides however long, also where each is an article
    page = f"<main>{body}</main><div class=comments>" + f"<article><p>{LONG}</p></article>" * 9 + "</div>"
    assert H.extract(page).split("\n") == ["Title", long, long]
    page = f"<div>{body}</div><div class=comments>" + f"<p>{LONG}</p>" * 30 + "</div>"
    assert H.extract(page).split("\n") == ["Title", long, long]
    assert H.extract(f"<div class=comments><p>{LONG}</p></div>") == long


def test_names_inside_the_article():
    long = LONG.strip()
    page = f"""<article><div class='entry-header'><h1>Title</h1></div><p>{LONG}</p>
    <section id='discussion'><h2 id='search'>Search</h2><p>{LONG}</p></section>
    <p class='notice-period'>{LONG}</p><div class='ad-300x250'>Buy</div><p class=comment2>No.</p></article>"""
    assert H.extract(page).split("\n") == ["Title", long, "Search", long, long]


def test_whole_article_in_parts():
    long, nav = LONG.strip(), "<ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>Old</a></ul>"
    three, two = f"<p>{LONG}</p>" * 3, f"<p>{LONG}</p>" * 2
    for parts in (f"<section>{three}</section><section>{two}</section>",
                  f"<div><section>{three}</section></div><div><section>{two}</section></div>",
                  f"<blockquote>{three}</blockquote>{two}",
                  f"<table><tr><td>{three}<td>{two}</table>"):
        page = f"<body>{nav}<div id=content><h1>Title</h1>{parts}</div><div><a href=4>Next</a></div></body>"
        assert H.extract(page).split("\n") == ["Title"] + [long] * 5, parts
        page = f"<body>{nav}<div><div id=content><h1>Title</h1>{parts}</div><p><a href=4>Next</a></p></div></body>"
        assert H.extract(page).split("\n") == ["Title"] + [long] * 5, parts
    both = f"<main><article>{three}</article><article>{two}</article></main>"
    for page in (both, both[6:-7], f"<div>{both}</div><section><article>{two}</article></section>"):
        assert H.extract(f"<body>{nav}{page}</body>").split("\n") == [long] * 5
    inner = f"<main><p><a href=1>Up</a></p><article>{three}</article></main>"
    assert H.extract(inner).split("\n") == [long] * 3


def test_long_list_or_code_is_not_all():
    said = "Mix all of it well and let it rest for an hour or so, then bake it."
    items = "".join(f"<li>{said} Step {i}.</li>" for i in range(40))
    code = "\n".join(f"value_{i} = compute(value_{i - 1}, {i})" for i in range(300))
    for block, n in ((f"<ol>{items}</ol>", 40), (f"<div class=highlight><pre>{code}</pre></div>", 1)):
        page = f"<body><div id=content><h1>Title</h1><p>{said}</p>{block}<p>{said}</p></div><div><a href=4>Next</a></div>"
        got = H.extract(page).split("\n")
        assert got[:2] == ["Title", said] and got[-1] == said and len(got) == n + 3
        got = H.extract(page.replace("<h1>Title</h1>", "")).split("\n")
        assert got[0] == got[-1] == said and len(got) == n + 2


def test_malformed_and_empty():
    assert H.extract("") == "" and H.extract("   ") == "" and H.extract("<p></p><br>") == ""
    assert H.extract("just text") == "just text"
    assert H.extract("<p>a &amp b &am; <b>c<p>d</i></div></p>") == "a & b &am; c\nd"
    for odd in ("<![foo<p>x", "<!doctype", "<!--", "<p", "</", "<a href='", "&#x110000;", "<p>&#0;",
                "<script>", "<style>p", "<title>t", "<![CDATA[x]]>", "<?php x", "<" * 1000):
        H.extract(odd)


def test_feeding_in_pieces(monkeypatch):
    page = f"<body><article><h1>T &amp; U</h1><p>{LONG}</p><p>x &lt; y</p></article></body>"
    whole = H.extract(page)
    monkeypatch.setattr(H, "FEED", 3)
    assert H.extract(page) == whole == f"T & U\n{LONG.strip()}\nx < y"


def test_long_page_and_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (4, "u", "<p>x"), (4, "u", "<p>x"),
            (5, "u", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = H.main_text(df.selectExpr("*", "'t' AS text", "1 AS n_chars")).collect()
    texts = sorted((str(r.page_id), r.n_chars) for r in got)
    assert texts == sorted([("1", 0), ("2", 0), ("None", 1), ("4", 1), ("4", 1),
                            ("5", 3001 * 0 + 3000 * len(LONG.strip()) + 2999)])
    assert H.main_text(df.limit(0)).count() == 0


def test_own_lists_and_weak_names_of_the_article():
    """A list of sources stays, a nav's list goes; a paragraph named search stays, a box goes."""
    long = LONG.strip()
    links = "<ul><li><a href=1>First source</a><li><a href=2>Second</a><li><a href=3>Third</a></ul>"
    box = "<div class=search>Find <input> <b>now</b> <i>or</i> <u>then</u></div>"
    inner = f"<h1>Title</h1><p>{LONG}</p><div class=search><p>{LONG}</p></div>{box}<p>{LONG}</p>{links}"
    want = ["Title", long, long, long, "First source", "Second", "Third"]
    for tag in ("article", "main", "div"):
        page = f"<body><nav>{links}</nav>{links}<div><{tag}>{inner}</{tag}></div>{links}</body>"
        got = H.extract(page).split("\n")
        assert got == want, (tag, got)


def _plain(page):
    """The page without names: only divisions, paragraphs, lists, headings and links."""
    page = re.sub(r"(</?)(article|main|nav|footer|aside|header)\b", r"\1div", page)
    return re.sub(r'\s(class|id|role)="[^"]*"', "", page)


def test_region_without_names(spark):
    """Precision and recall of lines on the table's pages with all names taken out."""
    right = got_all = want_all = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = r.html[r.html.index("<article>") + 9:r.html.index("</article>")]
        want = [" ".join(html_lib.unescape(re.sub(r"<[^>]+>", " ", b)).split())
                for b in re.split(r"</?(?:p|h1)>", article)]
        want = Counter(w for w in want if w)
        got = Counter(H.extract(_plain(r.html)).split("\n"))
        right += sum((want & got).values())
        got_all, want_all = got_all + sum(got.values()), want_all + sum(want.values())
    assert right >= 0.95 * got_all and right >= 0.95 * want_all


def test_cost_grows_with_the_page_only():
    """A hundred thousand elements left open, of any kind, and nested named ones."""
    for piece in ("<div>x", "<p>x", "<font>x", "<li>x", "<article>x",
                  "<div class=ad><ul><li><a href=1>x"):
        start = time.process_time()
        H.extract(piece * (100_000 // piece.count("<")))
        assert time.process_time() - start < 6, piece  # under 2 s on a free core
