import re
import time
from html import unescape

import pytest

from recurwork.llm.html_text import LABELLED, SECOND, decide, extract_pages, grow, main_text

TREE, REST = grow(LABELLED), grow(SECOND, marks=0)


def text(html):
    return main_text(html, TREE, REST)[0]


def test_tree_fits_its_table_and_is_not_a_list_of_it():
    assert all(decide(TREE, r) == r[-1] for r in LABELLED)

    def leaves(t):
        return 1 if isinstance(t, int) else leaves(t[2]) + leaves(t[3])

    assert leaves(TREE) < len(LABELLED) / 4


def test_article_among_everything_else():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><p>Slogan</p></header>
    <div class="cookie-notice"><p>We use cookies to make this site a better place for all of you.</p></div>
    <nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div id="sidebar"><p>Long words in the sidebar that nobody wants to read.</p></div>
    <article class="post"><h1>Title</h1><p>One <b>two</b><br>three &amp; four&nbsp;five&#33;<p>Of.</p><div class="ad">Buy</div><p>See <a href=x>all</a>
    of <span class="ad">BUY</span>it</p><script>if (a < b) { "</p>" }</script><form><p>Your mail</p></form><!-- no <p>x</p> -->
    <section class="comments"><p>Great post, I read all of it twice.</p></section></article><aside>More</aside><footer>&copy; us</footer></body></html>"""
    assert text(html) == "Title\nOne two three & four five!\nOf.\nSee all of it"


def test_page_without_an_article_is_told_by_words_and_links():
    html = "<div><a>Home</a> <a>About</a></div><div><p>" + "word " * 40 + "</p><p>short one.</p><p>" + "more " * 30 + "</p></div><div>c 2020</div>"
    assert text(html) == ("word " * 40).strip() + "\nshort one.\n" + ("more " * 30).strip()


def test_broken_markup_ends_somewhere():
    for html in ("", "<", "a < b", "<p", "<p title=\"x>y", "<!-- x", "<script>x", "</p></div></article>", "<article><p>a<p>b", "<article>a</div>b</article>c",
                 "<article><b><p>x</b>y</article>", "&#xZZ; &bogus; &amp", "<article><p " + "a='b' " * 2000 + ">t</p>" + "<a title=\"" * 200):
        text(html)
    assert text("<article><p>a<p>b") == "a\nb"
    assert text("<article><p>x\x00 &am</p></article>") == "x\x00 &am"


def test_whole_long_page():
    parts = [f"Paragraph {i}." for i in range(20_000)]
    assert text("<article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>") == "\n".join(parts)


def test_pages_against_their_own_structure(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract_pages(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        own = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert got[r.page_id].text == "\n".join(b for b in own if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, None, None, 1), (1, "u", "<article>x", 2), (1, "u", "<article>x", 2), (2, "v", "", 3)],
                               "page_id long, url string, html string, text long")
    assert sorted((r.text, r.n_chars) for r in extract_pages(df).collect()) == [("", 0), ("", 0), ("x", 1), ("x", 1)]
    assert extract_pages(df.limit(0)).count() == 0


LONG, MORE = ("word " * 60).strip(), ("more " * 45).strip()


def test_marks_of_wrappers_do_not_lose_the_article():
    side = "<div class='sidebar'><p>who we are</p></div>"
    assert text(f"<div class='content-sidebar-wrap'><main><h1>T</h1><p>short one</p></main>{side}</div>") == "T\nshort one"
    assert text(f"<main><div class='content-sidebar-wrap'><article><p>a b</p></article>{side}</div></main><footer>{LONG}</footer>") == "a b"
    assert text(f"<div class='sidebar-right'><nav><a>x</a></nav><div><p>{LONG}</p><p>short</p><p>{MORE}</p></div>{side}</div>") == f"{LONG}\nshort\n{MORE}"
    assert text("".join(f"<div class='elementor-widget elementor-widget-text-editor'><p>{p}</p></div>" for p in (LONG, MORE))
                + "<div class='elementor-widget elementor-widget-nav-menu'><a>n</a></div>") == f"{LONG}\n{MORE}"
    assert text(f"<form id=aspnetForm><nav><a>q</a></nav><h1>T</h1><p>{LONG}</p><p>b</p><p>{MORE}</p><div class=comments><p>{LONG}</p></div></form>") \
        == f"T\n{LONG}\nb\n{MORE}"


def test_layout_names_are_weighed_by_words_and_links():
    assert text(f"<article><p>{MORE}</p><div class=widget><p>{LONG}</p></div><div class=widget><p>tiny</p></div>"
                f"<div class=widget><a>{LONG}</a></div></article>") == f"{MORE}\n{LONG}"


def test_marks_that_do_not_wrap_stay():
    assert text(f"<article><p>{MORE}</p></article><section class=comments><article><p>{LONG} {LONG} {LONG}</p></article></section>"
                f"<aside><article><p>{LONG}</p></article></aside>") == MORE
    assert text(f"<main><p>{MORE}</p><div class=comments><article>{LONG} {LONG}</article></div></main>") == MORE
    assert text(f"<div class=post><p>{MORE}</p></div><footer>{LONG} {LONG}</footer>") == MORE


def test_elements_that_are_not_closed_end_at_the_next_block():
    assert text("<article><p>a<button>Open<p>b<svg><path d=1><p>c<button>x</button> d<object data=x>fall<p>e<select><option>1<div>f</div>"
                "<canvas>g<p>h</article>") == "a\nb\nc d\ne\nf\nh"
    assert text("<article><p>a<object><object>x</object><p>y</p></object>b<script>c<p>d") == "a b"


def test_second_tree_fits_its_table():
    assert all(decide(REST, r) == r[-1] for r in SECOND)


LINES = [f"Short words number {i}." for i in range(12)]
MENU = "<div><a href=/>Home</a> <a href=/a>About</a></div>"
RIGHTS = "<div>© 2020 Us. All rights reserved.</div>"


@pytest.mark.parametrize(("body", "want"), [
    ("<h1>Title</h1><p>One short paragraph.</p>", ["Title", "One short paragraph."]),
    ("<div>" + "".join(f"<p>{x}</p>" for x in LINES) + "</div>", LINES),
    ("<h2>Head</h2>" + "".join(f"<p>{x}</p>" for x in LINES), ["Head", *LINES]),
    ("<div><p>" + "word " * 40 + "</p><p>" + "more " * 50 + "</p><p>The end.</p></div>", [("word " * 40).strip(), ("more " * 50).strip(), "The end."]),
    ("<div><p>“To be?”</p><p>" + "more " * 50 + "</p></div>", ["“To be?”", ("more " * 50).strip()]),
    ("<div>No stop here<br>nor there</div>", ["No stop here nor there"]),
])
def test_short_paragraphs_of_a_page_without_an_article(body, want):
    assert text(body) == "\n".join(want)
    if want[0][-1] != "e":  # a page of no sentence has nothing that tells its text from what stands around
        assert text(MENU + body + RIGHTS) == text(f"<body>{MENU}<main-part>{body}</main-part>{RIGHTS}") == "\n".join(want)


def test_what_stands_apart_from_the_text_stays_out():
    long = "<div><p>" + "word " * 40 + "</p><p>" + "more " * 50 + "</p></div>"
    for rest in (RIGHTS, MENU, "<div>Follow us.</div>", "<div><h4>Latest</h4><a href=x>One</a><a href=y>Two</a></div>", "<nav>Short words here.</nav>",
                 '<div class="cookie-bar">We use cookies.</div>'):
        assert text(MENU + long + rest) == ("word " * 40).strip() + "\n" + ("more " * 50).strip()
    assert text("<nav><p>Short words.</p></nav><footer>c 2020.</footer>") == text(MENU) == ""


def test_wrappers_nested_in_any_depth():
    for n in (1, 15, 16, 17, 40, 2000):
        start = time.time()
        inner = '<h1>Title</h1><p>' + "word " * 40 + '</p><div class="widget"><a href=x>Buy it</a></div><p>' + "more " * 40 + "</p>"
        for open_ in ('<div class="sidebar-wrap">', '<div class="promo"><div class="sidebar">'):
            html = open_ * n + inner + "</div>" * (n * open_.count("<div"))
            assert text(html) == "Title\n" + ("word " * 40).strip() + "\n" + ("more " * 40).strip(), n
        assert time.time() - start < 20


def test_a_mark_inside_the_wrapped_text_stays_beyond_sixteen_wrappers():
    inner = '<h1>Title</h1><p>' + "word " * 40 + '</p><div class="sidebar"><p>' + "aside " * 25 + "</p></div><p>" + "more " * 40 + "</p>"
    want = text('<div class="sidebar">' * 3 + inner + "</div>" * 3)
    assert "aside" not in want and want.startswith("Title")
    assert text('<div class="sidebar">' * 30 + inner + "</div>" * 30) == want
    steps = "".join(f'<div class="sidebar">w{i} ' for i in range(30)) + inner + "</div>" * 30
    assert "aside" not in text(steps) and "Title" in text(steps)
