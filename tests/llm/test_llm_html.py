"""Main text of hand-written pages, of the given kind and others, whole and broken."""

import random
import time

import pytest

from lexspark.llm import html

LONG = "A first, longer paragraph of the article, with commas, so that it scores."
PAGES = {
    "": "",
    "   ": "",
    "plain text only": "plain text only",
    "<nav><a href=x>only a menu</a></nav>": "",
    f"<body><nav><ul><li><a href=a>Menu</a></ul></nav><div class=ad>Buy, now, this.</div><article><h1>T&amp;t</h1><p><b>{LONG}<br><p>Short.</p></article><footer>&copy; f</footer>": f"T&t\n{LONG}\nShort.",
    f"<div id=page><div class=sidebar><p>{LONG} Side.</p></div><div class=content><h2>Head</h2><p>{LONG}</p><p>B.</p><ul><li>one<li>two</ul></div><div id=comments><p>{LONG} me too!</p></div></div>":
        f"Head\n{LONG}\nB.\none\ntwo",
    f"<header><h1>Site</h1></header><main><article><header><h1>Title</h1></header><section><p>{LONG}</section><section><p>Tiny.</section><form><p>{LONG}</form></article><aside>{LONG}</aside></main>":
        f"Title\n{LONG}\nTiny.",
    f"<script>var a='<p>{LONG}</p>';</script><style>p{{}}</style><p>{LONG}</p><!-- <p>no</p> -->": LONG,
    f"<article><p>{LONG}</p><table><tr><td>c1<td>c2<tr><td>c3</table><pre>a\n  b</pre></article>": f"{LONG}\nc1\nc2\nc3\na b",
    "<p>x &lt;b&gt; &#233;&#x1F642; &nbsp; &eacute</p>": "x <b> é🙂 é",
    '<div><p title="a>b">Text, with a sign, in an attribute.</p><p unclosed="x': "Text, with a sign, in an attribute.",
    f"<article><p>{LONG}</p><div class='cookie-notice'>We use cookies.</div><div class=related><a href=x>More</a></div></article>": LONG,
    f"<div class=post><p>{LONG}</p></div><div class=post><p>{LONG} Again.</p></div>": f"{LONG}\n{LONG} Again.",
    f"<p>{LONG}</p><script>never closed": LONG,
}


@pytest.mark.parametrize("page", PAGES)
def test_page(page):
    assert html.main_text(page) == PAGES[page]


def test_broken_pages_do_not_crash():
    r = random.Random(8)
    bits = ["<", ">", "</", "<p", "<p>", "</p>", "<div class='", "'", '"', "<!--", "-->", "<![CDATA[", "]]>", "<script>", "</script", "&", "&#", "&#xFFFFFFFF;", "&amp", "text, a bit", "<table><td>", "</article>", "<article>", "<li>", "<a href=x>", "</a>", "\x00", "<?x", "<!x"]
    for _ in range(2000):
        html.main_text("".join(r.choice(bits) for _ in range(r.randint(1, 40))))
    assert html.main_text("<div>" * 20_000 + "deep, text" + "</div>" * 20_000) == "deep, text"
    assert html.main_text("<p>" + "word, " * 200_000) == ("word, " * 200_000).strip()


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "<p>é🙂</p>", "x")], "page_id long, url string, html string, text string")
    got = html.extract(pages)
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()) == [(0, "é🙂", 2), (1, "", 0), (1, "", 0)]
    assert got.columns == ["page_id", "url", "text", "n_chars"] and html.extract(pages.limit(0)).count() == 0


WRAPPED = [
    "<div class='content has-sidebar'>{}</div>", "<div class='post-body no-comments'>{}</div>", "<div id=page class=nav-closed><article>{}</article></div>",
    "<section id=search><article>{}</article></section>", "<div class=tags-page><article>{}</article></div>", "<form id=aspnetForm><div class=content>{}</div></form>",
    "<div class=social><main>{}</main></div>",
]


@pytest.mark.parametrize("page", WRAPPED)
def test_no_article_is_lost_for_the_names_around_it(page):
    assert html.main_text(page.format(f"<p>{LONG}</p>")) == LONG


def test_articles_that_are_comments_or_teasers_go():
    page = f"<article><p>{LONG}</p></article><div id=comments><article class=comment><p>{LONG} me too</p></article></div><div class=related><article><p>{LONG} next</p></article></div>"
    assert html.main_text(page) == LONG
    assert html.main_text(f"<article><p>{LONG}</p><form><p>Write to us, now.</p></form></article>") == LONG


def test_a_short_second_part_stays():
    assert html.main_text(f"<div><div><p>{LONG * 6}</p></div><div><p>{LONG * 4}</p></div></div>") == f"{LONG * 6}\n{LONG * 4}"


def test_deep_pages_with_text_at_each_level():
    start = time.process_time()
    got = html.main_text("".join(f"<div>level, {k}" for k in range(4000)))
    assert time.process_time() - start < 2 and got.count("\n") > 3000
    start = time.process_time()
    html.main_text("<p>x" + "<span>y" * 20_000)
    assert time.process_time() - start < 2


def test_scores_equal_a_walk_over_all_ancestors():
    r = random.Random(11)
    for _ in range(200):
        page = "".join(r.choice(["<div>", "</div>", "<p>", "</p>", "<section>", "</section>", "<ul><li>", "</ul>", "<h2>T</h2>", f"{LONG} ", "short, text ", "<a href=x>linked text</a>", "<nav>", "</nav>"]) for _ in range(40))
        root = html.tree(page)
        found = html.blocks(root)
        points, below = {}, {}
        for owner, text, linked in found:
            worth = 0 if owner.tag in (*html.HEADINGS, "li") else (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / len(text)) * min(1, len(text) / 25)
            node, share = (owner.parent if owner.tag == "p" else owner), 1.0
            while node is not None:
                points[id(node)] = points.get(id(node), 0) + worth * share
                node, share = node.parent, share / 2
            node = owner
            while node is not None:
                size, links = below.get(id(node), (0, 0))
                below[id(node)] = size + len(text), links + linked
                node = node.parent
        nodes = html._score(root, found)
        assert {id(n): (n.size, n.links) for n in nodes} == below
        assert all(abs(n.score - points.get(id(n), 0)) < 1e-9 for n in nodes)
