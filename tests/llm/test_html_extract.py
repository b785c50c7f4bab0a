import html

from innsight.llm import html_extract as he

P = ["The first paragraph of the article, long enough to be dense text in any reading of it.",
     "A second one &amp; <b>bold</b> words with a <a href='/x'>link</a> inside, and then more words after it.",
     "A third with\n  white   space\tand a line<br>break, then the end of it all."]
PLAIN = ["The first paragraph of the article, long enough to be dense text in any reading of it.",
         "A second one & bold words with a link inside, and then more words after it.",
         "A third with white space and a line break, then the end of it all."]
NAV = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu {i}</a></li>" for i in range(6)) + "</ul></nav>"
LINKS = "<div><ul>" + "".join(f"<li><a href='/{i}'>Other story number {i} to read</a></li>" for i in range(8)) + "</ul></div>"
BODY = "".join(f"<p>{p}</p>" for p in P)
WANT = "Title here " + " ".join(PLAIN)


def page(body):
    return f"<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>T</title></head><body>{body}</body></html>"


def test_article_among_boilerplate():
    extra = ("<!-- ad --><div class='ad'>Buy this now, a long line of advertising text that goes on and on.</div>"
             "<div id='cookie-notice'>We use cookies to make this long notice that nobody reads at all.</div>"
             "<aside>Sidebar text of some length that is not in the article at all, by any means.</aside>"
             "<form><label>Your name, a rather long label text for a form field</label><input></form>"
             "<script>var t='</p><p>not text</p>';</script><style>p{margin:0}</style>")
    comments = "<section class='comments'><p>A reader says something quite long about the article here.</p></section>"
    article = f"<article><h1>Title here</h1>{BODY}{comments}</article>"
    for x in (page(f"<header>Site name</header>{NAV}{extra}{article}{LINKS}<footer>&copy; me</footer>"),
              page(NAV + article + extra), page(article), article):
        assert he.main_text(x) == WANT


def test_page_without_an_article_element():
    x = page(f"{NAV}<div id='wrap'><div class='story'><h1>Title here</h1>{BODY}</div>{LINKS}</div><footer>f</footer>")
    assert he.main_text(x) == WANT
    # the title beside its text
    x = page(f"{NAV}<div><h1>Title here</h1><div>{BODY}</div></div>{LINKS}")
    assert he.main_text(x).endswith(" ".join(PLAIN)) and "Other story" not in he.main_text(x)


SIX = "".join(f"<p>{p} Number {i}.</p>" for i in range(2) for p in P)
SIX_TEXT = " ".join(f"{p} Number {i}." for i in range(2) for p in PLAIN)


def test_wrappers_with_unlucky_names_keep_their_article():
    head, foot = f"<header>Site</header>{NAV}", "<footer>&copy; me</footer>"
    comments = "<div class='comments'><p>" + "A reader says something quite long about it. " * 40 + "</p></div>"
    for body in (f"<form id=f>{head}<h1>Title here</h1><div>{SIX}</div>{LINKS}{foot}</form>",
                 f"{head}<div class='content related'><h1>Title here</h1>{SIX}</div>{LINKS}{foot}",
                 f"{head}<div class='share-wrapper'><article><h1>Title here</h1>{SIX}</article></div>{comments}{foot}",
                 f"{head}<div class='notice-of-award'><h1>Title here</h1>{SIX}</div>{foot}",
                 f"{head}<form><div class='sidebar'><div class='notice'><h1>Title here</h1>{SIX}</div></div></form>{foot}",
                 f"{head}<div><div class='article-header'><h1>Title here</h1></div><div>{SIX}</div></div>{LINKS}{foot}"):
        assert he.main_text(page(body)) == "Title here " + SIX_TEXT
    # the heading outside, the text in a box with a notice's name
    assert SIX_TEXT in he.main_text(page(f"{head}<h1>Title here</h1><div class='notice-of-award'>{SIX}</div>{foot}"))


def test_boilerplate_longer_than_the_article_stays_cut():
    comments = "<div class='comments'><p>" + "A reader says something quite long about it. " * 200 + "</p></div>"
    notice = "<div class='cookie-notice'><p>" + "We value your privacy and want to say so at length. " * 40 + "</p></div>"
    assert he.main_text(page(f"{NAV}{notice}<article><h1>Title here</h1>{BODY}</article>{comments}")) == WANT
    hidden = "<div style='display: none'><p>" + "Not to be seen. " * 200 + "</p></div>"
    assert he.main_text(page(f"{hidden}<div><h1>Title here</h1><p>{P[0]}</p></div>")) == "Title here " + PLAIN[0]


def test_densities_equal_brute_force_on_small_trees():
    """Counts by walking each subtree anew, densities by the formula, the core by trying every node."""
    import random
    import re

    def walk(node, in_link):
        chars = tags = link_chars = link_tags = 0
        in_link = in_link or node.tag == "a"
        for x in node.items:
            if isinstance(x, str):
                n = len(re.sub(r"[ \t\n\f\r]+", " ", x).strip(" "))
                chars += n
                link_chars += n if in_link else 0
            else:
                c, t, lc, lt = walk(x, in_link)
                chars, tags, link_chars = chars + c, tags + t + 1, link_chars + lc
                link_tags += lt + (1 if in_link and x.tag != "a" else 0)
        return chars, tags, link_chars, link_tags + (node.tag == "a")

    rng = random.Random(4)

    def tree(depth):
        kids = "".join(tree(depth - 1) for _ in range(rng.randrange(0, 4))) if depth else ""
        tag = rng.choice(["div", "section", "b", "span", "a"] if depth < 3 else ["div", "section"])
        return f"<{tag}>{'word ' * rng.randrange(0, 9)}{kids}{'x' * rng.randrange(0, 4)}</{tag}>"

    for _ in range(60):
        root = he.parse(f"<body>{tree(4)}{tree(3)}</body>")
        he.measure(root)
        nodes = he._in_order(root)
        _, _, lc, _ = walk(root, False)
        share = lc / max(1, walk(root, False)[0])
        density = {}
        for x in nodes:
            inside = any(p.tag == "a" for p in _ancestors(x))
            c, t, lc, lt = walk(x, False)
            if not inside:
                assert (x.chars, x.tags, x.link_chars) == (c, t, lc)
                density[x] = he.composite_density(c, t, lc, x.link_tags, share)
                assert abs(x.density - density[x]) < 1e-9
            assert abs(x.total - sum(k.density for k in x.items if isinstance(k, he.Node))) < 1e-9


def _ancestors(node):
    while node.parent is not None:
        node = node.parent
        yield node


def test_end_tags_left_out():
    x = page(f"{NAV}<article><h1>Title here</h1><p><b>{P[0]}<br><p>{P[1]}<p>{P[2]}</article><div class=ad>buy")
    assert he.main_text(x) == WANT
    x = page("<article><h1>A</h1><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><td>z</table></article>")
    assert he.main_text(x) == "A one two x y z"


def test_inline_elements_join_and_blocks_part():
    assert he.main_text("<p>a<b>b</b>c <i> d</i>e<span>\n</span>f</p><p>g</p>h") == "abc de f g h"


def test_references_and_odd_markup():
    assert he.main_text("<article><p>&copy; &#233;&#x4e2d; &lt;tag&gt; &nbsp;x &unknown; a < b & c</p></article>") \
        == "© é中 <tag> \xa0x &unknown; a < b & c"
    assert he.main_text("<p>a<!-- <p>no</p> -->b<![CDATA[c]]></p>") == "abc"
    assert he.main_text("<article><p title='a > b' data-x=\"<p>\">text</p></article>") == "text"


def test_degenerate_pages():
    for x in (None, "", "   ", "<html></html>", "<script>x", "<!--", "<"):
        assert he.main_text(x) == ("<" if x == "<" else "")
    assert he.main_text("just text, no tags") == "just text, no tags"
    assert he.main_text("</p></div>stray <b>ends</p>") == "stray ends"
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert he.main_text(deep) == "deep"
    long = "<article>" + "<p>word word word</p>" * 30_000 + "</article>"
    assert he.main_text(long) == " ".join(["word word word"] * 30_000)
    for broken in ("<p" * 50_000, "<a \"" * 50_001, "<!--" * 50_000, "<p>x" + "<" * 50_000, "<style>" * 20_000):
        assert he.main_text(broken) is not None


def test_density_falls_with_links():
    plain = he.composite_density(1000, 10, 0, 0, 0.1)
    some = he.composite_density(1000, 10, 300, 3, 0.1)
    links = he.composite_density(1000, 10, 1000, 10, 0.1)
    assert plain > some > links == 0.0 == he.composite_density(0, 5, 0, 0, 0.0)


def test_operator_with_nulls_and_repeats(spark):
    rows = [(1, "u", page(BODY)), (None, None, page(BODY)), (1, "u", page(BODY)), (2, "v", None), (3, "w", "")]
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows],
                               "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(str, map(tuple, he.extract(df).collect())))
    want = " ".join(PLAIN)
    assert got == sorted(map(str, [(1, "u", want, len(want))] * 2 + [(None, None, want, len(want)), (2, "v", "", 0),
                                                                     (3, "w", "", 0)]))
    assert he.extract(df.limit(0)).collect() == []


def test_query_gives_the_article(spark):
    """The table's pages hold their text in one article element, with blocks that are never closed."""
    import re

    from innsight.llm.queries import op9_html_extraction, table

    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, d, "pages").collect()}
    got = op9_html_extraction(spark, d).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", inside)
        text = " ".join(html.unescape(re.sub("<[^>]*>", "", b)) for b in blocks)
        assert r.text == re.sub(r"[ \t\n\f\r]+", " ", text).strip(" ") and r.n_chars == len(r.text)
