import re
from html.parser import HTMLParser

import duckdb
from pyspark.sql import functions as F

from recordmill.functions import html as H

PAGE = """<!DOCTYPE html><p>hi &lt;b&gt;</p><!-- <a href="/c">c</a> -->
<a class=x href=/u1>U <b>1</b></a><a name=q>no</a><abbr>x</abbr>
<A HREF='/a?x=1&amp;y=2' title="a > b">T&eacute;&#233;&#xE9;&bogus;&amp;lt;&nbsp;&#0;</A>
<script>var a="<a href=/s>s</a>"</script><style>a{}</style><a href="">e</a><a href = "/sp aced" >5 < 6</a>"""


class Links(HTMLParser):
    """Brute force: (href, text) of every anchor with an href."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open, self.quiet = [], None, 0

    def handle_starttag(self, tag, attrs):
        self.quiet += tag in ("script", "style")
        if tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.open = [href, []]

    def handle_endtag(self, tag):
        self.quiet -= tag in ("script", "style")
        if tag == "a" and self.open:
            self.found.append((self.open[0], " ".join(" ".join(self.open[1]).split())))
            self.open = None

    def handle_data(self, data):
        if self.open and not self.quiet:
            self.open[1].append(data)


def brute(html):
    parser = Links()
    parser.feed(html)
    parser.close()
    return parser.found


def test_anchors(apply):
    (got,) = apply(lambda c: H.anchors(H.visible(c)), [PAGE])
    assert [tuple(a) for a in got] == [
        ("/u1", "U 1"), ("/a?x=1&y=2", "Tééé&bogus;&lt; &#0;"), ("", "e"), ("/sp aced", "5 < 6"),
    ]
    (first,) = apply(lambda c: H.first_anchor(H.visible(c)), [PAGE])
    assert tuple(first) == ("/u1", "U 1")
    assert apply(H.first_anchor, ["<p>none</p>"]) == [None]


def test_href_is_an_attribute_of_its_own(apply):
    values = [
        """<a title="x href=/no" href="/y?q='1'&z='2'">t</a>""", "<a data-href='/no' rel=x>t</a>", "<a rel='x'href=/z>t</a>",
        "<a HREF = /w class='href=/no'>t</a>",
    ]
    got = apply(H.anchors, values)
    assert [[a.href for a in links] for links in got] == [["/y?q='1'&z='2'"], [], ["/z"], ["/w"]]


def test_anchors_of_collected_pages_against_a_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: [tuple(a) for a in r.links] for r in
           pages.select("page_id", H.anchors(H.visible(F.col("html"))).alias("links")).collect()}
    raw = duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()
    assert got == {page_id: brute(html) for page_id, html in raw}


def test_visible_survives_unclosed_parts(apply):
    values = ["a<!-- b", "a<script>b", "a<SCRIPT src=x>b</Script >c", "a<scripty>b", None]
    assert apply(H.visible, values) == ["a ", "a ", "a c", "a<scripty>b", ""]


def test_text_of(apply):
    values = ['<p class="a>b">x</p>y', "1 < 2 <b>3</b>", "it<br/>s", "<p class=it's>q</p>", "a&amp;amp;b"]
    assert apply(H.text_of, values) == ["x y", "1 < 2 3", "it s", "q", "a&amp;b"]


def test_decode_entities_on_many_marks(apply):
    assert apply(H.decode_entities, ["&amp;" * 5000 + "&", "&#128512;&#xD800;"]) == ["&" * 5001, "😀&#xD800;"]


def test_articles_are_whole_elements(apply):
    pages = {
        "<article id=1>a</article><article>b<i>c</i></article><articles>no</articles>": ["<article id=1>a", "<article>b<i>c</i>"],
        "<article>a<article>in</article>tail</article>out": ["<article>a<article>in</article>tail", "<article>in"],
        "<div><article>a<p>b</div>out": ["<article>a<p>b"],
        "<ARTICLE>a</p>b<br></Article>c": ["<ARTICLE>a</p>b<br>"],
        "<article>never": ["<article>never"],
        "none": [],
    }
    assert apply(H.articles, list(pages)) == list(pages.values())


def test_elements_around_linked_headings(apply):
    pages = {
        "<div><h2><a href=/1>One</a></h2><p>alpha</p></div><footer>FOOT</footer>": ["<div><h2><a href=/1>One</a></h2><p>alpha</p>"],
        "<p>x</p><div>May <h3><a href=/1>A</a></h3><h3><a href=/2>B</a></h3></div>z": ["<div>May <h3><a href=/1>A</a></h3><h3><a href=/2>B</a></h3>"],
        "<h2><a href=/1>A</a></h2>text<h4>no link</h4>": ["<h2><a href=/1>A</a></h2>text<h4>no link</h4>"],
        "<section><h2>no</h2><a href=/1>behind</a></section>": [],
        "<div><img src='a>b'><input/><h2><a href=/1>A</a></h2></div>x": ["<div><img src='a>b'><input/><h2><a href=/1>A</a></h2>"],
        "<h1><a href=/1>A</a></h1>": [],
    }
    assert apply(H.around_linked_headings, list(pages)) == list(pages.values())


def test_every_element_is_matched_once():
    """Time of a page of unclosed tags grows as the page does."""
    import time

    def seconds(n):
        page = "<div><p><i>" * (n // 3) + "<section><h2><a href=/1>A</a></h2></section>" * 20 + "</b></p></div>" * (n // 3)
        start = time.process_time()
        found = H._matched(page)
        return time.process_time() - start, found

    small = min(seconds(4_000)[0] for _ in range(5))
    large, found = min((seconds(40_000) for _ in range(3)), key=lambda x: x[0])
    assert len(found) == 20 and all(own[3] and own[4] for own in found)
    assert large < 20 * small


def test_pages_of_unclosed_tags(apply):
    page = "<p><span>" * 20_000 + "<h3><a href=/1>A</a></h3><h3>no link</h3>" + "x" * 10
    (around,) = apply(H.around_linked_headings, [page])
    assert around == [page[page.rindex("<span>") :]]
    (inside,) = apply(H.articles, ["<article>" + "<p><h2>" * 20_000])
    assert [len(x) for x in inside] == [len("<article>") + 140_000]


def brute_nodes(page):
    """Elements as a list of open ones, searched from its end at each closing tag."""
    found, opened, at = [], [], 0
    for k, tag in enumerate(re.finditer(r"</?([A-Za-z][A-Za-z0-9]*)[^<]*", page)):
        at += bool(k) or tag.start() > 0
        name = tag[1].lower()
        if name in H._VOID or tag[0].rstrip("x ").endswith("/>"):
            continue
        if tag[0][1] == "/":
            same = [i for i, (n, _) in enumerate(opened) if n == name]
            if same:
                for _, begin in opened[same[-1] :]:
                    for f in found:
                        f[3:] = [at if f[1] == begin else f[3], at if f[2] == begin else f[4]]
                opened = opened[: same[-1]]
            continue
        if name in ("h2", "h3", "h4", "article"):
            around = opened[-1][1] if opened else -1
            found.append([name != "article", at, at if name == "article" else around, None, None])
        opened.append((name, at))
    return [tuple(f) for f in found]


def test_matching_against_a_plain_search():
    import random

    rng = random.Random(3)
    names = ["div", "p", "h2", "H3", "article", "br", "b"]
    for _ in range(300):
        page = rng.choice(["", "x "]) + "".join(
            rng.choice(["<%s>", "</%s>", "<%s>x ", "</%s>", "<%s/>"]) % rng.choice(names) for _ in range(rng.randrange(30))
        )
        assert H._matched(page) == brute_nodes(page), page


def test_main_content(apply):
    pages = {
        '<div><div class="a entry-content b"><div>one</div><p>two</p></div>after</div>': "<div>one</div><p>two</p>",
        "<section class='post-content'>in<div>x</div></section><article>no</article>": "in<div>x</div>",
        '<p class="entry-contents">q</p><article id=1>in<div>x</div></article>out': "in<div>x</div>",
        "<article>a<article>b</article>c</article>d": "a<article>b</article>c",
        "<p>entry-content is only text</p>": "<p>entry-content is only text</p>",
        '<div class="entry-content">never <div>closed': "never <div>closed",
        '<div class=entry-content><p>x</p><div><div>y</div></div></div><div>z</div>': "<p>x</p><div><div>y</div></div>",
    }
    assert apply(H.main_content, list(pages)) == list(pages.values())


def test_long_pages_stay_linear(apply):
    page = "<a href=/x>" * 20000 + "<!--" * 20000
    (found,) = apply(lambda c: F.size(H.anchors(H.visible(c))), [page])
    assert found == 20000
    listing = "<article>" + "<p>x < y </p><br>" * 2000 + "</article>"
    (found,) = apply(lambda c: F.size(H.articles(c)), [listing])
    assert found == 1
    quotes = '<p title="' + "x'" * 50000 + '">end</p>'
    assert apply(H.text_of, [quotes]) == ["end"]
    assert re.sub("x", "", apply(H.text_of, ["<" * 50000])[0]) == "<" * 50000
