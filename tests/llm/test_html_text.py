import re
from html.parser import HTMLParser

import pytest

from labelflow.llm.html_text import HIDDEN, extract, page_text

CASES = {
    "": "", "plain  text\n here": "plain text here", "<p>a<p>b": "a\n\nb", "a<br>b<br/>c": "a\nb\nc", "x<div>y</div>z": "x\ny\nz",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=3><li>a<li>b</ol>": "3. a\n4. b",
    "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>": "a     bbb\ncccc  d",
    "<table><tr><th colspan=2>both<tr><td>a<td>b</table>": "both\na  b",
    "<table><td>no row</table>after": "no row\n\nafter",
    "<table><tr><td><p>one<p>two<td>x</table>": "one  x\n\ntwo",
    "<table><tr><td>in <table><tr><td>ner</table><td>z</table>": "in   z\n\nner",
    "<pre>a\n  b\n</pre>c": "a\n  b\n\nc",
    "<style>p{}</style><script>if (a</b) '<p>'</script>v": "v", "<title>t</title><p>v": "v", "<noscript>n</noscript>v": "v",
    "<p hidden>h</p><p style='color:red; display: none'>h</p><p style=\"VISIBILITY:hidden\">h</p>v": "v", "<input type=hidden value=h>v": "v",
    "<!-- <p>c --> v <!doctype x>": "v", "<!-- open": "", "1 < 2 &lt; 3 &amp; &copy; &#233;&nbsp;x": "1 < 2 < 3 & © é\xa0x",
    "<b>bo</b>ld <i> it</i>": "bold it", "<a href='x>y'>l</a>": "l", "<P>UP</P><DIV>x</div>": "UP\n\nx",
    "</p>x</div></table>": "x", "<dl><dt>t<dd>d</dl>": "t\n    d", "<blockquote>q</blockquote>": "    q",
    "<head><title>t<p>still title</title><body>b": "b", "<head><p>body": "body", "<select><option>a<option>b</select>": "a\nb",
    "<h1>h</h1>text<hr>more": "h\n\ntext\n\nmore", "<ul><li><p>a</p><p>b</p></ul>": "- a\n\n  b", "<textarea> a\n b</textarea>": " a\n b", "<p": "<p",
}


@pytest.mark.parametrize("page", CASES)
def test_layout(page):
    assert page_text(page) == CASES[page]


def test_deep_and_long_pages():
    assert page_text("<div>" * 30000 + "x") == "x"
    assert page_text("<b><p>" * 2000 + "x") == "x"
    assert page_text("word " * 200000) == ("word " * 200000).strip()
    assert page_text("<a '" * 3000) is not None and page_text("<" * 20000) == "<" * 20000


class Visible(HTMLParser):
    """All words outside hidden elements, for well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.words, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in HIDDEN and tag not in ("link", "base", "source", "track", "param", "area")

    def handle_endtag(self, tag):
        self.depth -= tag in HIDDEN

    def handle_data(self, data):
        if not self.depth:
            self.words += data.split()


def test_all_visible_words_of_the_pages_and_nothing_else(spark):
    from labelflow.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in QUERIES["op9_html_text"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        page = Visible()
        page.feed(re.sub(r"<title>.*?</title>|<meta[^>]*>", "", r.html, flags=re.S))
        bullets = sum(w == "-" for w in got[r.page_id].text.split()) - sum(w == "-" for w in page.words)
        assert [w for w in got[r.page_id].text.split() if w != "-"] == [w for w in page.words if w != "-"] and bullets == r.html.count("<li")
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_awkward_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    rows = [(1, "u", None, "x", 1), (2, None, "", "x", 1), (3, "u", "<p>a", "x", 1), (3, "u", "<p>a", "x", 1), (None, "u", "b", "x", 1)]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b")], key=str)
    assert extract(spark.createDataFrame([], schema)).count() == 0
