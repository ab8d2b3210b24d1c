import random
from html.parser import HTMLParser

import pytest

from crashlake.llm.html_text import extract, html_to_text

CASES = [
    ("", ""),
    ("plain", "plain"),
    ("a  b\n c", "a b c"),
    ("<p>One<p>Two <b>bold</b>x", "One\n\nTwo boldx"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>tail", "- a\n- b\n  3. c\n  4. d\n- e\n\ntail"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td>x<td>22</table>", "Name       N\nlong name  1\nx          22"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td colspan=2>wide cell<tr><td>a<td>b</table>", "wide cell\na  b"),
    ("<table><tr><td><table><tr><td>1<td>2</table><td>3</table>", "1  2  3"),
    ("<pre> a\n  b</pre>c", " a\n  b\n\nc"),
    ("<script>if (a<b) {'</p>'}</script>x<style>p{}</style><!-- <p>no</p> -->y", "xy"),
    ("<head><title>t</title><meta x></head><body>b", "b"),
    ("<head><title>t</title><p>b", "b"),
    ("<div hidden>no</div><div style='DISPLAY : none'>no</div><p aria-hidden=true>yes", "yes"),
    ("<p title='a>b'>x", "x"),
    ("1 < 2 &amp;&lt;b&gt; &nbsp;&copy; a<3", "1 < 2 &<b>  © a<3"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<h1>A</h1>text<h2>B</h2>", "A\n\ntext\n\nB"),
    ("<i>a</b></i></p>b", "a\n\nb"),
    ("<a href=\"x>y", "<a href=\"x>y"[11:]),
    ("<img alt='pic'>x<input type=hidden value=no><input type=submit value=Go>", "pic x Go"),
    ("<textarea><b>raw</b></textarea><select><option>one<option>two</select>", "<b>raw</b>\none\ntwo"),
    ("<blockquote>q</blockquote>z<hr>y", "  q\n\nz\n---\ny"),
    ("a<!-- open", "a"),
    ("<svg width=9><title>no</title><text x=1>120 m</text><text>Elm</text></svg>", "120 m Elm"),
    ("a<svg> no <path d='M0 0'/><defs/><g><text>b<tspan>c</tspan></text></g><defs><text>no</text></defs></svg>d", "a bc d"),
    ("<svg/>a<svg><style/><foreignObject><p>in <b>it</b></p></foreignObject><desc>no</desc></svg>", "a\n\nin it"),
    ("<math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn><annotation>no</annotation></math>", "x=2"),
    ("a<span style='visibility:hidden'>no<b style='Visibility : visible'>yes</b>no</span>c", "a yes c"),
    ("<div style='VISIBILITY:collapse'><q>no</q><img alt=no><hr><input type=submit value=no><p>no</p></div>b", "b"),
    ("<p style='visibility:hidden;visibility:visible'>a</p><p style='content-visibility:hidden'>no <b style=visibility:visible>no</b></p>", "a"),
    ("<div style='visibility:hidden'><ul><li>no<li style='visibility:visible'>b</ul></div>", "- b"),
    ("<desc>a</desc> <text>b</text>", "a b"),
    ("<ol start=-1><li>a<li>b<li value=7>c<li>d<li value=x>e</ol>", "-1. a\n0. b\n7. c\n8. d\n9. e"),
    ("<ol start='²'><li value=''>a</ol><ul><li value=3>b</ul>", "1. a\n\n- b"),
    ("<svg><g><svg><text>a<p>b<table><tr><td>c</table>", "a\n\nb\n\nc"),
    ("x</", "x</"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_rendering(html, text):
    assert html_to_text(html) == text.strip("\n")


WIDE = "w" * 70

TABLES = [
    ("<tr><th>A<th>B<th>C<tr><td rowspan=2>x<td>1<td>2<tr><td>3<td>4<tr><td>y<td>5<td>6", "A  B  C\nx  1  2\n   3  4\ny  5  6"),
    ("<tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h<td>i<td>j<td>k", "a  b     c\nd        e\nf        g\nh  i  j  k"),
    ("<thead><tr><td rowspan=9>a<td>b</thead><tbody><tr><td rowspan=0>c<td>d<tr><td>e<tr><td>f", "a  b\nc  d\n   e\n   f"),
    ("<tr><td rowspan=2>a<td>b<td rowspan=3>c<tr><td>d<tr><td>e<td>f", "a  b  c\n   d\ne  f"),
    (f"<tr><th>A<th>B<th>C<tr><td>x<td>{WIDE}<td>y<tr><td>1<td>2<td>3", f"A  B  C\nx  {WIDE}\n      y\n1  2  3"),
    ("<tr><td colspan=2>wide cell<td>z<tr><td>a<td>b<td>c", "wide cell  z\na  b       c"),
    ("<tr><td colspan='²'>a<td rowspan='²'>b", "a  b"),
    ("<tr><td rowspan=x>a<td rowspan=-1>b<td rowspan=99999999999>c<tr><td>d<td>e<td>f", "a  b  c\nd  e  f"),
]


@pytest.mark.parametrize("rows,text", TABLES)
def test_cells_stand_under_their_heading(rows, text):
    assert html_to_text(f"<table>{rows}</table>") == text


def test_many_cells_that_reach_down():
    got = html_to_text("<table><tr>" + "<td rowspan=0 colspan=1000>x" * 5000 + "<tr><td>y" * 5000)
    assert (got.count("x"), got.count("y")) == (5000, 5000)


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_data(self, data):
        self.out += data.split()


def test_every_visible_word_is_kept_in_order():
    rng = random.Random(9)
    tags = ["p", "div", "b", "ul", "li", "ol", "table", "tr", "td", "th", "h2", "span", "pre", "section", "dd", "blockquote"]
    for _ in range(500):
        html, n = "", 0
        for _ in range(rng.randint(1, 60)):
            kind = rng.random()
            if kind < 0.4:
                html += f"<{rng.choice(tags)}>"
            elif kind < 0.7:
                html += f"</{rng.choice(tags)}>"
            else:
                html, n = html + f" w{n}q ", n + 1
        parser = Words()
        parser.feed(html)
        got = [w for w in html_to_text(html).split() if w.startswith("w")]
        assert sorted(got) == sorted(parser.out), html
        if "<t" not in html:
            assert got == parser.out, html


def test_deep_and_broken_markup_is_linear():
    for html in ("<div>" * 50000 + "x", "<p>" * 50000 + "x", "<b>" * 20000 + "</i>" * 20000 + "x", '<a href="' * 20000 + ">x",
                 '<a b=">"' * 20000 + "x", "<table><tr><td>" * 3000 + "x", "<" * 50000 + "x", "<textarea>" * 20000):
        html_to_text(html)


def test_table_of_pages(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (2, None), (None, "<li>x"), (3, ""), (4, "<p>" + "word " * 200000)]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, html string, text string, url int")
    got = sorted([(r["page_id"], r["text"][:9]) for r in extract(df).collect()], key=str)
    assert got == sorted([(1, "a"), (1, "a"), (2, ""), (None, "- x"), (3, ""), (4, "word word")], key=str)
    assert extract(df.where("false")).count() == 0
