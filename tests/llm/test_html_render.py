"""Rendering: golden layouts, and the visible text against a plain event parser."""

import random
import re
import time
from html.parser import HTMLParser

import pytest

from matchguard.llm.html_render import extract, parse, render

GOLDEN = [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>a</div><div>b</div>", "a\nb"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>end", "- a\n- b\n  3. c\n  4. d\n\nend"),
    ("<table><tr><th>Name<th>N<tr><td>alpha beta<td>1<tr><td colspan=2>wide</table>", "Name       | N\nalpha beta | 1\nwide"),
    ("<table><tr><td>é<td>x<tr><td>中文<td>y</table>", "é    | x\n中文 | y"),
    ("<p>a<script>if (1 < 2) { '</p>' }</script><style>p{}</style>b", "ab"),
    ("<p hidden>x</p><p style='color:red; display: none'>y</p><p style='display:block'>z</p>", "z"),
    ("<pre>a\n  b\n\nc</pre>", "a\n  b\n\nc"),
    ("<head><title>no</title></head><h1>yes</h1>text", "yes\n\ntext"),
    ("<dl><dt>t<dd>d</dl>", "t\n    d"),
    ("<!-- c --><b>a</b> <i>b</i>", "a b"),
    ("</p></div></table>x<td>y", "xy"),
    ("<table>x<tr><td>a</table>", "x\n\na"),
    ("<noscript>n</noscript><textarea>t</textarea>v", "v"),
    ("<a href='x>y'>k</a>", "k"),
    ("cut <b", "cut"),
]


@pytest.mark.parametrize(("html", "text"), GOLDEN)
def test_golden(html, text):
    assert render(html) == text


class Plain(HTMLParser):
    SKIP = {"script", "style", "title"}

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.SKIP

    def handle_endtag(self, tag):
        self.hidden -= tag in self.SKIP

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_random_pages_lose_no_visible_text_and_add_none():
    rnd = random.Random(4)

    def make(depth):
        kind = rnd.choice(["div", "p", "b", "span", "section", "text", "text", "entity", "script"]) if depth else "text"
        if kind == "text":
            return " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randint(1, 6)))
        if kind == "entity":
            return rnd.choice(["&amp;", "&eacute;", "&#233;", "&nbsp;"])
        if kind == "script":
            return "<script>var x = '<p>';</script>"
        return f"<{kind}>" + "".join(make(depth - 1) for _ in range(rnd.randint(1, 4))) + (f"</{kind}>" if kind != "p" or rnd.random() < 0.5 else "")

    for _ in range(200):
        html = "".join(make(4) for _ in range(3))
        plain = Plain()
        plain.feed(html)
        plain.close()
        assert re.sub(r"\s", "", render(html)) == re.sub(r"\s", "", "".join(plain.out)), html


def test_noise_never_fails_and_depth_is_no_limit():
    rnd = random.Random(5)
    parts = ["<table>", "<tr>", "<td>", "</td>", "</tr>", "</table>", "<li>", "<ul>", "</ul>", "<p>", "</p>", "<caption>", "x", " ", "<div hidden>", "</div>", "<", ">", "&", "<pre>", "\n", "</pre>", "<th colspan=999999>", "<script>", "</script>", "<br>", "<dd>", "<body>", "<select><option>", "<!--", "-->"]
    for _ in range(1500):
        render("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))))
    assert render("<div>" * 50_000 + "x") == "x"
    node = parse("<p>a<div>b")
    assert [c.tag for c in node.children] == ["p", "div"]


@pytest.mark.parametrize("page", ["<p><button>" + "<div>" * 20_000, "<table><tr><td>" * 5_000 + "x" + "</b></td>" * 5_000, "<blockquote>" * 20_000, "<ul><li>" * 20_000, "<p><table><td>" + "<p>x" * 20_000, "<select>" + "<option>" * 20_000, "<a><b></a>" * 20_000])
def test_time_grows_with_the_page(page):
    start = time.process_time()
    render(page + "text")
    assert time.process_time() - start < 3


def test_formulas_are_text():
    assert render("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>.") == "so x=1."


def test_operator(spark):
    rows = [(1, "<p>a<p>b", "clash", 1), (None, "<b>x</b>", "c", 1), (3, None, "c", 1), (3, "", "c", 1), (4, "<p>" + "word " * 100_000, "c", 1)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int")
    got = {(r["page_id"], r["n_chars"], r["n_lines"]) for r in extract(df).collect()}
    assert got == {(1, 4, 3), (None, 1, 1), (3, 0, 0), (4, 499_999, 1)}
    assert extract(df.limit(0)).count() == 0
