"""The rule operator on hand-made markup."""

import time

import pytest

from pagemart.operators import links
from pagemart.operators.html_rules import Rule, _parse_selector, _Tree, extract_rules, rule_values

PAGE = """<!DOCTYPE html><!-- <a href="/no">no</a> --><html><head><title>A &lt; B &amp; C</title>
<script>var t = "<a href='/js'>js</a>"; wb.spa.init({a: 1});</script></head>
<body><nav><ul><li><a href="/a">A&amp;B</a><li><a HREF='/ü' class="x  y">second<li>plain</ul></nav>
<div id="box" class="card wide"><p>one<p><b>two<br>three<span>1</span><span data-k="v w"><b>q</b></span></div>
<div class="card"><span itemprop=price>5</span><i></i>tail</div><table><tr><td>c1<td>c2<tr><td>c3</table>
<p>a < b</p></body></html>"""


def read(selector, source=PAGE, scope=-1):
    return _Tree(source).read(*_parse_selector(selector), scope)


@pytest.mark.parametrize(
    "selector, wanted",
    [
        ("title::text", ["A < B & C"]),
        ("nav li a::attr(href)", ["/a", "/ü"]),
        ("nav a::text", ["A&B", "second"]),
        ("a.y::text", ["second"]),
        ("a.x.y::attr(class)", ["x  y"]),
        ("li:nth-of-type(3)::text", ["plain"]),
        ("li:last-child::text", ["plain"]),
        ("li:first-of-type a::text", ["A&B"]),
        ("#box p::text", ["one"]),
        ("#box > p::text", ["one"]),
        ("body > p::text", ["a < b"]),
        ("#box p b::text", ["two", "three", "q"]),
        ("div.card.wide span:nth-of-type(2)::attr(data-k)", ["v w"]),
        ('[data-k="v w"] b::text', ["q"]),
        ("span[itemprop=price]::text", ["5"]),
        ('span[itemprop="price"]', ["<span itemprop=price>5</span>"]),
        ('script:contains("wb.spa.init")::text', ["var t = \"<a href='/js'>js</a>\"; wb.spa.init({a: 1});"]),
        ("td::text", ["c1", "c2", "c3"]),
        ("tr:nth-of-type(2) td::text", ["c3\n".strip()]),
        (".card::text", ["tail"]),
        (".absent::text", []),
        ("i::text", []),
    ],
)
def test_selectors(selector, wanted):
    assert [v.strip() for v in read(selector) if v.strip()] == wanted


@pytest.mark.parametrize("selector", ["a, b", "a + b", "a ~ b", "a:hover", "a::before", "a[b^=c]", "*::foo", "a:not(.b)"])
def test_other_forms_are_refused(selector):
    with pytest.raises(ValueError):
        _parse_selector(selector)


@pytest.mark.parametrize("source", ["", "<", "<a", "<a href='x", "</p>", "<p <b>x", "<!--", "<script>x", "<a b='" + "x<" * 2000, "<" * 5000])
def test_broken_markup_ends(source):
    _Tree(source).read(*_parse_selector("a::text"), -1)


def test_markup_of_a_node_is_the_source():
    assert read("nav li:first-of-type") == ['<li><a href="/a">A&amp;B</a>']
    assert read("body > p") == ["<p>a < b</p>"]


def test_scopes_rules_and_long_form(spark):
    body = """<h1>H</h1><div class="c"><b>1</b><a href="/1"></a></div><div class="c"><a href="/2">t</a><a href="/3"></a></div>
    <div class="p"><i>k</i><u>v</u></div><div class="p"><i>only</i></div>"""
    pages = spark.createDataFrame([(1, body), (2, "<p>none</p>"), (3, None)], "page_id int, body string")
    rules = [
        Rule("name", "b::text"), Rule("hrefs", "a::attr(href)"), Rule("heading", "h1::text", at="page"),
        Rule("own", "::self(class)"),
    ]
    rows = extract_rules(pages, rules, ".c", keep=("page_id",)).orderBy("scope_no").collect()
    assert [(r.page_id, r.scope_no, r.name, r.hrefs, r.heading, r.own) for r in rows] == [
        (1, 1, ["1"], ["/1"], ["H"], ["c"]), (1, 2, [], ["/2", "/3"], ["H"], ["c"]),
    ]
    long = rule_values(extract_rules(pages, rules, ".c", keep=("page_id",)), rules, ("page_id",))
    assert {(r.scope_no, r.ord, r.value) for r in long.where("rule = 'hrefs'").collect()} == {(1, 1, "/1"), (2, 1, "/2"), (2, 2, "/3")}
    aligned = [Rule("k", "i::text", each=".p"), Rule("v", "u::text", each=".p")]
    whole = extract_rules(pages, aligned, keep=("page_id",)).orderBy("page_id").collect()
    assert [(r.k, r.v) for r in whole] == [(["k", "only"], ["v", None]), ([], []), ([], [])]


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<a " * n, lambda n: "<span>" * n + "<td>x" * n, lambda n: "<b>" * n + "</p>" * n, lambda n: "<a b='" * n + ">", lambda n: "<!--" * n,
        lambda n: "<li>x" * n, lambda n: "<div>" * n + "</span>" * n, lambda n: "<" * n, lambda n: "<dt>" * n, lambda n: "<i>" * n + "<p>" * n,
    ],
)
def test_time_grows_with_the_page(make):
    took = []
    for n in (5_000, 80_000):
        start = time.process_time()
        _Tree(make(n))
        took.append(time.process_time() - start)
    assert took[1] < 60 * max(took[0], 0.02)


def test_links_are_those_the_rules_find(spark):
    bodies = [
        """<a href="/a">A</a> <a href='/b c'>B <b>bold</b></a><a class=x href=/c>C</a><a data-href="/no" href="/d">D</a>""",
        """<A HREF = "/e">E</A><a title='x > y' href='/f'>F</a><a name=z>none</a><a href="">G</a>""",
        """<a\nhref="/h"\n>H\n</a><abbr href="/no">I</abbr><a data-href=/no>J</a>""", "", None, "<a href='/never ends",
    ]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page_id int, body string")
    found = {(r.page_id, r.ord): (r.href, r.text) for r in links.extract_links(pages, ("page_id",)).collect()}
    rules = extract_rules(pages, [Rule("href", "a::attr(href)")], keep=("page_id",)).collect()
    assert {k: v[0] for k, v in found.items()} == {(r.page_id, i): h for r in rules for i, h in enumerate(r.href, 1)}
    assert found[0, 2] == ("/b c", "B bold") and found[0, 4] == ("/d", "D") and found[1, 3] == ("", "G")


def test_links_of_a_page_that_closes_none(spark):
    pages = spark.createDataFrame([(1, "<a href=x>t" * 50_000), (2, "<a " * 100_000)], "page_id int, body string")
    assert links.extract_links(pages, ("page_id",)).groupBy("page_id").count().collect() == [(1, 50_000)]


def test_a_tag_with_very_many_quoted_values(spark):
    many = " ".join(f'data-{i}="a>b"' for i in range(20_000))
    pages = spark.createDataFrame([(1, f"<p><a {many} href='/x' title=\"1 > 0\">text</a>")], "page_id bigint, body string")
    assert [(r.href, r.text) for r in links.extract_links(pages, ("page_id",)).collect()] == [("/x", "text")]
