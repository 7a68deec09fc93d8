import time

import pytest
from hypothesis import given, settings, strategies as st

from tidelog.llm import htmltext
from tidelog.llm.htmltext import visible_text as v

CASES = [
    ("", ""),
    ("plain  text", "plain text"),
    ("<p>one<p>two <b>bold</b>", "one\n\ntwo bold"),
    ("<title>t</title><style>p{}</style><body>a<script>var t=\"</p>\";</script>b<!-- c --></body>", "ab"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li value=7>y<li>z</ol>", "3. x\n7. y\n8. z"),
    ("<table><tr><th>name<th>n<tr><td>long name<td>1<tr><td>b<td>22</table>", "name       n\nlong name  1\nb          22"),
    ("a<div>b</div>c<br>d", "a\nb\nc\nd"),
    ("<div hidden>x</div><p style='color:red; display : none'>y</p><span style=\"visibility:hidden\">z</span>ok", "ok"),
    ("<pre>  a\n    b</pre>after", "  a\n    b\n\nafter"),
    ("1 &lt; 2 &amp;&nbsp;3 &eacute;", "1 < 2 &\xa03 é"),
    ("a < b and <3", "a < b and <3"),
    ("<h1>H</h1><p><b>x<br><p>y</b></p>", "H\n\nx\n\ny"),
    ("<blockquote><p>q<p>r</blockquote>", "> q\n>\n> r"),
    ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\n  v\nl\n  w"),
    ("<p>x<!-- never ends", "x"),
    ("<head><meta charset=utf-8><p>body text", "body text"),
    ("<p class=x>shown</p><style>/* .x{} */ .x, #y {display:none} p.z{visibility:hidden}</style><p class='x w'>a<p id=y>b<p class=z>c<div class=z>d</div>", "d"),
    ("<style>.x{display:none} .x.k{display:block} @media print{p{display:none}} @media screen{b{display:none}} div p{display:none}</style><div><p class='x k'>kept <b>gone</b></p></div>", "kept"),
    ("<style>#a{display:none} .b{display:none !important}</style><p id=a style='display:block'>one<p class=b style='display:block'>two", "one"),
    ("<!-- <style>p{display:none}</style> --><script>'<style>p{display:none}</style>'</script><p>x", "x"),
    ("<div style='visibility:hidden'>a<span style='visibility:visible'>b</span>c</div>", "b"),
    ("<div hidden style='display:block'>shown</div>", "shown"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D</table>", "A  B\n   C\n   D"),
    ("<table><tr><td>日本<td>x<tr><td>abc<td>y<tr><td>e\u0301t<td>z</table>", "日本  x\nabc   y\ne\u0301t    z"),
    ("size <select><option>S<option selected>M<option>L</select> ok", "size M ok"),
    ("<select><option>first<option>second</select>", "first"),
    ("<select multiple><option>a<option>b</select>", "a\nb"),
    ("<svg><title>t</title><desc>d</desc><text>drawn</text></svg>", "drawn"),
    ("<input type=submit value=Go><input type=hidden value=no>", "Go"),
    ("<p>a" + "<b>" * 70 + "b</p>c", "ab\n\nc"),
    ("<body style='display:none'>x", ""),
]


@pytest.mark.parametrize("page,want", [c for c in CASES if c[1] is not None])
def test_cases(page, want):
    assert v(page) == want


def test_deep_nesting_and_long_pages():
    assert v("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert v("<b>" * 20_000 + "x") == "x"
    assert len(v("<p>word</p>" * 20_000).split("\n\n")) == 20_000
    assert v("<" * 20_000) == "<" * 20_000
    began = time.process_time()
    assert v("<b>" * 20_000 + "x" + "</i>" * 20_000) == "x"
    assert v("<b>" * 20_000 + "<p>" * 20_000 + "x") == "x"
    assert v("<table><td>" + "<i>" * 20_000 + "x" + "</b>" * 20_000) == "x"
    assert v("<style>" + ".a{display:none}" * 20_000 + "</style>" + "<p class=b>" * 2_000 + "x") == "x"
    assert time.process_time() - began < 10


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<div>", "</div>", "<b>", "</b>", "w1 ", "w2 ", "<br>", "<h2>", "</h2>", "<td colspan=3>", "</li>", "<ol>"]), max_size=40))
def test_no_text_is_lost(parts):
    page = "".join(parts)
    assert v(page).split().count("w1") == page.count("w1") and v(page).split().count("w2") == page.count("w2")


def test_frame(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (None, None, "t"), (2, "", None)], "page_id long, html string, text string")
    assert [r.text for r in htmltext.extracted(df).collect()] == ["a", None, ""]
    assert htmltext.extracted(df.limit(0)).collect() == []
