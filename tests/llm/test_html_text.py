import html
import random
import re
import time

import pytest

from slotwise.llm import html_text

CASES = {
    "<p>One<p>Two <b>bold</b>\n text": "One\n\nTwo bold text",
    "a<ul><li>x<li>y<ol start=9><li>p<li>q</ol></ul>b": "a\n\n- x\n- y\n\n  9. p\n  10. q\n\nb",
    "<table><caption>Cap</caption><tr><th>Name<th>Qty<tr><td>Apple pie<td>3<tr><td>Fig<td>12</table>": (
        "Cap\nName       Qty\nApple pie  3\nFig        12"
    ),
    "<table><tr><td rowspan=2>A<td>b<tr><td>c</table>": "A  b\n   c",
    "<table><tr><td>one<br>two<td>x<tr><td>y<td>z</table>": "one  x\ntwo\ny    z",
    "<style>.ad,#n{display:none}</style><div class='q ad'>no</div><i id=n>no</i>yes": "yes",
    "<div style='display: none'>no</div><p hidden>no</p><span style='visibility:hidden'>no</span>ok": "ok",
    "<title>no</title><script>var t='</p>';</script><noscript>no</noscript><template>no</template>ok": "ok",
    "<pre>\na  b\n c</pre>": "a  b\n c",
    "<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>": "S\nT\nyes",
    "x&nbsp;y &lt;z&gt; &copy;": "x y <z> ©",
    "<div>a<div>b</div>c</div><h1>h</h1>d": "a\nb\nc\n\nh\n\nd",
    "<select><option>1<option selected>2</select><input type=submit value=Go><input type=hidden value=no>": "2Go",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "<blockquote>q</blockquote>": "  q",
    "<b><p>a</b></p>b</p>c": "a\n\nbc",
    "": "",
    "  \n ": "",
    "<p": "<p",
    "<!-- c --><!doctype html>": "",
    "a<br>b<br><br>c": "a\nb\nc",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert html_text.page_text(source) == CASES[source]


def test_deep_and_long_pages():
    assert html_text.page_text("<div>" * 50000 + "deep" + "</div>" * 50000) == "deep"
    assert html_text.page_text("<ul><li>" * 3000 + "x").split()[-1] == "x"
    assert len(html_text.page_text("<p>word " * 100000).split()) == 100000
    assert html_text.page_text("<a b='" * 2000) is not None


@pytest.mark.parametrize("depth", [150, 1000, 100000])
@pytest.mark.parametrize("tag", ["div", "span", "font"])
def test_what_is_deep_down_is_as_anywhere_else(tag, depth):
    inner = (
        "<script>var no='<p>'</script><style>.ad{display:none}</style><template>no</template><i style='display:none'>no</i>"
        "<p class=ad>no</p><p>one</p><p>two</p><ul><li>x<li>y</ul><table><tr><td>a<td>b<tr><td>c<td>d</table>"
    )
    shown = "one\n\ntwo\n\n- x\n- y\n\na  b\nc  d"
    assert html_text.page_text(f"<{tag}>" * depth + inner) == shown
    closed = f"<div id=o><b>t</b>{f'<{tag}>' * depth}{inner}{f'</{tag}>' * depth}</div><p class=ad>no</p><p>end</p>"
    assert html_text.page_text(closed).split("\n\n", 1)[1].endswith("c  d\n\nend")


def test_deep_lists_quotes_and_tables():
    for source, words in [
        ("<ul><li>" * 1000 + "<script>no</script>x", 1001),
        ("<blockquote>" * 1000 + "<script>no</script>x", 1),
        ("<table><tr><td>" * 1000 + "<script>no</script>x", 1),
        ("<pre>" + "<b>" * 1000 + "<script>no</script>x", 1),
        ("<select>" + "<optgroup>" * 1000 + "<option>x<option>no", 1),
    ]:
        assert len(html_text.page_text(source).split()) == words
        assert html_text.page_text(source).split()[-1] == "x"


def test_all_visible_words_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_text.extract_text(pages).select("html", "text").collect():
        bare = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", " ", r["html"] or "")
        plain = html.unescape(re.sub(r"<[^>]*>", " ", bare)).split()
        marks = [x for x in r["text"].split() if x != "-"]
        assert sorted("".join(marks)) == sorted("".join(x for x in plain if x != "-"))


def test_awkward_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "<p>a", "y"), (2, "", "z")]
    found = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, html string, text string"))
    assert sorted(r["text"] for r in found.collect()) == ["", "", "", "a"]
    assert html_text.extract_text(spark.createDataFrame([], "page_id bigint, html string")).count() == 0


@pytest.mark.parametrize("tag", ["form", "div", "a", "center", "b"])
def test_rows_inside_other_elements_are_laid_out_once(tag):
    assert html_text.page_text(f"<table><{tag}><tr><td>a</td><td>b</td></tr></{tag}></table>") == "a  b"
    assert html_text.page_text(f"<table>t<{tag}>u<tr><td>a<td>b</{tag}><tr><td>c</table>").split() == ["t", "u", "a", "b", "c"]
    assert html_text.page_text(f"<table><{tag}><tr><td>" * 40 + "x") == "x"


def test_each_word_of_random_tables_is_laid_out_once():
    r = random.Random(11)
    for _ in range(300):
        tags = ["table", "tr", "td", "th", "form", "div", "a", "tbody", "caption", "ul", "li", "p", "blockquote", "b"]
        parts, n = [], 0
        for _ in range(r.randrange(1, 60)):
            kind = r.random()
            if kind < 0.5:
                parts.append(f"<{r.choice(tags)}>")
            elif kind < 0.7:
                parts.append(f"</{r.choice(tags)}>")
            else:
                parts.append(f" w{n} ")
                n += 1
        words = re.findall(r"w[0-9]+", html_text.page_text("".join(parts)))
        assert sorted(words) == sorted(f"w{i}" for i in range(n)), "".join(parts)


@pytest.mark.parametrize(
    "part,times", [("<a ", 300_000), ("<div class='", 80_000), ("<blockquote>x", 75_000), ("<ul><li>x", 100_000), ("<tr><td>x", 100_000)]
)
def test_pages_of_a_megabyte_take_seconds(part, times):
    start = time.monotonic()
    text = html_text.page_text("<table>" * part.startswith("<tr") + part * times)
    assert time.monotonic() - start < 30
    assert len(text) < 300 * times
    if "x" in part:
        assert text.count("x") == times


def test_spans():
    rows = "".join(f"<tr><td>b{i}" for i in range(1, 250))
    lines = html_text.page_text(f"<table><tr><td rowspan=200>A<td>b0{rows}</table>").split("\n")
    assert lines[0] == "A     b0" and lines[150] == "      b150" and lines[199] == "      b199" and lines[200] == "b200"
    assert html_text.page_text("<table><tr><td rowspan=0>A<td>b<tr><td>c<tr><td>d</table>") == "A  b\n   c\n   d"
    wide = html_text.page_text("<table><tr><td colspan=12345678901>A<td>b<tr><td>c</table>")
    assert wide == "A  b\nc"


def test_indents_end_at_a_documented_width():
    lines = html_text.page_text("<blockquote>" * 1000 + "x<br>y").split("\n")
    assert lines[1] == " " * html_text.MAX_INDENT + "y"
    assert html_text.page_text("<ul><li>a<br>b<ul><li>c<br>d") == "- a\n  b\n\n  - c\n    d"


def test_rules_for_other_media_and_later_declarations():
    sheet = "@media print{.x{display:none}} @import 'a'; @media screen{.y{display:none}} @font-face{a:b} .z{display:none;display:block}"
    page = f"<style>{sheet} .v{{visibility:hidden;display:block}}</style><p class=x>x<p class=y>y<p class=z>z<p class=v>v"
    assert html_text.page_text(page) == "x\n\nz"
