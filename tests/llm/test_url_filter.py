import random
import re
from urllib.parse import urljoin

import duckdb
import pytest
from llm_data import in_order, tuples
from pyspark.sql import functions as F

from slotwise.llm import url_filter
from slotwise.llm.oracle import llm_oracles

URLS = [
    (1, "http://a.example.com/x", "<link rel=canonical href='https://b.foo.net/y'>"),
    (2, "http://b.foo.net/y", ""),
    (3, "http://c.org/z", '<meta http-equiv="Refresh" content="0; URL=http://a.example.com/x">'),
    (4, "http://d.org/fr/", '<meta http-equiv="Refresh" content="0; URL=http://a.example.com/x">'),
    (5, "http://e.org/q", "<!-- <link rel=canonical href=http://x.net/> -->"),
    (6, "http://e.org/r", "<link href=/fr/a rel=canonical>"),
    (7, None, None),
    (8, "nohost", "<link rel=canonical href=http://x.net/>"),
    (9, "HTTP://WWW.Example.NET/en/1?x#y", ""),
    (10, "http://example.net/en", None),
    (11, "http://f.org/a/b", "<link rel='canonical' href='c'>"),
    (12, "http://f.org/a/c", "<meta http-equiv=refresh content='3;url=//g.net/'>"),
    (12, "https://f.org/a/c#part", ""),
    (13, "http://h.org", "<LINK REL=\"alternate canonical\" HREF=\"?p=1&amp;q=2\">"),
    (14, "http://h.org?p=1&q=2", "<meta content='0;url=http://i.com/de/x' http-equiv=refresh>"),
    (15, "x://y://z.net/", ""),
    (16, "http://example.com/de/x\ny?z", ""),
    (17, "http://notexample.com/de/", ""),
    (18, "http://j.org/", "<link rel=canonical href=mailto:a@b.net><script><link rel=canonical href=http://x.net></script>"),
    (None, "http://k.com:80/de/", ""),
]


def plain_rule(host, path):
    best = None
    for r in url_filter.RULES:
        name, _, rest = r.where.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best is None or (len(r.where), r.verdict) > (len(best.where), best.verdict):
                best = r
    return best


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.partition("://")[2]
    host = re.split(r"[/?#]", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :])[0]


def test_rules_and_aliases(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string, html string")
    rows = url_filter.filter_urls(pages).collect()
    assert len(rows) == len(URLS)
    aliases = {1, 3, 11, 12}  # of b.foo.net and g.net
    by_url = {(i, *parts(u)): u for i, u, _ in URLS}
    for r in rows:
        assert (r["page_id"], r["host"], r["path"]) in by_url
        rule = plain_rule(r["host"], r["path"])
        assert r["rule"] == (rule.where if rule else None)
        inherited = rule is None and r["page_id"] in aliases
        assert (r["verdict"], r["inherited"]) == (rule.verdict if rule else "block" if inherited else "allow", inherited)


def test_given_redirects_reach_whole_components(spark):
    r = random.Random(4)
    urls = [f"http://s{i}.org/p" for i in range(60)] + ["http://bad.net/", "http://good.org/fr/x"]
    edges = [(r.choice(urls), r.choice(urls)) for _ in range(45)] + [("http://s0.org/p", "http://bad.net/"), ("http://s0.org/p", urls[-1])]
    reached, before = {"http://bad.net/"}, 0
    while len(reached) > before:
        before = len(reached)
        reached |= {x for a, b in edges for x in (a, b) if a in reached or b in reached}
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    found = url_filter.filter_urls(pages, redirects=spark.createDataFrame(edges, "source string, target string"))
    verdicts = {urls[x["page_id"]]: x["verdict"] for x in found.collect()}
    assert verdicts == {u: "block" if u in reached and not u.endswith("/fr/x") else "allow" for u in urls}


def test_empty_table_and_other_columns(spark):
    schema = "page_id bigint, url string, html string, host string, rule string, node string, a string, inherited int"
    assert url_filter.filter_urls(spark.createDataFrame([], schema)).count() == 0
    row = (1, "http://x.org/", "<link rel=canonical href=http://y.net/>", "h", "r", "n", "a", 1)
    assert url_filter.filter_urls(spark.createDataFrame([row, row], schema)).where("verdict = 'block'").count() == 2


# Pages and whether they inherit a block.
LINKED = [
    ("http://a.org/x/y/p", "<link rel=canonical href='../../../b/./q'>", True),
    ("http://a.org/b/q", "<link rel=canonical href='http://a.net:80'>", True),
    ("https://a.org:443/c", "<link rel=canonical href='https://a.org/b/%2E%2e/b/q'>", True),
    ("http://c.org", "<meta http-equiv=refresh content='0;url=//c.org/b'>", False),
    ("http://d.org/one/", "<base href='http://a.net/z/'><link rel=canonical href='q'>", True),
    ("http://d.org/two/", "<base target=_top><base href='/b/'><base href='http://a.net/'><link rel=canonical href='q'>", False),
    ("http://e.org/1", "<link rel=canonical href='http://a&#46;net/1'>", True),
    ("http://e.org/2", "<link rel=canonical href='http&colon;&sol;&#x2F;a&period;net/2'>", True),
    ("http://e.org/3", "<link rel=canonical href='http://e.org/4?a=1&#38;amp;b=&#xFFFFFF;&#0;'>", True),
    ("http://e.org/4?a=1&amp;b=\ufffd\ufffd", "<link rel=canonical href='//a.net/4'>", True),
    ("http://e.org/5", "<link rel=canonical href='http://e.org/&#233;'>", True),
    ("http://e.org/\u00e9", "<link rel=canonical href='//a.net'>", True),
    ("http://f.org/1", "<textarea><link rel=canonical href='http://a.net/'></textarea>", False),
    ("http://f.org/2", "<title><link rel=canonical href='http://a.net/'>", False),
    ("http://f.org/3", "<title>x</title><!-- > --><TextArea >y</TEXTAREA ><link rel=canonical href='http://a.net/'>", True),
    ("http://f.org/4", "<!-- <link rel=canonical href='http://a.net/'>", False),
    ("http://m.com", "<link rel=canonical href='http://m.org/'>", True),
    ("http://n.org/", "<link rel=canonical href='http://m.com/'><link rel=canonical href='http://a.net/'>", True),
    ("http://n.org/port", "<link rel=canonical href='http://a.net:8080/'>", False),  # no rule fits a host with a port
    ("http://o.org:80/", "<link rel=canonical href='http://o.org'>", False),
    ("https://o.org:80/", "<link rel=canonical href='http://a.net/'>", True),
]


def linked_pages(spark):
    rows = [(i, url, html) for i, (url, html, _) in enumerate(LINKED)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_links_as_browsers_read_them(spark):
    found = {r["page_id"]: r for r in url_filter.filter_urls(linked_pages(spark)).collect()}
    for i, (url, _, inherited) in enumerate(LINKED):
        expected = ("block" if inherited else "allow", inherited)
        assert (found[i]["verdict"], found[i]["inherited"]) == expected, url


def test_links_match_the_sql(spark):
    both = linked_pages(spark).unionByName(spark.createDataFrame(URLS, "page_id bigint, url string, html string"))
    columns = "page_id host path rule verdict inherited".split()
    with duckdb.connect() as con:
        con.register("pages", both.toPandas())
        theirs = con.execute(f"SELECT {', '.join(columns)} FROM ({llm_oracles()['op1_url_filter']})").fetchall()
    assert tuples(url_filter.filter_urls(both), *columns) == in_order(theirs)


@pytest.mark.parametrize("target", "q ./q ../q ../../../q . .. ./ ../ a/../b/./c/.. /./x/../y ?z q/..?x=../y #f".split())
def test_dot_segments_as_the_standard_library_joins_them(spark, target):
    base = "http://h.org/a/b/c?d"
    frame = spark.createDataFrame([(target, base)], "target string, base string")
    found = frame.select(url_filter.url_key(url_filter._resolved(F.col("target"), F.col("base")))).first()[0]
    joined = urljoin(base, target).partition("#")[0].removeprefix("http://")
    assert found == (None if target.startswith("#") else joined)
