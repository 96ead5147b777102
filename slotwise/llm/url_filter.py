"""URL filters: host and path rules, and block decisions that follow redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.components import connected_components
from slotwise.llm.staging import staged

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rules are part of the plan.
MAX_RULES = 1000
#: Paths with a segment of one or two dots.
DOTS = r"(?i)/(\.|%2e){1,2}(/|$)"
#: Named character references that matter in an url, but for ``&amp;``, which comes last.
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "period": ".", "sol": "/", "colon": ":", "quest": "?", "equals": "=", "num": "#"}
NUMBERS = "(?i)&#(?!0*38;|x0*26;)(?:x[0-9a-f]{1,6}|[0-9]{1,7});"
AMPERSAND = "&(?:amp|#0*38|#[xX]0*26);"
#: Comments and elements whose contents are no tags, closed or not.
TEXT_ONLY = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(
    rf"<{name}\b.*?(?:</{name}\s*>|\z)" for name in ("script", "style", "textarea", "title", "xmp", "iframe", "template")
)
BASE = r"""(?is)<base\b[^>]*[\s"'/]href\s*=[^>]*>"""


@dataclass(frozen=True)
class Rule:
    """``where`` is a host and a path, as in ``example.net/en/``; it fits the host and its subdomains."""

    verdict: str
    where: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.where.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def without_dots(path: Column) -> Column:
    """A path with its segments ``.`` and ``..`` worked off, as browsers do it."""
    is_one = lambda x: F.lower(x).isin(".", "%2e")
    is_two = lambda x: F.lower(x).isin("..", ".%2e", "%2e.", "%2e%2e")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
    step = lambda kept, x: F.when(is_two(x), up(kept)).when(is_one(x), kept).otherwise(F.concat(kept, F.array(x)))
    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array(F.lit("")), step)
    last = F.element_at(segments, -1)
    closed = F.when(is_one(last) | is_two(last), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(DOTS), F.array_join(closed, "/")).otherwise(path)


def url_key(url: Column) -> Column:
    """Host, path and query: what scheme and fragment do not tell apart. Null without ``://``.

    The default port of the scheme goes, an empty path is ``/``, and dot segments are worked off.
    """
    scheme = F.lower(F.substring_index(url, "://", 1))
    host = F.when(scheme == "http", F.regexp_replace(host_of(url), ":(80)?$", ""))
    host = host.when(scheme == "https", F.regexp_replace(host_of(url), ":(443)?$", "")).otherwise(host_of(url))
    path = F.when(path_of(url) == "", "/").otherwise(without_dots(path_of(url)))
    query = F.regexp_extract(url, r"^(?s:.*?)://[^?#]*(\?[^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host, path, query))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as struct(verdict, where), or null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("struct<verdict:string,where:string>")
    for rule in sorted(rules, key=lambda r: (len(r.where), r.verdict == "allow", r.where)):
        found = F.when(rule.fits(host, path), F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.where).alias("where"))).otherwise(found)
    return found


def decoded(value: Column) -> Column:
    """``value`` with its character references: numbers and ``NAMED``, each closed by a semicolon."""
    number = lambda ref: F.when(
        F.lower(F.substring(ref, 3, 1)) == "x", F.conv(F.regexp_extract(ref, "(?i)x([0-9a-f]+)", 1), 16, 10)
    ).otherwise(F.regexp_extract(ref, "([0-9]+)", 1))
    code = lambda ref: number(ref).cast("long")
    known = lambda ref: code(ref).between(1, 0x10FFFF) & ~code(ref).between(0xD800, 0xDFFF)
    character = lambda ref: F.when(known(ref), F.decode(F.unhex(F.lpad(F.hex(code(ref)), 8, "0")), "UTF-32")).otherwise("\ufffd")
    numbers = F.array_distinct(F.regexp_extract_all(value, F.lit(NUMBERS), F.lit(0)))
    done = F.when(F.contains(value, F.lit("&#")), F.aggregate(numbers, value, lambda text, ref: F.replace(text, ref, character(ref)))).otherwise(value)
    for name, char in NAMED.items():
        done = F.replace(done, F.lit(f"&{name};"), F.lit(char))
    return F.regexp_replace(done, AMPERSAND, "&")


def _attribute(tag: str, name: str) -> Column:
    """An attribute's value, in double, single or no quotes; empty if there is none."""
    value = F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.btrim(value, F.lit("\"' \t\n\r\f"))


def _resolved(target: Column, base: Column) -> Column:
    """``target`` as seen from the url ``base``; null if it is no link to a page."""
    origin = F.regexp_extract(base, r"^(?s:.*?)://[^/?#]*", 0)
    folder = F.concat(origin, F.regexp_extract(base, r"^(?s:.*?)://[^/?#]*((?:[^?#]*/)?)", 1))
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.substring_index(base, "://", 1), F.lit(":"), target))
        .when(target.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#|$)"), F.lit(None))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(F.regexp_extract(base, r"^(?s:.*?)://[^?#]*", 0), target))
        .otherwise(F.concat(folder, target))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): the keys of pages and of the canonical links and redirects (meta refresh) in their html.

    Links are resolved against the page's first ``<base href>``, else its url. What stands
    in comments, scripts and elements of plain text is no link.
    """
    some = pages.where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh"))
    bare = some.select("url", F.regexp_replace("html", TEXT_ONLY, "").alias("bare"))
    found = F.explode(F.regexp_extract_all("bare", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag")
    tags = bare.select("url", F.regexp_extract("bare", BASE, 0).alias("base"), found)
    named = {"rel": "rel", "href": "href", "equiv": "http-equiv", "content": "content"}
    tags = tags.select("url", "tag", _attribute("base", "href").alias("base"), *(_attribute("tag", name).alias(x) for x, name in named.items()))
    canonical = F.col("tag").rlike("(?i)^<link") & F.col("rel").rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = F.col("tag").rlike("(?i)^<meta") & (F.lower("equiv") == "refresh")
    moved = F.btrim(F.regexp_extract("content", r"(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=(.*)$", 1), F.lit("\"' \t\n\r\f"))
    links = tags.where(canonical | refresh).select("url", "base", F.when(canonical, F.col("href")).otherwise(moved).alias("target"))
    links = staged(links)  # else the planner merges all these expressions into one that is too large to compile
    based = F.when(F.col("base") != "", _resolved(decoded(F.col("base")), F.col("url")))
    links = staged(links.select("url", F.coalesce(based, "url").alias("base"), decoded(F.col("target")).alias("target")))
    links = staged(links.select("url", _resolved(F.col("target"), F.col("base")).alias("to")).where("to is not null"))
    linked = links.select(url_key(F.col("url")).alias("a"), url_key(F.col("to")).alias("b")).distinct()
    return linked.where("b is not null and a <> b")


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, inherited) per row of ``pages`` (page_id, url, html).

    The longest rule that fits a url decides, an allowing one among equals.
    Urls that no rule fits are blocked if they are aliases of a blocked one:
    pages, their canonical links and redirects, and the pairs of ``redirects``
    (source, target urls) are edges, and a block by a rule reaches the whole
    connected component. An explicit allow takes precedence over that, for the
    url that it fits; it is not passed on. The rest is allowed. ``inherited`` is
    true for a block that came from an alias. Urls are the same node if they differ in
    scheme, fragment, default port, dot segments or an empty path for ``/`` alone;
    the rules of a node are those of that form.

    A url that is null or has no ``://`` has an empty host and path, no rule and
    no aliases; a null html has no links. Repeated rows and ids are judged each
    on its own; an empty table gives an empty one.
    """
    url = F.col("url")
    edges = page_links(pages)
    if redirects is not None:
        more = redirects.select(url_key(F.col("source")).alias("a"), url_key(F.col("target")).alias("b"))
        edges = edges.unionByName(more.where("a is not null and b is not null"))
    nodes = connected_components(edges)
    key_url = F.concat(F.lit("x://"), F.col("node"))
    judged = nodes.select("node", "component", rule_of(host_of(key_url), path_of(key_url), rules)["verdict"].alias("v"))
    blocked = judged.where("v = 'block'").select("component").distinct()
    aliases = staged(judged.join(blocked, "component").select(F.col("node").alias("_key"), F.lit(True).alias("inherited")))
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), url_key(url).alias("_key"))
    ruled = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    joined = ruled.join(aliases, "_key", "left")
    inherited = F.col("_rule").isNull() & F.coalesce("inherited", F.lit(False))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(inherited, "block"), F.lit("allow"))
    return joined.select(
        "page_id", "host", "path", F.col("_rule.where").alias("rule"), verdict.alias("verdict"), inherited.alias("inherited")
    )
