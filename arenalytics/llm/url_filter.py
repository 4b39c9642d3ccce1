"""URL filter with redirect equivalence (DataFrame functions only).

A url is judged by the longest rule that fits it.  Urls that no rule fits take
the verdict of their aliases: connected components over redirect and canonical
edges, where an explicit allow anywhere in the component outranks every block.
Rules judge every address in the graph, also link targets that no page holds.

Edges come from the pages themselves:

* ``<meta http-equiv="refresh" content="...url=TARGET">`` (a redirect),
* ``<link rel="canonical" href="TARGET">`` (a canonical link),
* the address a url is served under once what never changes the document is
  taken off: scheme, fragment, tracking parameters, one trailing slash, the
  letter case of the host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialize
from .components import connected_components

TRACKING = r"(?:utm_[a-z]+|fbclid|gclid)=[^&#]*"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*?(?<![\w-])href\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*?\burl\s*=\s*["']?\s*([^"'\s>]+)"""
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


@dataclass(frozen=True)
class Rule:
    verdict: str          # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Fixed by the query's contract.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"),
         Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
         Rule("block", "net", "/fr/"))


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one or for null."""
    at = F.locate("://", url)
    return F.when(url.isNotNull() & (at > 0), F.substring(url, at + 3, F.length(url))) \
            .otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def served_as(url: Column) -> Column:
    """The address with everything removed that does not change the document;
    null without ``://``."""
    rest = _after_scheme(url)
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "/$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, "(?:^|&)" + TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    return F.when(F.length(rest) > 0, F.concat(host, path, F.when(F.length(query) > 0,
                  F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule name, rule verdict) of the longest fitting rule, else nulls.  Of
    two rules with one name the allow wins.  The rules are configuration."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        name = F.when(_fits(r, host, path), F.lit(r.name)).otherwise(name)
        verdict = F.when(_fits(r, host, path), F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def decoded(raw: Column) -> Column:
    """``raw`` with its character references (numbers and ENTITIES) read, once."""
    def part(x: Column) -> Column:
        """``x``: what follows an ampersand."""
        return let(F.regexp_extract(x, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[a-z]+);", 1),
                   lambda name: let(number(name), lambda code: read(x, name, code)))

    def number(name: Column) -> Column:
        return F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, F.length(name)), 16, 10)) \
                .when(name.startswith("#"), F.substring(name, 2, F.length(name))).cast("long")

    def read(x: Column, name: Column, code: Column) -> Column:
        char = F.when((code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
                      F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        for entity, meant in ENTITIES.items():
            char = char.when(name == entity, F.lit(meant))
        return F.coalesce(F.concat(char, F.substring(x, F.length(name) + 2, F.length(x))),
                          F.concat(F.lit("&"), x))

    parts = F.split(raw, "&", -1)
    return F.when(raw.contains("&"), let(parts, lambda p: F.array_join(F.transform(
        p, lambda x, i: F.when(i == 0, x).otherwise(part(x))), ""))).otherwise(raw)


def without_dots(path: Column) -> Column:
    """A path from ``/`` with its ``.`` and ``..`` segments carried out."""
    def step(acc: Column, x: Column) -> Column:
        return F.when(x == ".", acc) \
                .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))) \
                .otherwise(F.concat(acc, F.array(x)))

    def carried_out(p: Column) -> Column:
        none = F.array().cast("array<string>")
        kept = F.aggregate(F.split(F.substring(p, 2, F.length(p)), "/", -1), none, step)
        # a last segment of dots names a folder
        folder = F.when(p.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(none)
        return F.when(p.contains("/."), F.concat(F.lit("/"), F.array_join(F.concat(kept, folder), "/"))) \
                .otherwise(p)
    return let(path, carried_out)


def resolved(target: Column, url: Column) -> Column:
    """The address of a link ``target`` on the page at ``url``; null when it
    names no other address or cannot be read."""
    site = F.lit("http://")

    def absolute(t: Column, host: Column, path: Column) -> Column:
        folder = F.when(path.contains("/"), F.regexp_extract(path, "^(.*/)", 1)).otherwise(F.lit("/"))
        return F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t) \
                .when(t.startswith("//"), F.concat(F.lit("http:"), t)) \
                .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | t.startswith("#")
                      | (F.length(host) == 0), F.lit(None)) \
                .when(t.startswith("/"), F.concat(site, host, t)) \
                .when(t.startswith("?"), F.concat(site, host, path, t)) \
                .otherwise(F.concat(site, host, folder, t))

    def tidy(rest: Column) -> Column:
        return F.when(F.length(rest) > 0, F.concat(
            site, F.regexp_extract(rest, r"^([^/?#]*)", 1),
            without_dots(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)),
            F.regexp_extract(rest, r"^[^?#]*(.*)$", 1)))

    full = let(target, lambda t: let(url_host(url), lambda h: let(
        url_path(url), lambda p: absolute(t, h, p))))
    return let(let(full, _after_scheme), tidy)


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) edges: from every page to the targets of its canonical and
    refresh tags, and from pages and targets to the address they are served
    under (written ``://address``).  Relative targets are resolved against the
    page's url; a target that cannot be read gives no edge and hides no other."""
    url = F.col("url")
    linked = F.lower(F.col("html"))
    html = pages.filter(url.isNotNull() & F.col("html").isNotNull()
                        & (linked.contains("canonical") | linked.contains("http-equiv")))
    links = html.select(url, F.explode(F.concat(*[
        F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)])).alias("raw")) \
        .select("url", decoded(F.col("raw")).alias("target")) \
        .select(url.alias("src"), resolved(F.col("target"), url).alias("dst")) \
        .filter("dst is not null").distinct()
    addresses = pages.filter(url.isNotNull()).select("url").union(links.select("dst")) \
        .select(url.alias("src"), F.concat(F.lit("://"), served_as(url)).alias("dst")).filter("dst is not null")
    return addresses.union(links).filter(F.col("src") != F.col("dst"))


def judge_urls(pages: DataFrame, rules=RULES, default: str = "allow",
               edges: DataFrame | None = None) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, component).

    ``edges`` (src, dst) replaces the edges read from the pages.  A page whose
    url is null or has no ``://`` has empty host and path, no rule and the
    default verdict.  Repeated rows and urls are judged alike; an empty table
    gives no rows; other columns of ``pages`` are ignored.
    """
    cols = {c.lower() for c in pages.columns}
    html = F.col("html").cast("string") if "html" in cols else F.lit(None).cast("string")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"),
                     F.col("url").cast("string").alias("url"), html.alias("html"))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    judged = p.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    judged = judged.select("*", name.alias("rule"), verdict.alias("ruled"))

    if edges is None:
        edges = alias_edges(p)
    comp = connected_components(edges).select(F.col("node").alias("url"), "component")
    comp = materialize(comp, "url-components")
    _, by_rule = longest_rule(rules, F.col("host"), F.col("path"))
    passed = (comp.select("component", host.alias("host"), path.alias("path"))
              .select("component", by_rule.alias("ruled")).filter("ruled is not null").groupBy("component")
              .agg(F.max((F.col("ruled") == "allow").cast("int")).alias("has_allow")))
    alias = comp.join(passed, "component").select(
        "url", "component",
        F.when(F.col("has_allow") == 1, "allow").otherwise("block").alias("inherited"))
    return judged.join(alias, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", "inherited", F.lit(default)).alias("verdict"), "component")
