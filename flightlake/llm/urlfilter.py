"""URL block and allow rules with redirect equivalence.

A URL is judged by the longest rule that fits it (host and path prefix). URLs
that no rule fits take the decision of their aliases: redirect and canonical
links, and the canonical form of each URL, are edges whose connected components
spread a block to every alias, unless a member is explicitly allowed.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import materialise, without
from flightlake.llm.components import connected_components

#: (verdict, rule) with the rule as host/path (fixed by the contract).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path. Null or without ``://``: both empty."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def canonical_form(url: Column) -> Column:
    """The URL by which its variants are known: no scheme, fragment, tracking
    parameters (utm_*) or closing slash; ASCII lower-case host. Null without
    ``://``."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.startswith("utm_") & (p != "")), "&")
    form = F.concat(F.lit("//"), host, F.regexp_replace(path, "/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept))
                    .otherwise(F.lit("")))
    return F.when(F.locate("://", url) > 0, form)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. A rule
    fits its host and all its subdomains where the path starts as the rule's;
    of two equally long ones an allow rule wins, then the first in order."""
    dotted = F.concat(F.lit("."), host)
    rule = verdict = F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1]))
    for what, text in reversed(ranked):
        rule_host, _, rule_path = text.partition("/")
        fits = dotted.endswith("." + rule_host) & path.startswith("/" + rule_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def without_dots(path: Column) -> Column:
    """A path less its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, s: F.when(s == ".", acc)
                       .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                       .otherwise(F.concat(acc, F.array(s))))
    kept = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, target: Column) -> Column:
    """``target`` as an absolute URL, seen from ``base``. Null for targets of
    other kinds (``mailto:``) and, unless absolute, where ``base`` has no ``://``."""
    scheme = F.regexp_extract(base, r"(?s)^([^/?#]*)://", 1)
    site = F.regexp_extract(base, r"(?s)^([^/?#]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"(?s)^[^/?#]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"(?s)^[^?#]*(\?[^#]*)", 1)
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.concat(F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1), F.lit("/"))
    relative = (F.when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
                .when(target.startswith("/"), F.concat(site, without_dots(own), rest))
                .when(target.startswith("?"), F.concat(site, path, rest))
                .when(target.startswith("#"), F.concat(site, path, query, rest))
                .otherwise(F.concat(site, without_dots(F.concat(folder, own)), rest)))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(~target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") & (site != "") & (target != ""), relative))


def page_links(pages: DataFrame, url: str = "url", html: str = "html", resolve: bool = False) -> DataFrame:
    """(src, dst): all canonical links and refresh redirects that a page's HTML
    names with an absolute URL; with ``resolve`` also those with a relative one,
    seen from the page's URL (or the base that its HTML gives)."""
    def of_tags(tag: str, attribute: str) -> Column:
        tags = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}[^>]*>"), F.lit(0))
        plain = F.transform(tags, lambda t: F.regexp_replace(t, "(?i)&(amp|#38|#x26);", "&"))
        return F.transform(plain, lambda t: F.regexp_extract(t, rf"(?is)\b{attribute}", 1))

    href = r"href\s*=\s*[\"']?\s*([^\"'\s>]+)"
    links = of_tags(r"link\b[^>]*\brel\s*=\s*[\"']?canonical\b", href)
    metas = of_tags(r"meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b", r"url\s*=\s*[\"']?\s*([^\"'\s>;]+)")
    found = pages.select(F.col(url).alias("src"), F.col(html).alias(html), F.concat(links, metas).alias("dst"))
    found = found.filter(F.size("dst") > 0)
    if not resolve:
        return found.select("src", F.explode("dst").alias("dst")).filter("locate('://', dst) > 0")
    given = F.element_at(F.concat(of_tags(r"base\b", href), F.array(F.lit(""))), 1)
    # Stored between the steps: nested expressions would be copied into each other.
    found = materialise(found.select("src", given.alias("given"), "dst"), "tags")
    found = found.select("src", F.coalesce(resolved(F.col("src"), F.col("given")), "src").alias("base"), "dst")
    found = materialise(found.select("src", "base", F.explode("dst").alias("dst")), "targets")
    return materialise(found.select("src", resolved(F.col("base"), F.col("dst")).alias("dst")), "links").filter("dst IS NOT NULL")


def filter_urls(pages: DataFrame, links: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES,
                url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block).

    ``links`` (src, dst) are redirect and canonical-link edges between URLs.
    Explicit allow has precedence: a URL that an allow rule fits stays allowed
    in a blocked component, and a component with an explicitly allowed member
    passes no block on to members without a rule. URLs without a rule and
    without blocked aliases are allowed; so are null URLs and those without
    ``://``. Repeated URLs get the same verdict; columns of the input with the
    names of the results are replaced.
    """
    own = ("host", "path", "rule", "verdict")
    base = without(pages.withColumn("__url", F.col(url)), *own)
    host, path = url_parts(F.col("__url"))
    judged = base.withColumns({"host": host, "path": path})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "__ruled": verdict, "__form": canonical_form(F.col("__url"))})

    # The nodes are canonical forms: all URLs with the same form are one node.
    edges = pages.limit(0).select(F.lit("").alias("src"), F.lit("").alias("dst"))
    if links is not None:
        edges = links.select(canonical_form(F.col("src")).alias("src"), canonical_form(F.col("dst")).alias("dst"))
    groups = connected_components(edges.filter("src <> dst"))
    # What the rules say of each node, the targets of links included.
    known = judged.filter("__form IS NOT NULL").select("__form", "__ruled")
    if links is not None:
        ends = links.select(F.explode(F.array("src", "dst")).alias("u")).filter("u IS NOT NULL")
        h, p = url_parts(F.col("u"))
        ends = ends.select(canonical_form(F.col("u")).alias("__form"), fitting_rule(h, p, rules)[1].alias("__ruled"))
        known = known.union(ends.filter("__form IS NOT NULL"))
    block, allow = (F.max(F.when(F.col("__ruled") == v, 1).otherwise(0)) for v in ("block", "allow"))
    nodes = known.groupBy("__form").agg(block.alias("blocked"), allow.alias("allowed"))
    nodes = nodes.join(groups, F.col("__form") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "__form"))
    decided = (nodes.groupBy("component").agg(F.max("blocked").alias("b"), F.max("allowed").alias("a"))
               .filter("b = 1 AND a = 0").select("component"))
    blocked = nodes.join(decided, "component", "left_semi").select(F.col("__form").alias("__blocked"))
    out = judged.join(blocked, F.col("__form") == F.col("__blocked"), "left")
    return (out.withColumn("verdict", F.coalesce("__ruled", F.when(F.col("__blocked").isNotNull(), F.lit("block"))
                                                 .otherwise(F.lit("allow"))))
            .drop("__url", "__ruled", "__form", "__blocked"))
