import random

from pyspark.sql import functions as F

from flightlake.llm import queries, urlfilter
from flightlake.llm.components import connected_components

RULES = urlfilter.RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def rule_of(url):
    host, path = parts(url)
    fits = [(len(r), r, v) for v, r in RULES
            if ("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://a.net/x", "https://Sub.Example.NET/en/1?q#f", "http://example.net/de/", "http://m.example.com/de/9",
        "http://example.com/en/", "ftp://x.org/fr/a", "http://fr.org/", "", None, "no scheme", "http://nets", "http://net/",
        "http://x.net?y=/z", "://example.net/en/", "http://é.org/fr/É", "http://anet/", "http://good.com/1",
        "http://good.com/2", "http://good.com/3", "http://good.com/3", "http://good.com/4#f", "http://good.com/5/"]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        rule, verdict = rule_of(u)
        assert got[i] == (*parts(u), rule, verdict or "allow"), u


def test_aliases_take_blocks_unless_allowed(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    links = spark.createDataFrame([
        ("http://good.com/1", "http://good.com/2"), ("http://good.com/2", "http://bad.net/hidden"),  # a chain to a block
        ("http://good.com/3", "http://x.net?y=/z"), ("http://good.com/3", "http://example.net/en/ok"),  # allowed member
        ("http://good.com/4", "http://good.com/5"), ("http://good.com/5", "http://a.net/x"),  # by canonical form
        ("https://Sub.Example.NET/en/1?q#f", "http://a.net/x"), (None, "http://a.net/x"), ("x", "y")],
        "src string, dst string")
    got = {u: r.verdict for r in urlfilter.filter_urls(pages, links).collect() for u in [URLS[r.page_id]]}
    assert got["http://good.com/1"] == got["http://good.com/2"] == "block"
    assert got["http://good.com/3"] == "allow"
    # /4 and /5 lead to a.net/x, which is blocked itself but linked with an allowed page
    assert got["http://good.com/4#f"] == got["http://good.com/5/"] == "allow"
    assert got["https://Sub.Example.NET/en/1?q#f"] == "allow" and got["http://a.net/x"] == "block"


def test_forms_of_one_url_are_aliases(spark):
    urls = ["http://net/", "https://NET", "http://net/#x", "http://a.com/x/?utm_source=f&b=1", "https://a.com/x?b=1"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.filter_urls(pages).collect()}
    assert got == {0: ("net/", "block"), 1: (None, "block"), 2: ("net/", "block"), 3: (None, "allow"), 4: (None, "allow")}
    forms = pages.select(urlfilter.canonical_form(F.col("url")).alias("f")).collect()
    assert forms[0] == forms[1] == forms[2] and forms[3] == forms[4]


def test_links_of_html(spark):
    rows = [(1, "http://a.com/", '<head><LINK href="http://b.com/" rel="canonical"></head>'),
            (2, "http://c.com/", "<meta http-equiv=refresh content='0; url=http://d.com/x'>"),
            (3, "http://e.com/", '<link rel="canonical" href="/relative">'), (4, None, None), (5, "u", "")]
    links = urlfilter.page_links(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(tuple(r) for r in links) == [("http://a.com/", "http://b.com/"), ("http://c.com/", "http://d.com/x")]


def test_relative_links_spread_blocks(spark, tmp_path):
    canonical = '<link rel="canonical" href="{}">'
    rows = [("http://e.com/a/b?q=1", canonical.format("/de/x"), "http://e.com/de/x"),
            ("http://f.com/1", canonical.format("//bad.net/x"), "http://bad.net/x"),
            ("https://g.com/a/b?q", canonical.format("c.html?y=1"), "https://g.com/a/c.html?y=1"),
            ("http://h.com", canonical.format("c"), "http://h.com/c"),
            ("http://i.com/a/b/c", canonical.format("../.././../x/./y/.."), "http://i.com/x/"),
            ("http://j.com/a?b", canonical.format("?c=1&amp;d=2"), "http://j.com/a?c=1&d=2"),
            ("http://k.com/a?b", canonical.format("#c"), "http://k.com/a?b#c"),
            ("http://l.com/", "<meta http-equiv=refresh content='0; url=http://m.com/x?a=1&amp;b=2'>",
             "http://m.com/x?a=1&b=2"),
            ("http://n.com/p", canonical.format("/go?u=http://x.org/"), "http://n.com/go?u=http://x.org/"),
            ("http://o.com/p/q", '<base href="/r/">' + canonical.format("s"), "http://o.com/r/s"),
            ("http://p.com/", canonical.format("mailto:a@b.net"), None), ("no scheme", canonical.format("/x"), None),
            ("http://q.com/", None, None), (None, canonical.format("/x"), None),
            ("http://r.com/1", canonical.format("http://s.com/") + canonical.format("http://t.net/"), None)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string")
    links = sorted(tuple(r) for r in urlfilter.page_links(pages, resolve=True).collect())
    assert links == sorted([(u, d) for u, _, d in rows if d]
                           + [("http://r.com/1", "http://s.com/"), ("http://r.com/1", "http://t.net/")])
    # Aliases of a blocked URL by a protocol-relative link, an escaped one, and a second tag.
    more = spark.createDataFrame([(100, "http://m.com/x?a=1&b=2", canonical.format("//y.net/"))], pages.schema)
    pages.union(more).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.verdict for r in queries.op5_url_filter(spark, str(tmp_path)).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 7, 14, 100}


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(200)] + [(5, 5), (None, 3), (7, None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.filter_urls(pages).collect() == []
