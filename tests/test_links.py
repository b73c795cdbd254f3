"""Links against the standard library's URL rules."""

from urllib.parse import urldefrag, urljoin

import pytest
from pyspark.sql import functions as F

from tablewright.operators import links as L
from tablewright.session import Buckets

BASES = [
    "https://h.example/a/b/c?x=1#top", "https://h.example", "http://h.example/", "https://h.example/a/", "https://h.example/a/b.html", "https://h.example?q=1",
]
HREFS = [
    "x", "x/y", "./x", "../x", "../../x", "../../../x", "/x", "/x/../y", "/x/./y/", "?q=2", "#f", "", "//o.example/p", "http://o.example/p?x#y",
    "x?q=../z", "x/../..", "..", ".", "./", "mailto:a@b.example", "x#../f", "/et.", "a..b",
]


def test_resolve_agrees_with_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    df = spark.createDataFrame(pairs, "url string, href string")
    got = {(r.url, r.href): r.t for r in df.select("url", "href", L.resolve(F.col("url"), F.col("href")).alias("t")).collect()}
    wrong = {}
    for base, href in pairs:
        want = urljoin(base, href)
        # An address of a bare host gets the root path that both forms mean.
        same = {want, want.replace(".example?", ".example/?"), want + "/" if want.count("/") == 2 else want}
        if got[(base, href)] not in same:
            wrong[(base, href)] = (got[(base, href)], want)
    assert not wrong, wrong


def test_canonical_drops_the_fragment(spark):
    df = spark.createDataFrame([(b,) for b in BASES], "url string")
    for r in df.select("url", L.canonical(F.col("url")).alias("c")).collect():
        assert r.c == urldefrag(r.url)[0]


def test_link_predicates(spark):
    html = (
        "<a href='/wiki/A' title='T'>a</a><a class='image' href='/wiki/B'>b</a><a href='/wiki/C'><img src='x'></a>"
        "<a href='/wiki/D?redlink=1'>d</a><a href='/other/E'>e</a><a name='no'>f</a><a href=\"/wiki/G&amp;H\"><b>g</b>&lt;</a>"
    )
    pages = spark.createDataFrame([(1, "https://h.example/p", html)], "page_id long, url string, html string")
    found = L.extract(pages).collect()
    assert [(r.href, r.text) for r in found][-1] == ("/wiki/G&H", "g<")
    assert found[0].title == "T" and len(found) == 6
    kept = L.keep_links(L.extract(pages), containing="wiki/").orderBy("pos").collect()
    assert [r.href for r in kept] == ["/wiki/A", "/wiki/G&H"]


def test_unclosed_anchors(spark):
    html = "<p><a href=/a>one<b>x</b> <A HREF='/b'>two</A> rest <a href=/c>three<p>more <a name=n>no</a> <abbr>z</abbr><a\nhref=\"/d\"><i>four</i></a><a href='/e"
    pages = spark.createDataFrame([(1, "https://h.example/p", html), (2, "https://h.example/q", None), (3, "https://h.example/r", "")], "page_id long, url string, html string")
    assert [(r.href, r.text) for r in L.extract(pages).orderBy("pos").collect()] == [("/a", "one"), ("/b", "two"), ("/c", "three"), ("/d", "four")]


def test_many_unclosed_anchors_cost_one_pass(spark):
    n = 20_000
    pages = spark.createDataFrame([(1, "https://h.example/p", "<a href='/x'>" + "<a href='/y'>t" * n)], "page_id long, url string, html string")
    assert L.extract(pages).count() == n + 1


def test_reach_stops_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string")
    got = L.reach(spark.createDataFrame([("a",)], "url string"), edges)
    assert sorted(map(tuple, got.collect())) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_reach_along_a_long_chain(spark):
    edges = spark.range(20).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    tables = len(spark.catalog.listTables())
    got = L.reach(spark.createDataFrame([("0",)], "url string"), edges)
    assert sorted((int(r.url), r.round) for r in got.collect()) == [(i, i) for i in range(21)]
    assert len(spark.catalog.listTables()) == tables


def test_followed_edges_are_not_shuffled_again(spark):
    from tablewright.session import bucketed

    edges = spark.range(100).select(F.col("id").cast("string").alias("src"), F.lit("x").alias("dst"))
    with bucketed(edges, "src", "probe") as held:
        joined = spark.range(9).select(F.col("id").cast("string").alias("url")).join(held.hint("merge"), F.col("url") == held["src"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and joined.count() == 9


def test_frontier_of_one_hot_target(spark):
    pages = spark.range(300).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("https://h.example/p"), F.col("id").cast("string"), F.lit("#x")).alias("url"),
        F.concat(F.lit("<a href='/hot'>h</a><a href='/p"), ((F.col("id") + 1) % 400).cast("string"), F.lit("'>n</a>")).alias("html"),
    )
    assert sorted(r.url for r in L.frontier(pages).collect()) == ["https://h.example/hot", "https://h.example/p300"]


def test_entities_as_the_parse_pass_reads_them(spark):
    import html
    import random

    rng = random.Random(1)
    parts = ["&", "amp", "lt;", "#", "x", "1", "28", ";", "eacute", "not", "in", " ", "quot;", "#xD800;", "#0;", "#x80;", "#8211;"]
    texts = ["".join(rng.choice(parts) for _ in range(6)) for _ in range(1500)] + ["&notit;", "&#99999999999;", "&copy2", "plain", ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.unescape(F.col("t")).alias("u")).collect()
    assert [(r.t, r.u) for r in got] == [(t, html.unescape(t)) for t in texts]


def test_links_end_where_they_end(spark):
    page = '<a href="/x"><abbr>HP</abbr> ring</a><!-- <a href="/no">c</a> --><a title="a > b" href=/q>t</a  >u<a href="/open">abc <b>d</b><a href="/never">tail<p>x'
    found = L.extract(spark.createDataFrame([(1, "https://h/x", page)], "page_id int, url string, html string")).orderBy("pos").collect()
    assert [(r.href, r.title, r.text) for r in found] == [("/x", None, "HP ring"), ("/q", "a > b", "t"), ("/open", None, "abc"), ("/never", None, "tail")]


LONG = 1 << 20


def test_odd_pages_end_no_task(spark):
    """Long attributes and many stray quotes, in links, scripts and bases, open and closed."""
    from tablewright.sources.corpus import script_json

    quotes = "\"' " * 100_000
    odd = [
        "<script " + "x" * LONG + ">a</script>", "<script " + quotes + ">a</script>", "<style a='" + "y" * LONG + "'>b</style>", "<script " + "x " * LONG, "<!-- " + "-" * LONG,
        "<a " + "x" * LONG + ">t</a>", "<a " + quotes + ">t</a>", "<a title='" + "z" * LONG + "' href='/long'>t</a>", "<base " + quotes + ">", "<a href='" + "p" * LONG + "'>t</a>",
        "<a href=" + "q" * 1000 + " " + quotes, "<script id='d' " + "w " * 100_000 + ">{\"k\": 1}</script>",
    ]
    pages = spark.createDataFrame([(i, "https://h.example/p", x + "<a href='/end'>e</a>") for i, x in enumerate(odd)], "page_id long, url string, html string")
    found = {}
    for r in L.extract(pages).select("page_id", "href").collect():
        found.setdefault(r.page_id, []).append(r.href)
    assert all(found[i][-1] == "/end" for i in (0, 1, 2, 7, 8, 9, 11)) and "/long" in found[7] and len(found[9][0]) == LONG
    assert L.frontier(pages).count() >= 3
    assert [r.v for r in pages.where("page_id = 11").select(script_json(F.col("html"), "d", "$.k").alias("v")).collect()] == ["1"]
    assert pages.select(script_json(F.col("html"), "d", "$.k").alias("v")).where("v IS NOT NULL").count() == 1


def test_base_and_blanks_agree_with_urljoin(spark):
    rows = []
    for base in ("http://c.d/e/", "/e", "f/", " ../g/ ", "?q", "#x", ""):
        for href in (" f ", "\n/f", "../f\t", "?a", "x\ny"):
            rows.append((len(rows), f"<base href='{base}'><a href='{href}'>t</a>", base, href))
    pages = spark.createDataFrame([(i, "https://a.b/x/y", html) for i, html, _, _ in rows], "page_id long, url string, html string")
    got = {r.page_id: r.t for r in L.extract(pages).select("page_id", L.resolve(F.col("base"), F.col("href")).alias("t")).collect()}
    blanks = " \t\n\r\f"
    for i, _, base, href in rows:
        assert got[i] == urljoin(urljoin("https://a.b/x/y", base.strip(blanks)), href.strip(blanks).replace("\n", "").replace("\t", "")), (base, href)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exchanges(df):
    """What each shuffle of a plan carries."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if " Exchange " in line or line.strip().startswith("Exchange")]


def test_a_round_shuffles_new_addresses_only(no_broadcast):
    spark = no_broadcast
    with Buckets(spark, "probe") as buckets:
        edges = buckets.write(spark.range(500).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst")), "src")
        rounds = [buckets.write(spark.range(i * 50, i * 50 + 50).select(F.col("id").cast("string").alias("url"), F.lit(i).alias("round")), "url") for i in range(3)]
        found = L.follow(rounds[-1], edges, rounds)
        # One shuffle: of the addresses reached, between the two halves of distinct.
        assert len(exchanges(found)) == 1 and "dst" in exchanges(found)[0] or "url" in exchanges(found)[0]
        assert [r.url for r in found.collect()] == ["150"]


def test_reach_with_many_rounds_and_hot_targets(no_broadcast):
    spark = no_broadcast
    edges = spark.range(14).select(F.col("id").cast("string").alias("src"), F.explode(F.array((F.col("id") + 1).cast("string"), F.lit("hot"))).alias("dst"))
    edges = edges.unionByName(spark.createDataFrame([("hot", "0"), ("14", "hot")], "src string, dst string"))
    got = {r.url: r.round for r in L.reach(spark.createDataFrame([("0",), ("0",)], "url string"), edges).collect()}
    assert got == {**{str(i): i for i in range(15)}, "hot": 1}
    assert L.reach(spark.createDataFrame([], "url string"), edges).count() == 0


def test_stored_pages_stay_where_they_lie(no_broadcast):
    from tablewright.operators.details import linked_pages
    from tablewright.sources import page_store

    spark = no_broadcast
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h.example/"), F.col("id").cast("string")).alias("url"), F.repeat(F.lit("x"), 50).alias("html"))
    pages = pages.unionByName(pages.where("page_id < 5").withColumn("page_id", F.col("page_id") + 9000)).unionByName(spark.createDataFrame([(1, None, "y")], "page_id long, url string, html string"))
    store = page_store.write_store(pages, L.canonical(F.col("url")))
    rows = spark.createDataFrame([("https://h.example/3#a",), ("https://h.example/3",), ("https://h.example/none",), (None,)], "link string")
    found = linked_pages(store, rows)
    assert [tuple(r) for r in found.collect()] == [(3, "https://h.example/3", "x" * 50)]
    assert not [e for e in exchanges(found) if "html" in e]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" in plan and "PartitionFilters" in plan and plan.count("FileScan") == 1
    read = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "html" in read and "SelectedBucketsCount" in read
    slices = {r[0] for r in rows.where("link IS NOT NULL").select(page_store.slice_of(L.canonical(F.col("link")))).collect()}
    assert len(slices) <= 2 and linked_pages(store, rows.limit(0)).count() == 0
