"""Scans, links and the frontier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, table
from tablewright.checks.render import single
from tablewright.operators import links as L
from tablewright.operators.details import linked_pages
from tablewright.sources.corpus import json_fields, json_path, json_values, scan_pages, script_json, spread
from tablewright.sources.page_store import write_store

FIND = r"""
  SELECT page_id, url, html, regexp_extract_all(html, '(?is)<a(\s[^>]*)>(.*?)</a>') AS l FROM pages"""
UNESC = """replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&')"""
HREF = UNESC.format(x=r"""regexp_extract(a, '(?is)href\s*=\s*"([^"]*)"', 1)""")
TEXT = UNESC.format(x=r"""trim(regexp_replace(regexp_extract(a, '(?is)<a(\s[^>]*)>(.*?)</a>', 2), '<[^>]*>', '', 'g'))""")
LINKS_SQL = f"""
  SELECT page_id, url, pos, {HREF} AS href, {TEXT} AS text
  FROM (SELECT page_id, url, unnest(l) AS a, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos FROM ({FIND}))"""
TARGET = r"regexp_extract(url, '^(\w+://[^/?#]*)', 1) || href"
CANON = r"regexp_extract({x}, '^([^#]*)', 1)"


def pages_of(spark, sf_dir):
    return spread(scan_pages(spark, f"{sf_dir}/pages.parquet"))


@check("scan_pages", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE starts_with(url, 'https://')")
def scan(spark, sf_dir):
    found = scan_pages(spark, f"{sf_dir}/pages.parquet", F.col("url").startswith("https://"))
    return found.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@check("json_extract", """
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k_open FROM events""")
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = json_fields(events, "props", "k bigint", ["event_id", "props"])
    return parsed.select("event_id", F.col("doc.k").alias("k"), json_path(F.col("props"), "$.k", "bigint").alias("k_open"))


@check("script_json", "SELECT c_custkey AS page_id, 'b-' || c_name AS build, c_mktsegment AS segment FROM customer")
def script(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    doc = F.to_json(F.struct(F.concat(F.lit("b-"), "c_name").alias("buildId"), F.struct("c_mktsegment").alias("props")))
    html = F.concat(
        F.lit('<html><script>var t="</p>";track(0);</script><script id="__DATA__" type="application/json">'),
        doc,
        F.lit("</script><p>x</p></html>"),
    )
    pages = single(customers, "c_custkey", html)
    return pages.select(
        "page_id",
        script_json(F.col("html"), "__DATA__", "$.buildId").alias("build"),
        script_json(F.col("html"), "__DATA__", "$.props.c_mktsegment").alias("segment"),
    )


@check("links_extract", f"SELECT page_id, pos, href, text FROM ({LINKS_SQL})")
def links_extract(spark, sf_dir):
    return L.extract(pages_of(spark, sf_dir)).select("page_id", F.col("pos").cast("bigint").alias("pos"), "href", "text")


@check("links_resolve", f"SELECT page_id, pos, {TARGET} AS target FROM ({LINKS_SQL})")
def links_resolve(spark, sf_dir):
    found = L.extract(pages_of(spark, sf_dir))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), L.resolve(F.col("url"), F.col("href")).alias("target"))


@check("links_resolve_forms", """
  WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS s FROM orders)
  SELECT k AS page_id, CASE k % 7
    WHEN 0 THEN 'https://h.example/x/' || s
    WHEN 1 THEN 'https://h.example/a/b/x' || s
    WHEN 2 THEN 'https://h.example/a/x' || s
    WHEN 3 THEN 'https://h.example/a/b/' || s || '?q=' || s
    WHEN 4 THEN 'https://h.example/a/b/' || s || '#f' || s
    WHEN 5 THEN 'http://o.example/' || s
    ELSE 'https://o.example/' || s || '?r=1' END AS target FROM o""")
def links_resolve_forms(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_orderkey").cast("string").alias("s"))
    form = F.col("page_id") % 7
    href = F.concat(
        F.when(form == 0, "/x/").when(form == 1, "./x").when(form == 2, "../x").when(form == 3, "?q=").when(form == 4, "#f")
        .when(form == 5, "http://o.example/").otherwise("//o.example/"),
        "s",
        F.when(form == 6, "?r=1").otherwise(""),
    )
    url = F.concat(F.lit("https://h.example/a/b/"), "s")
    pages = orders.select("page_id", url.alias("url"), F.concat(F.lit("<p><a class='x' href=\""), href, F.lit('">go</a></p>')).alias("html"))
    return L.extract(pages).select("page_id", L.resolve(F.col("url"), F.col("href")).alias("target"))


@check("links_filter", f"""
  SELECT page_id, pos, href FROM ({LINKS_SQL})
  WHERE contains(href, 'th') AND NOT contains(href, 'redlink') AND NOT contains(href, 'ing')""")
def links_filter(spark, sf_dir):
    kept = L.keep_links(L.extract(pages_of(spark, sf_dir)), containing="th", without=("redlink", "ing"))
    return kept.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


@check("slug_name", "SELECT p_partkey, p_name AS name FROM part")
def slug_name(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    url = F.concat(F.lit("https://h.example/wiki/"), F.translate("p_name", " ", "_"), F.lit("_Set_(old)"))
    return parts.select("p_partkey", L.slug_name(url, drop=["Set"]).alias("name"))


@check("slug_name_pages", r"""
  SELECT page_id, rtrim(split_part(regexp_replace(split_part(url, '/', -1), '%|_|-|#|27s', ' ', 'g'), '(', 1)) AS name FROM pages""")
def slug_name_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", L.slug_name(F.col("url")).alias("name"))


@check("slug_overlap", """
  SELECT p_partkey, regexp_matches(p_name, '(^| )(old|gear)( |$)') AS wanted
  FROM part WHERE NOT regexp_matches(p_name, '(^| )(red|ring|bolt)( |$)')""")
def slug_overlap(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("url", F.concat(F.lit("https://h.example/c/"), F.translate("p_name", " ", "-")))
    tokens = L.slug_tokens(F.col("url"))
    kept = parts.where(~L.overlaps(tokens, ["red ring", "bolt"]))
    return kept.select("p_partkey", L.overlaps(tokens, ["old", "gear"]).alias("wanted"))


@check("url_dedupe", f"""
  WITH t AS (SELECT {CANON.format(x=TARGET)} AS url FROM ({LINKS_SQL}))
  SELECT url, CAST(1 AS BIGINT) AS n FROM (SELECT DISTINCT url FROM t WHERE NOT contains(url, 'spam-farm'))
  UNION ALL SELECT url, CAST(count(*) AS BIGINT) AS n FROM t WHERE contains(url, 'spam-farm') GROUP BY url""")
def url_dedupe(spark, sf_dir):
    found = L.extract(pages_of(spark, sf_dir)).withColumn("target", L.resolve(F.col("url"), F.col("href")))
    once = L.distinct_urls(found, keep_repeats=F.col("target").contains("spam-farm"))
    return once.groupBy("url").agg(F.count("*").alias("n"))


FRONTIER_SQL = f"""
  SELECT DISTINCT {CANON.format(x=TARGET)} AS url FROM ({LINKS_SQL})
  EXCEPT SELECT {CANON.format(x="url")} AS url FROM pages"""
HOSTS_SQL = rf"""
  SELECT regexp_extract(url, '^\w+://([^/?#]*)', 1) AS host, CAST(count(*) AS BIGINT) AS urls
  FROM ({FRONTIER_SQL}) GROUP BY 1"""


@check("frontier", HOSTS_SQL)
def frontier(spark, sf_dir):
    return L.per_host(L.frontier(pages_of(spark, sf_dir)))


@check("frontier_urls", FRONTIER_SQL)
def frontier_urls(spark, sf_dir):
    return L.frontier(pages_of(spark, sf_dir))


@check("url_template", r"""
  SELECT page_id, 'https://data.example/b42/' || split_part(url, '/', -2) || '/' || split_part(url, '/', -1) || '.json' AS target FROM pages""")
def url_template(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", L.templated("https://data.example/", "b42", F.col("url")).alias("target"))


def link_graph(spark, sf_dir):
    """Order -> customer -> nation -> region, one rendered page per row; customers are hot targets."""
    steps = [
        ("orders", "order", "o_orderkey", "customer", "o_custkey"),
        ("customer", "customer", "c_custkey", "nation", "c_nationkey"),
        ("nation", "nation", "n_nationkey", "region", "n_regionkey"),
    ]
    frames = []
    for name, kind, key, to, ref in steps:
        frames.append(
            table(spark, sf_dir, name).select(
                F.col(key).cast("bigint").alias("page_id"),
                F.concat(F.lit(f"https://g.example/{kind}/"), F.col(key).cast("string")).alias("url"),
                F.concat(F.lit(f'<p><a href="../{to}/'), F.col(ref).cast("string"), F.lit('">next</a></p>')).alias("html"),
            )
        )
    return frames[0], frames[0].unionByName(frames[1]).unionByName(frames[2])


@check("reach_rounds", """
  WITH RECURSIVE e(src, dst) AS (
    SELECT 'order/' || o_orderkey, 'customer/' || o_custkey FROM orders
    UNION SELECT 'customer/' || c_custkey, 'nation/' || c_nationkey FROM customer
    UNION SELECT 'nation/' || n_nationkey, 'region/' || n_regionkey FROM nation),
  r(url, round) AS (
    SELECT DISTINCT 'order/' || o_orderkey, 0 FROM orders
    UNION SELECT e.dst, r.round + 1 FROM r JOIN e ON e.src = r.url)
  SELECT 'https://g.example/' || url AS url, CAST(min(round) AS BIGINT) AS round FROM r GROUP BY url""")
def reach_rounds(spark, sf_dir):
    seeds, pages = link_graph(spark, sf_dir)
    return L.reach(seeds.select("url"), L.link_edges(pages)).select("url", F.col("round").cast("bigint").alias("round"))


@check("links_base", """
  SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 0 THEN 'http://c.example/e/' || c_custkey || '/f' WHEN 1 THEN 'https://shop.example/k/f' WHEN 2 THEN 'https://shop.example/deep/f'
    ELSE 'https://shop.example/c/f' END AS target FROM customer""")
def links_base(spark, sf_dir):
    """Links are relative to a page's base element, and blanks around an address do not count."""
    form, key = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    base = (
        F.when(form == 0, F.concat(F.lit("<base href='http://c.example/e/"), key, F.lit("/'>")))
        .when(form == 1, "<BASE target=x HREF=\" /k/x \"><base href='/never/'>").when(form == 2, "<base href='../deep/'>").otherwise("<!-- <base href='/gone/'> --><base target='y'>")
    )
    html = F.concat(F.lit("<html><head>"), base, F.lit("</head><a title='' href=' \n\tf\n '>x</a></html>"))
    found = L.extract(single(table(spark, sf_dir, "customer"), "c_custkey", html, folder="c"))
    return found.select("page_id", L.resolve(F.col("base"), F.col("href")).alias("target"))


@check("page_store", """
  SELECT p_partkey AS page_id, 'https://shop.example/item/' || p_partkey AS url, p_name || p_type AS html FROM part WHERE p_partkey % 7 = 0""")
def page_store(spark, sf_dir):
    """Pages held by address; those that some order links to, many times over, are found where they lie."""
    pages = single(table(spark, sf_dir, "part"), "p_partkey", F.concat("p_name", "p_type"))
    again = pages.withColumns({"page_id": F.col("page_id") + 1_000_000, "url": F.concat("url", F.lit("#again"))})
    store = write_store(pages.unionByName(again), L.canonical(F.col("url")))
    rows = table(spark, sf_dir, "lineitem").where("l_partkey % 7 = 0").select("l_partkey").unionByName(table(spark, sf_dir, "part").where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("l_partkey")))
    links = rows.select(F.concat(F.lit("https://shop.example/item/"), F.col("l_partkey").cast("string"), F.lit("#x")).alias("link"))
    return linked_pages(store, links)


@check("json_open", """
  WITH e AS (SELECT event_id, event_type AS t, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events)
  SELECT event_id, unnest(['$.id', '$.p.k', '$.tags[0]', '$.tags[1]', '$.tags[2]', '$.tags[3].deep[0]']) AS path,
         unnest([CAST(event_id AS VARCHAR), k, t, k, NULL, 'true']) AS value, CAST(unnest([0, 1, 2, 3, 4, 5]) AS BIGINT) AS seq FROM e""")
def json_open(spark, sf_dir):
    """Texts of no declared shape, with objects and lists in one another, as one row per value."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    text = F.concat(
        F.lit('{"tags": ["'), "event_type", F.lit('", '), k, F.lit(', null, {"deep": [true]}], "id": '), F.col("event_id").cast("string"), F.lit(', "p": '), "props", F.lit(', "none": {}, "empty": []}')
    )
    events = table(spark, sf_dir, "events").select("event_id", text.alias("doc"))
    broken = events.limit(3).withColumn("doc", F.lit('{"id": '))
    return json_values(events.unionByName(broken), "doc", ["event_id"])


@check("links_markup", """
  SELECT c_custkey AS page_id, '/c/' || c_custkey || '?a=1&b=2' AS href, c_name || ' > ' || c_mktsegment AS title, 'HP ' || c_name || ' é – ' || chr(39) || 'x' || chr(39) AS text FROM customer""")
def links_markup(spark, sf_dir):
    """Nested words that begin like the end of a link, links that are none, quoted brackets, entities."""
    name = F.col("c_name")
    html = F.concat(
        F.lit("<p><!-- <a href='/no'>gone</a> --><script>var a = \"<a href='/no'>gone</a>\";</script><style>a:after { content: '<a href=/no>' }</style>"),
        F.lit("<a class='x' title=\""), name, F.lit(" > "), F.col("c_mktsegment"), F.lit("\" href='/c/"), F.col("c_custkey").cast("string"), F.lit("?a=1&amp;b=2'><abbr>HP</abbr> "),
        name, F.lit(" &eacute; &#8211; &#x27;x&#x27;</a ><article>after</article><!-- never closed <a href='/no'>gone</a>"),
    )
    return L.extract(single(table(spark, sf_dir, "customer"), "c_custkey", html)).select("page_id", "href", "title", "text")


@check("class_links", """
  SELECT c_custkey AS page_id, '/wiki/Class-' || c_custkey AS href FROM customer WHERE c_custkey % 3 <> 0""")
def class_links(spark, sf_dir):
    from tablewright.plans.classes import class_links as kept
    from tablewright.rules import EXCLUDED_CLASS_PHRASES

    word = EXCLUDED_CLASS_PHRASES[0].split(" ")[0]
    slug = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(word + "-"), F.col("c_custkey").cast("string"))).otherwise(F.concat(F.lit("Class-"), F.col("c_custkey").cast("string")))
    html = F.concat(F.lit("<a href='/wiki/"), slug, F.lit("'>x</a>"))
    return kept(L.extract(single(table(spark, sf_dir, "customer"), "c_custkey", html))).select("page_id", "href")
