"""From pages to tables: cells, headers, headings, sections, tabs, boxes and prose."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, table
from tablewright.checks.render import cents, chunked, el, heads, part_tables, row_html, single, txt
from tablewright.functions.numbers import level_band
from tablewright.functions.records import section_key
from tablewright.operators import layout as Y
from tablewright.sources.markup import cells, nodes

NAMES = "['Key', 'Name', 'Brand', 'Type', 'Size', 'Price']"
VALUES = """[CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, CAST(p_size AS VARCHAR), CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR)]"""


@check("table_cells", f"""
  WITH p AS (SELECT p_partkey // 50 AS page_id, row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) AS row_idx, {VALUES} AS v FROM part)
  SELECT page_id, row_idx, CAST(unnest(range(6)) AS BIGINT) AS col_idx, false AS is_header, unnest(v) AS text FROM p
  UNION ALL SELECT page_id, 0, CAST(unnest(range(6)) AS BIGINT), true, unnest({NAMES}) FROM (SELECT DISTINCT page_id FROM p)""")
def table_cells(spark, sf_dir):
    found = cells(part_tables(spark, sf_dir))
    return found.select("page_id", F.col("row_idx").cast("bigint").alias("row_idx"), F.col("col_idx").cast("bigint").alias("col_idx"), "is_header", "text")


def noisy_tables(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    again = F.when(F.col("p_partkey") % 10 == 3, heads("Key", "Name", "Type")).otherwise("")
    empty = F.when(F.col("p_partkey") % 10 == 5, "<tr><td>\n</td><td> </td><td></td></tr>").otherwise("")
    other = F.when(F.col("p_partkey") % 10 == 7, row_html("p_partkey", F.concat("p_name", F.lit(" (GMS only)")), "p_type")).otherwise("")
    body = F.concat(again, empty, other, row_html("p_partkey", "p_name", "p_type"))
    return chunked(parts, "p_partkey", body, F.concat(F.lit("<table>"), heads("Key", "Name", "Type")), "</table>")


@check("header_drop", """
  SELECT p_partkey // 50 AS page_id, unnest(['Key', 'Name', 'Type']) AS header, unnest([CAST(p_partkey AS VARCHAR), p_name, p_type]) AS text FROM part""")
def header_drop(spark, sf_dir):
    kept = Y.drop_noise_rows(Y.with_header(Y.by_page(cells(noisy_tables(spark, sf_dir)))), markers=["GMS"])
    return kept.select("page_id", "header", "text")


@check("table_records", """
  SELECT p_partkey // 50 AS page_id, p_partkey AS "key", p_name AS name, p_brand AS brand, p_type AS type, CAST(p_size AS BIGINT) AS size,
         CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part""")
def table_records(spark, sf_dir):
    found = Y.with_header(Y.by_page(cells(part_tables(spark, sf_dir))))
    wide = Y.record_columns(found, {"Key": "key", "Name": "name", "Brand": "brand", "Type": "type", "Size": "size", "Price": "cents"})
    return wide.select(
        "page_id", F.col("key").try_cast("bigint").alias("key"), "name", "brand", "type",
        F.col("size").try_cast("bigint").alias("size"), F.col("cents").try_cast("bigint").alias("cents"),
    )


@check("table_record_maps", f"""
  SELECT p_partkey // 50 AS page_id, unnest({NAMES}) AS header, unnest({VALUES}) AS text FROM part""")
def table_record_maps(spark, sf_dir):
    found = Y.records(Y.with_header(Y.by_page(cells(part_tables(spark, sf_dir)))))
    return found.select("page_id", F.explode("fields").alias("header", "text"))


@check("header_canon", """
  SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN 'Level' WHEN 2 THEN p_type || ' Cost' WHEN 3 THEN 'Overall Effect' WHEN 4 THEN p_brand ELSE 'Cost' END AS name FROM part""")
def header_canon(spark, sf_dir):
    form = F.col("p_partkey") % 6
    shown = (
        F.when(form == 0, F.concat(F.lit("Chance ("), "p_name", F.lit(")")))
        .when(form == 1, F.concat(F.lit("Level ("), "p_name", F.lit(")")))
        .when(form == 2, F.concat("p_type", F.lit(" Cost of "), "p_name"))
        .when(form == 3, "Overall Stat")
        .when(form == 4, F.col("p_brand"))
        .otherwise("Cost")
    )
    return table(spark, sf_dir, "part").select("p_partkey", Y.canonical_header(shown).alias("name"))


@check("heading_context", """
  WITH p AS (SELECT p_partkey AS k, p_partkey // 50 AS page_id, * FROM part)
  SELECT k AS p_partkey, page_id,
    last_value(CASE WHEN k % 20 = 0 THEN p_brand END IGNORE NULLS) OVER w AS h2,
    last_value(CASE WHEN k % 15 = 0 THEN p_type END IGNORE NULLS) OVER w AS h3
  FROM p WINDOW w AS (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def heading_context(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    body = F.concat(
        F.when(k % 20 == 0, el("h2", "<span>", F.col("p_brand"), "</span>")).otherwise(""),
        F.when(k % 15 == 0, el("h3", F.col("p_type"))).otherwise(""),
        el("p", txt("p_partkey"), "<div><h2>inner</h2></div>"),
    )
    pages = chunked(parts, "p_partkey", body, "<div>", "</div>")
    found = Y.with_headings(nodes(pages, ("h2", "h3", "p")), ("h2", "h3")).where(F.col("tag") == "p")
    return found.select(F.col("text").try_cast("bigint").alias("p_partkey"), "page_id", "h2", "h3")


@check("section_filter", """
  SELECT p_partkey, p_partkey // 50 AS page_id, CASE WHEN (p_partkey // 50) % 2 = 0 THEN 'Normal_Equips' ELSE 'Superior_Items' END AS title, 'StarLimit' AS section
  FROM part WHERE p_partkey % 10 BETWEEN 1 AND 4 AND (p_partkey // 10) % 5 <> 2 AND NOT ((p_partkey // 50) % 2 = 1 AND p_partkey % 50 >= 43)""")
def section_filter(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    head = lambda tag, ident: F.concat(F.lit(f"<{tag}><span class='mw-headline' id='"), ident, F.lit(f"'>x</span></{tag}>"))
    odd = F.floor(k / 50) % 2 == 1
    body = (
        F.when(k % 50 == 0, F.concat(
            F.when(odd, head("h3", F.lit("Superior_Items"))).otherwise(head("h3", F.lit("Normal_Equips"))), head("h4", F.lit("Star_Limit_a"))))
        .when(k % 10 == 0, head("h4", F.when(F.floor(k / 10) % 5 == 2, "Meso_Cost").otherwise("Star_Limit_b")))
        .when(k % 50 == 43, F.concat(head("h5", F.lit("Total_Stats_1")), el("h4", "<span class='mw-headline' id='Star_Limit_c'>y</span>"), el("p", txt("p_partkey"))))
        .when(k % 10 == 5, head("h5", F.lit("Other")))
        .otherwise(el("p", txt("p_partkey")))
    )
    pages = chunked(parts, "p_partkey", body, "<div>", "</div>")
    rows = Y.heading_labels(Y.by_page(nodes(pages, ("h3", "h4", "h5", "span", "p"))))
    kept = Y.with_sections(rows, ignored=["Total_Stats", "Meso_Cost"], stop_text="Total_Stats", stop_title="Superior_Items")
    return kept.where(F.col("tag") == "p").select(
        F.col("text").try_cast("bigint").alias("p_partkey"), "page_id", "title", section_key(F.col("section")).alias("section")
    )


@check("block_classify", """
  SELECT p_partkey, CAST(n_value AS BIGINT) AS n_value, CAST(1 AS BIGINT) AS n_chance FROM
    (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS n_value FROM part)""")
def block_classify(spark, sf_dir):
    k = F.col("p_partkey")
    grid, chances = "<table><tr><td>v</td></tr></table>", "<dl><dt>Chance</dt></dl><table><tr><td>c</td></tr></table>"
    shape = (
        F.when(k % 4 == 0, F.lit(grid + chances))
        .when(k % 4 == 1, F.lit("<p>a</p>" + chances))
        .when(k % 4 == 2, F.lit("<p>a</p><p>b</p>" + grid + chances))
        .otherwise(F.lit("<p>a</p><dl></dl><p>b</p>" + grid + grid + chances))
    )
    pages = chunked(table(spark, sf_dir, "part"), "p_partkey", F.concat(el("h5", txt("p_partkey")), shape), "<div><p>intro</p>", "</div>")
    found = Y.classify_blocks(nodes(pages, ("h5", "p", "div", "table", "dl")))
    return found.groupBy(F.col("heading").try_cast("bigint").alias("p_partkey")).agg(
        F.count_if(F.col("kind") == "value").alias("n_value"), F.count_if(F.col("kind") == "chance").alias("n_chance")
    )


def tab_pages(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    hidden = F.col("c_custkey") % 2 == 0
    li = lambda c: el("li", txt(c), attrs="class='wds-tabs__tab'")
    pane = lambda c: el("div", "<table class='wikitable'><tr><td>", txt(c), "</td></tr></table>", attrs="class='wds-tab__content'")
    ghost = F.lit("Unobtainable items")
    html = F.concat(
        F.lit("<div class='tabber wds-tabber'><ul class='wds-tabs'>"),
        li("c_mktsegment"), F.when(hidden, li(ghost)).otherwise(""), li("c_name"),
        F.lit("</ul>"),
        pane("c_acctbal"), F.when(hidden, pane(ghost)).otherwise(""), pane("c_custkey"),
        F.lit("</div><table class='wikitable'><tr><td>outside</td></tr></table>"),
    )
    return single(customers, "c_custkey", html)


@check("tab_align", """
  SELECT c_custkey AS page_id, CAST(0 AS BIGINT) AS tab, c_mktsegment AS title, CAST(round(c_acctbal * 100) AS BIGINT) AS cell FROM customer
  UNION ALL SELECT c_custkey, CAST(1 AS BIGINT), c_name, c_custkey * 100 FROM customer""")
def tab_align(spark, sf_dir):
    rows = Y.by_page(nodes(tab_pages(spark, sf_dir), ("div", "li", "table", "td")))
    rows = rows.withColumn("in_tabs", Y.inside((F.col("tag") == "div") & Y.has_class("wds-tabber")))
    rows = rows.where(F.col("in_tabs"))
    titles = Y.numbered(rows.where((F.col("tag") == "li") & Y.has_class("wds-tabs__tab"))).select("page_id", "pos", F.col("text").alias("title"))
    panes = Y.numbered(rows.where(F.col("tag") == "td")).select("page_id", "pos", F.col("text").alias("cell"))
    paired = Y.align_tabs(titles, panes)
    return paired.select("page_id", F.col("tab").cast("bigint").alias("tab"), "title", F.round(F.col("cell").try_cast("double") * 100).cast("bigint").alias("cell"))


@check("infobox_kv", """
  SELECT p_partkey AS page_id, unnest(['REQ Job', 'Name', 'Brand']) AS key, unnest([p_type, p_name || ' ' || p_type, p_brand]) AS value FROM part""")
def infobox_kv(spark, sf_dir):
    fact = lambda key, *value: F.concat(F.lit(f"<tr><th>{key}\n</th><td>"), *value, F.lit("</td></tr>"))
    html = F.concat(
        F.lit("<div class='mw-parser-output'><table class='x collapsible'><tr><th>No</th></tr><tr></tr><tr><th>Bad</th><td>1</td></tr></table>"),
        F.lit("<table><tr><th>"), F.col("p_name"), F.lit("</th></tr><tr><td><img src='x'></td></tr>"),
        fact("REQ Job", F.col("p_type")), fact("Name", F.col("p_name"), F.lit("<br>"), F.col("p_type")), fact("<b>Brand</b>", F.col("p_brand")),
        F.lit("<tr><td>no key</td></tr></table><table><tr><td>Recipe for</td></tr><tr></tr><tr><th>Skip</th><td>1</td></tr></table>"),
        F.lit("<table><tr><th>a</th></tr><tr></tr><tr><th>Late</th><td>1</td></tr></table></div>"),
    )
    pages = single(table(spark, sf_dir, "part"), "p_partkey", html)
    return Y.infobox(Y.by_page(nodes(pages, ("table", "th", "td")))).select("page_id", "key", "value")


@check("nested_overlay", """
  WITH p AS (SELECT p_partkey, CAST(p_size AS BIGINT) AS s FROM part)
  SELECT p_partkey AS page_id, s AS lo, s + 9 AS hi, unnest(['DEF', 'MP', 'HP']) AS key, unnest([s, s + 1, s + 5]) AS value FROM p
  UNION ALL SELECT p_partkey, s + 10, CAST(300 AS BIGINT), unnest(['DEF', 'MP']), unnest([s + 7, s + 1]) FROM p""")
def nested_overlay(spark, sf_dir):
    n = lambda i: (F.col("p_size") + i).cast("string")
    inner = F.concat(
        F.lit("<table><tr><td>"), n(0), F.lit("~"), n(9), F.lit("</td><td><ul><li>HP +"), n(5), F.lit("</li></ul></td></tr><tr><td>"),
        n(10), F.lit("+</td><td><ul><li>DEF +"), n(7), F.lit("</li></ul></td></tr></table>"),
    )
    html = F.concat(
        F.lit("<table><tr><th>Attempt</th><th>Stats</th></tr><tr><td>1★ → 2★</td><td>"), inner,
        F.lit("<ul><li>DEF +"), n(0), F.lit("</li><li>MP +"), n(1), F.lit("</li></ul></td></tr></table>"),
    )
    rows = Y.by_page(nodes(single(table(spark, sf_dir, "part"), "p_partkey", html), ("table", "th", "td", "ul")))
    outer, nested = Y.nested_stats(rows)
    merged = Y.overlay_inner(outer, nested)
    band = level_band(F.col("band"))
    return merged.select(
        "page_id", band["MinLvl"].cast("bigint").alias("lo"), band["MaxLvl"].cast("bigint").alias("hi"), F.explode("fields").alias("key", "value")
    ).withColumn("value", F.col("value").cast("bigint"))


@check("prose_names", """
  SELECT p_partkey AS page_id, CAST(unnest([0, 1]) AS BIGINT) AS idx, unnest([p_name, p_brand]) AS name FROM part""")
def prose_names(spark, sf_dir):
    a = lambda c: el("a", txt(c), attrs="href='/x'")
    html = F.concat(
        F.lit("<p>\n</p><p>Made for "), a("p_type"), F.lit(" and others.</p><p>It is exclusive to "), a("p_name"), F.lit(", Plain, <b>"),
        a("p_brand"), F.lit("</b>, "), a(F.concat("p_brand", F.lit(" Shade"))), F.lit(", "), a("p_name"), F.lit(" in conjunction with "), a("p_type"),
        F.lit(", exclusive "), a("p_size"), F.lit("</p><p>"), a("p_partkey"), F.lit("</p>"),
    )
    rows = Y.by_page(nodes(single(table(spark, sf_dir, "part"), "p_partkey", html), ("p", "a")))
    return Y.prose_names(rows, skip=["Shade"]).select("page_id", F.col("idx").cast("bigint").alias("idx"), "name")


@check("fallback_region", """
  SELECT c_custkey AS page_id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS cell FROM customer""")
def fallback_region(spark, sf_dir):
    box = lambda c: F.concat(F.lit("<table class='wikitable'><tr><td>"), txt(c), F.lit("</td></tr></table>"))
    tabbed = F.when(F.col("c_custkey") % 3 == 0, el("div", box("c_name"), attrs="class='tabber'")).otherwise("")
    plain = F.when(F.col("c_custkey") % 3 == 0, box(F.lit("not this"))).otherwise(box("c_mktsegment"))
    pages = single(table(spark, sf_dir, "customer"), "c_custkey", F.concat(F.lit("<div class='out'>"), tabbed, plain, F.lit("</div>")))
    rows = Y.by_page(nodes(pages, ("div", "td")))
    rows = rows.withColumn("tabbed", Y.inside((F.col("tag") == "div") & Y.has_class("tabber"))).where(F.col("tag") == "td")
    found = Y.fallback(rows.where("tabbed"), rows.where(~F.coalesce("tabbed", F.lit(False))))
    return found.select("page_id", F.col("text").alias("cell"))


@check("header_group", """
  SELECT p_partkey AS "Level", CAST(p_size AS BIGINT) AS "Points Awarded", CAST(round(p_retailprice * 100) AS BIGINT) AS "Total" FROM part""")
def header_group(spark, sf_dir):
    head = heads("Total", "Level (1-300)", "Points Awarded")
    shown = F.format_number(cents("p_retailprice"), 0)
    split_here = F.when(F.col("p_partkey") % 10 == 4, F.concat(F.lit("</table><table>"), head)).otherwise("")
    repeat = F.when(F.col("p_partkey") % 10 == 8, head).otherwise("")
    body = F.concat(split_here, repeat, row_html(shown, "p_partkey", "p_size"))
    pages = chunked(table(spark, sf_dir, "part"), "p_partkey", body, F.concat(F.lit("<div><table>"), head), "</table></div>")
    grouped = Y.with_header(Y.by_page(cells(pages))).withColumn("header", Y.canonical_header(F.col("header")))
    wide = Y.record_columns(grouped, {c: c for c in ("Level", "Points Awarded", "Total")})
    number = lambda c: F.replace(F.col(c), F.lit(","), F.lit("")).try_cast("bigint").alias(c)
    return wide.select(number("Level"), number("Points Awarded"), number("Total"))


@check("deep_tables", """
  SELECT p_partkey AS page_id, CAST(0 AS BIGINT) AS row_idx, CAST(unnest([0, 1]) AS BIGINT) AS col_idx, unnest([p_name || p_type, p_brand]) AS text FROM part""")
def deep_tables(spark, sf_dir):
    """Cells inside many open elements; how many grows with the part's size, up to some thousand."""
    depth = F.col("p_size") * 60
    html = F.concat(
        F.repeat(F.lit("<div>"), depth), F.lit("<table><tr><td>"), F.col("p_name"), F.repeat(F.lit("<i>"), depth), F.lit("<b>"), F.col("p_type"), F.lit("</b>"),
        F.repeat(F.lit("</i>"), depth), F.lit("</td><td>"), F.col("p_brand"), F.lit("</table>"),
    )
    found = cells(single(table(spark, sf_dir, "part"), "p_partkey", html))
    return found.select("page_id", F.col("row_idx").cast("bigint").alias("row_idx"), F.col("col_idx").cast("bigint").alias("col_idx"), "text")


@check("span_tables", """
  WITH s AS (SELECT p_partkey AS k, p_brand AS brand, p_size % 5 AS further FROM part WHERE p_partkey % 5 = 0)
  SELECT p_partkey, CASE WHEN p_partkey % 5 <= s.further THEN s.brand ELSE p_brand END AS brand, p_name AS name, p_type AS type,
         CASE WHEN p_size % 3 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS size
  FROM part JOIN s ON s.k = p_partkey - p_partkey % 5""")
def span_tables(spark, sf_dir):
    """Cells over rows, as many as a part's size says, cells over columns, two header rows, spans beyond any table."""
    parts, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    firsts = parts.where(k % 5 == 0).select(k.alias("first"), (F.col("p_size") % 5).alias("further"))
    rows = parts.join(firsts, k - k % 5 == F.col("first"))
    over = F.when((k % 50 == 45) & (F.col("further") == 4), F.lit("99999999999")).otherwise((F.col("further") + 1).cast("string"))
    brand = F.when(k % 5 == 0, F.concat(F.lit("<td rowspan="), over, F.lit(">"), "p_brand", F.lit("</td>"))).when(k % 5 <= F.col("further"), "").otherwise(el("td", F.col("p_brand")))
    wide = F.concat(F.lit("<td ColSpan='"), F.when(F.col("p_size") % 9 == 0, "99999999999").otherwise("2"), F.lit("'>"), "p_type", F.lit("</td>"))
    facts = F.when(F.col("p_size") % 3 == 0, wide).otherwise(F.concat(el("td", F.col("p_type")), el("td", txt("p_size"))))
    head = "<table><thead><tr><th rowspan=2>Key</th><th rowspan=0>Brand</th><th colspan=3>Facts</th></tr>"
    pages = chunked(rows, "p_partkey", el("tr", el("td", txt("p_partkey")), brand, el("td", F.col("p_name")), facts), F.concat(F.lit(head), heads("Name", "Type", "Size"), F.lit("</thead>")), "</table>")
    wide = Y.record_columns(Y.with_header(Y.by_page(cells(pages))), {"Key": "p_partkey", "Brand": "brand", "Name": "name", "Type": "type", "Size": "size"})
    return wide.select(F.col("p_partkey").try_cast("bigint").alias("p_partkey"), "brand", "name", "type", "size")


@check("nested_depth", """
  SELECT p_partkey AS page_id, 'L' || i AS label, i AS a, CASE WHEN i >= 3 THEN i - i % 3 END AS b
  FROM (SELECT p_partkey, unnest(range(1, p_size % 11 + 2)) AS i FROM part)""")
def nested_depth(spark, sf_dir):
    """Tables in one another, as deep as a part's size says: a row has the fields of all rows around it, its own first."""
    level = lambda acc, i: F.concat(
        F.lit("<table><tr><td>L"), i.cast("string"), F.lit("</td><td>A +"), i.cast("string"), F.lit("<br>B"), (i % 3).cast("string"), F.lit(" +"), i.cast("string"), acc, F.lit("</td></tr></table>")
    )
    html = F.aggregate(F.sequence(F.col("p_size") % 11 + 1, F.lit(1)), F.lit(""), level)
    found = Y.inherit_fields(Y.nested_rows(Y.by_page(nodes(single(table(spark, sf_dir, "part"), "p_partkey", html), ("table", "td")))))
    return found.select("page_id", "label", F.col("fields")["A"].cast("bigint").alias("a"), F.col("fields")["B0"].cast("bigint").alias("b"))


@check("record_repeat_headers", """
  SELECT p_partkey AS page_id, CAST(p_size + 1 AS VARCHAR) AS size, p_brand AS more_key, p_type AS more_value FROM part""")
def record_repeat_headers(spark, sf_dir):
    """Of two columns of one name the last counts, as a number or not; a column nobody asked for is kept aside."""
    html = F.concat(F.lit("<table>"), el("tr", el("th", "Size"), el("th", "Size"), el("th", F.col("p_brand"))), row_html(F.lit("99"), F.col("p_size") + 1, "p_type"), F.lit("</table>"))
    found = Y.with_header(Y.by_page(cells(single(table(spark, sf_dir, "part"), "p_partkey", html))))
    wide = Y.record_columns(found, {"Size": "size"}, other="more")
    return wide.select("page_id", "size", F.explode("more").alias("more_key", "more_value"))
