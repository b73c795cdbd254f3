"""Figures that must not grow with the input: what is broadcast, what one task holds, what deep pages cost."""

from pyspark.sql import functions as F

from tablewright.operators import details, layout, links
from tablewright.session import stage
from tablewright.sources import markup


def coded(spark, path, n=300_000):
    """Addresses and pages rendered from a file that takes next to nothing."""
    spark.range(0, n, 1, 4).select("id", F.lit("Sword").alias("name")).write.parquet(path)
    rows = spark.read.parquet(path)
    url = F.concat(F.lit("https://shop.example/weapon/"), F.col("id").cast("string"))
    return rows, rows.select(F.col("id").alias("page_id"), url.alias("url"), F.concat(F.lit("<p>"), F.repeat("name", 30), F.lit("</p>")).alias("html"))


def broadcasts(df):
    df.write.format("noop").mode("overwrite").save()
    done = df.groupBy().agg(*[F.max(c) for c in df.columns])
    done.collect()
    return done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("BroadcastExchange")


def test_pages_of_linked_addresses_are_not_broadcast(spark, tmp_path):
    rows, pages = coded(spark, str(tmp_path / "coded"))
    links = pages.select(F.col("url").alias("link"))
    found = details.linked_pages(pages, links)
    assert broadcasts(found) == 0
    assert found.count() == 300_000


def test_facts_of_list_rows_are_not_broadcast(spark, tmp_path):
    rows, pages = coded(spark, str(tmp_path / "coded"))
    facts = pages.select("url", F.col("html").alias("fact"))
    found = details.join_details(rows.select("id", F.concat(F.lit("https://shop.example/weapon/"), F.col("id").cast("string")).alias("link")), facts)
    assert broadcasts(found) == 0
    assert found.where("fact IS NOT NULL").count() == 300_000


def test_a_task_over_pages_holds_few_bytes(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    rows = spark.range(0, 400_000, 1, 8).select((F.col("id") % 50_000).alias("page_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    walked = stage(layout.by_page(rows), "sizes", walk=True).withColumn("task", F.input_file_name())
    # 64 characters a row: a task has 4 MB of them where a shuffle shortens them to half and more.
    assert walked.groupBy("task").count().agg(F.max("count")).first()[0] < 120_000
    # Every row of a page is in one task.
    assert walked.select("page_id", "task").distinct().count() == 50_000
    assert spark.conf.get(name, None) == before


def test_repeated_bare_tags_are_read_as_one():
    depth = 3000
    page = "<div>" * depth + "<table><tr><td>x" + "<i>" * depth + "y" + "</i>" * depth + "</td></table>" + "</div>" * (depth - 1) + "<p>z</div>"
    assert len(markup._MARKUP.split(page)) < 150
    read = lambda wanted: (out := markup.Columns(), markup.read_page(1, page, out, wanted))[0].rows()
    some, every = read(frozenset(("td", "p"))), read(None)
    # Numbers, parents and places are those of a page whose elements are all wanted, and read one by one.
    assert some == [r for r in every if r[5] in ("td", "p")]
    assert [(r[1], r[3], r[4], "".join(r[7])) for r in some] == [(depth + 3, depth + 2, 1, "xy"), (2 * depth + 4, 1, 2, "z")]


def test_an_anchor_is_read_once_for_all_its_filters(spark):
    pages = spark.createDataFrame([(1, "https://shop.example/a", "<a href='/b' title='Ring/x'>t</a><a title=\"y\">u</a><a href=c title=''>v</a>")], "page_id long, url string, html string")
    found = links.extract(pages, text=False).where(F.col("title").contains("/"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line[:60] and "regexp_extract" in line]
    assert [(r.href, r.title) for r in found.collect()] == [("/b", "Ring/x")]
    assert [(r.href, r.title, r.text) for r in links.extract(pages).orderBy("pos").collect()] == [("/b", "Ring/x", "t"), ("c", "", "v")]
