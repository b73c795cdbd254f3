"""Pages rendered from the given tables, so that a table is its own expected result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.checks.registry import table
from tablewright.sources.corpus import spread

ROWS_PER_PAGE = 50


def el(tag: str, *parts: Column | str, attrs: str = "") -> Column:
    inner = [F.lit(p) if isinstance(p, str) else p for p in parts]
    opened = f"<{tag} {attrs}>" if attrs else f"<{tag}>"
    return F.concat(F.lit(opened), *inner, F.lit(f"</{tag}>"))


def txt(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def row_html(*cells: Column | str, tag: str = "td") -> Column:
    return el("tr", *[el(tag, txt(c)) for c in cells])


def heads(*names: str) -> Column:
    return el("tr", *[el("th", F.lit(n)) for n in names])


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def chunked(rows: DataFrame, key: str, body: Column, before: str | Column, after: str | Column, size: int = ROWS_PER_PAGE) -> DataFrame:
    """Pages of at most ``size`` rows: a page is a range of a unique key, so no group grows."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = (
        rows.select(F.floor(F.col(key) / size).cast("bigint").alias("page_id"), F.col(key).alias("k"), body.alias("b"))
        .repartition(tasks, "page_id")
        .groupBy("page_id")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "b"))), lambda x: x["b"]), "").alias("body"))
    )
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return pages.select(
        "page_id",
        F.concat(F.lit("https://shop.example/list/"), F.col("page_id").cast("string")).alias("url"),
        F.concat(lit(before), F.col("body"), lit(after)).alias("html"),
    )


def part_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as pages with one table each."""
    rows = table(spark, sf_dir, "part")
    body = row_html("p_partkey", "p_name", "p_brand", "p_type", "p_size", cents("p_retailprice"))
    return chunked(
        rows,
        "p_partkey",
        body,
        F.concat(F.lit("<html><body><h1>Parts</h1><table class='wikitable'>"), heads("Key", "Name", "Brand", "Type", "Size", "Price")),
        "</table></body></html>",
    )


def single(rows: DataFrame, key: str, html: Column, folder: str = "item") -> DataFrame:
    """One page per row."""
    return spread(rows).select(
        F.col(key).cast("bigint").alias("page_id"),
        F.concat(F.lit(f"https://shop.example/{folder}/"), F.col(key).cast("string")).alias("url"),
        html.alias("html"),
    )
