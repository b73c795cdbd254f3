"""List rows joined to their detail pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.links import canonical
from tablewright.sources.page_store import is_store, stored_pages


def join_details(rows: DataFrame, details: DataFrame, link: str = "link", list_only: Column | None = None) -> DataFrame:
    """Left join of list rows to facts by URL.

    A row without a link, or one for which ``list_only`` holds, is kept with its list data; a
    row whose detail page is missing is dropped. ``details(url, …)`` has one row per address, so
    a hot link on the list side cannot multiply and its partition may be split by skew handling.
    """
    wants = F.col(link).isNotNull()
    if list_only is not None:
        wants = wants & ~F.coalesce(list_only, F.lit(False))
    keyed = rows.withColumn("_at", F.when(wants, canonical(F.col(link))))
    found = details.withColumnRenamed("url", "_url").withColumn("_found", F.lit(True))
    joined = keyed.join(found, keyed["_at"] == found["_url"], "left")
    return joined.where(F.col("_at").isNull() | F.col("_found")).drop("_at", "_url", "_found")


def linked_pages(pages: DataFrame, rows: DataFrame, link: str = "link") -> DataFrame:
    """Only the pages some row links to, one per address, so that no other page is parsed.

    ``pages`` may be a page store (``sources.page_store``): its pages lie by address, so only the
    addresses move, and slices without a wanted one are not read.
    """
    wanted = rows.where(F.col(link).isNotNull()).select(canonical(F.col(link)).alias("url")).distinct()
    if is_store(pages):
        return stored_pages(pages, wanted)
    at = pages.withColumn("url", canonical(F.col("url")))
    once = at.groupBy("url").agg(F.min("page_id").alias("page_id")).join(wanted, "url", "left_semi")
    return at.drop("url").join(once, "page_id").select("page_id", "url", "html")
