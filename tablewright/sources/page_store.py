"""Held pages stored by address, so that a few of them are found without moving the others."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.session import scratch

#: Folders a store is cut into by a hash of the address, each of which is read or not.
SLICES = 16


def slice_of(at: Column, slices: int = SLICES) -> Column:
    return F.pmod(F.xxhash64(at), F.lit(slices)).cast("int")


def write_store(pages: DataFrame, at: Column, name: str | None = None, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Pages as a table ``(page_id, url, html, at, slice)``: of each address the page with the smallest id.

    ``at`` is the canonical address. Within a slice pages lie in buckets by address, sorted. The
    table is in the catalog under ``name``, with its files at ``path``.
    """
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = name or f"tw_pages_{uuid.uuid4().hex}"
    keyed = pages.select("page_id", "url", "html", at.alias("at")).where(F.col("at").isNotNull())
    first = keyed.groupBy("at").agg(F.min_by(F.struct("page_id", "url", "html"), "page_id").alias("page"))
    rows = first.select("page.*", "at").withColumn("slice", slice_of(F.col("at")))
    writer = rows.repartition(buckets, "at").write.partitionBy("slice").bucketBy(buckets, "at").sortBy("at")
    writer.option("path", path or scratch(spark, "pages")).saveAsTable(name)
    return spark.table(name)


def is_store(pages: DataFrame) -> bool:
    return {"at", "slice"} <= set(pages.columns)


def stored_pages(store: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pages ``(page_id, url, html)`` of a store whose address is among ``wanted(url)``; ``url`` is that address.

    The slices that hold any wanted address, a handful of numbers, are looked up first and only they
    are read. Addresses are dealt into the buckets that pages already lie in.
    """
    asked = wanted.select(F.col("url").alias("_at")).where(F.col("_at").isNotNull())
    slices = sorted(r[0] for r in asked.select(slice_of(F.col("_at")).alias("slice")).distinct().collect())
    there = store.where(F.col("slice").isin(*slices) if slices else F.lit(False))
    return there.join(asked, F.col("at") == F.col("_at"), "left_semi").select("page_id", F.col("at").alias("url"), "html")
