"""Writes, upserts, inferred types, rejects and streams. Each reads back what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.link_checks import CANON, HOSTS_SQL
from tablewright.checks.registry import check, table
from tablewright.operators import links as L, sinks as K
from tablewright.operators.reshape import union_by_name
from tablewright.session import scratch
from tablewright.sources.corpus import read_csv, read_snapshot, table_shape
from tablewright.specs import TableSpec
from tablewright.streaming import pages as stream

PART = "p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size"


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("bigint").alias("p_size"))


@check("csv_roundtrip", f"SELECT {PART} FROM part")
def csv_roundtrip(spark, sf_dir):
    rows, path = parts(spark, sf_dir), scratch(spark, "csv")
    K.write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@check("json_roundtrip", f"SELECT {PART} FROM part")
def json_roundtrip(spark, sf_dir):
    rows, path = parts(spark, sf_dir), scratch(spark, "json")
    K.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@check("routed_write", "SELECT p_type AS destination, p_partkey, p_name FROM part")
def routed_write(spark, sf_dir):
    path = scratch(spark, "routed")
    K.write_routed(table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_type").alias("destination")), path, by="destination")
    return spark.read.schema("p_partkey bigint, p_name string, destination string").parquet(path)


ORDERS = TableSpec("orders", ("o_custkey", "o_orderstatus"))


@check("store_widens_types", """
  WITH a AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS whole, CAST(o_custkey AS DOUBLE) AS part FROM orders WHERE o_orderkey % 2 = 0),
  b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS whole, o_custkey + 0.5 AS part FROM orders WHERE o_orderkey % 2 = 1)
  SELECT k, whole, part, CASE WHEN k % 2 = 1 THEN CAST(k AS VARCHAR) ELSE '9007199254740993' END AS large FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""")
def store_widens_types(spark, sf_dir):
    """A later batch brings text into a whole-number column, fractions into another, and fractions where numbers are too large for them."""
    orders = table(spark, sf_dir, "orders")
    root, spec = scratch(spark, "widens"), TableSpec("orders", ("k",))
    cust = F.col("o_custkey")
    first = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), cust.alias("whole"), cust.alias("part"), F.lit(2**53 + 1).alias("large"))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(cust.cast("string"))
    second = orders.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("k"), text.alias("whole"), (cust + F.lit(0.5)).alias("part"), F.col("o_orderkey").cast("double").alias("large"))
    K.save(first, spec, root)
    held = K.save(second, spec, root)
    return held.select("k", "whole", "part", "large")


@check("upsert_touched", """
  SELECT o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'changed' ELSE o_orderpriority END AS priority FROM orders""")
def upsert_touched(spark, sf_dir):
    """One row of a stored table changes: the other buckets stay in the version they were written in."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    root, spec = scratch(spark, "touched"), TableSpec("orders", ("o_orderkey",))
    K.save(rows, spec, root)
    last = rows.agg(F.max("o_orderkey").alias("o_orderkey")).withColumn("priority", F.lit("changed"))
    return K.save(last, spec, root)


def halves(spark, sf_dir):
    """Orders split into held and incoming rows; each half has several rows of a key."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority")
    held = rows.where(F.col("o_orderkey") % 2 == 0)
    new = rows.where(F.col("o_orderkey") % 2 == 1).withColumn("source", F.concat(F.lit("new-"), "o_orderstatus"))
    return held, new


@check("upsert_keyed", """
  SELECT o_custkey, o_orderstatus, o_orderkey, o_orderpriority, source FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey % 2 DESC, o_orderkey DESC) AS rn,
      CASE WHEN o_orderkey % 2 = 1 THEN 'new-' || o_orderstatus END AS source FROM orders) WHERE rn = 1""")
def upsert_keyed(spark, sf_dir):
    held, new = halves(spark, sf_dir)
    return K.upsert(held, new, ORDERS.keys, seq="o_orderkey")


@check("upsert_modes", """
  WITH a AS (SELECT o_custkey, o_orderstatus, max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS even, max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 1) AS odd FROM orders GROUP BY 1, 2)
  SELECT 'write' AS mode, o_custkey, o_orderstatus, coalesce(odd, even) AS o_orderkey FROM a
  UNION ALL SELECT 'read', o_custkey, o_orderstatus, coalesce(odd, even) FROM a
  UNION ALL SELECT 'remake', o_custkey, o_orderstatus, odd FROM a WHERE odd IS NOT NULL""")
def upsert_modes(spark, sf_dir):
    held, new = halves(spark, sf_dir)
    root = scratch(spark, "modes")
    K.save(held, ORDERS, root, "remake", seq="o_orderkey")
    written = K.save(new, ORDERS, root, "write", seq="o_orderkey")
    unchanged = K.save(held, ORDERS, root, "read", seq="o_orderkey")
    other = TableSpec("orders_remade", ORDERS.keys)
    K.save(held, other, root, "write", seq="o_orderkey")
    remade = K.save(new, other, root, "remake", seq="o_orderkey")
    named = lambda df, mode: df.select(F.lit(mode).alias("mode"), "o_custkey", "o_orderstatus", "o_orderkey")
    return named(written, "write").unionByName(named(unchanged, "read")).unionByName(named(remade, "remake"))


@check("table_shape", """
  SELECT o_orderkey, '1:o_custkey bigint 2:o_orderstatus string 3:o_orderkey bigint 4:o_orderpriority string' AS shape FROM
    (SELECT max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey, o_orderstatus)""")
def shape(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey", "o_orderpriority")
    held = K.save(rows, ORDERS, scratch(spark, "shape"), "write", seq="o_orderkey")
    seen = " ".join(f"{i}:{n} {t}" for i, (n, t) in enumerate(table_shape(held), 1))
    return held.select("o_orderkey", F.lit(seen).alias("shape"))


@check("infer_types", """
  SELECT key, CASE WHEN bool_and(TRY_CAST(value AS BIGINT) IS NOT NULL AND NOT contains(value, '.')) THEN 'INTEGER'
                   WHEN bool_and(TRY_CAST(value AS DOUBLE) IS NOT NULL) THEN 'REAL' ELSE 'TEXT' END AS type
  FROM (SELECT unnest(['size', 'price', 'name', 'mixed']) AS key,
        unnest([CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR), p_name, CASE WHEN p_partkey % 100 = 99 THEN p_brand ELSE '1' END]) AS value FROM part)
  WHERE value IS NOT NULL GROUP BY 1""")
def infer_types(spark, sf_dir):
    lit, text = F.lit, lambda c: F.col(c).cast("string")
    mixed = F.when(F.col("p_partkey") % 100 == 99, F.col("p_brand")).otherwise("1")
    pairs = F.create_map(lit("size"), text("p_size"), lit("price"), text("p_retailprice"), lit("name"), F.col("p_name"), lit("mixed"), mixed)
    return K.inferred_types(table(spark, sf_dir, "part").select(F.explode(pairs).alias("key", "value")))


@check("reject_split", """
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'no price' WHEN o_totalprice < 50000 THEN 'cheap' ELSE 'kept' END AS reason FROM orders""")
def reject_split(spark, sf_dir):
    shown = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice").cast("string")).otherwise("n/a")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("price"))
    price = F.col("price").try_cast("double")
    good, rejects = K.split_rejects(rows, {"no price": price.isNotNull(), "cheap": price >= 50000})
    return union_by_name([good, rejects]).select("o_orderkey", F.coalesce("reason", F.lit("kept")).alias("reason"))


@check("stream_pages", HOSTS_SQL)
def stream_pages(spark, sf_dir):
    found = stream.stream_frontier(stream.read_pages(spark, sf_dir), scratch(spark, "stream-frontier"))
    return L.per_host(found)


@check("stream_dedupe", f"""
  SELECT DISTINCT {CANON.format(x="url")} AS url FROM pages""")
def stream_dedupe(spark, sf_dir):
    return stream.stream_urls(stream.read_pages(spark, sf_dir), scratch(spark, "stream-urls"))


@check("stream_upsert", """
  SELECT regexp_extract(url, '^\\w+://([^/?#]*)', 1) AS host, max(page_id) AS page_id, arg_max(url, page_id) AS url FROM pages GROUP BY 1""")
def stream_upsert(spark, sf_dir):
    """Pages as they arrive, the newest page per host kept."""
    step = lambda df: df.select(L.host(F.col("url")).alias("host"), "page_id", "url")
    return stream.stream_records(stream.read_pages(spark, sf_dir), step, ["host"], scratch(spark, "stream-rows"), "page_id")


@check("upsert_repeats", """
  SELECT o_custkey, max(o_orderkey) AS o_orderkey, 'table' AS place FROM orders WHERE o_custkey % 7 <> 0 GROUP BY 1
  UNION ALL SELECT -1, o_orderkey, 'rejects' FROM orders WHERE o_custkey % 7 = 0""")
def upsert_repeats(spark, sf_dir):
    """Keys that come in many times, the later row smaller in all but its order; rows without a key."""
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"), (-F.col("o_orderkey")).alias("less"), "o_orderkey")
    root, spec = scratch(spark, "repeats"), TableSpec("orders", ("o_custkey",))
    K.save(rows.where("o_orderkey % 2 = 0"), spec, root, "write", seq="o_orderkey")
    held = K.save(rows, spec, root, "write", seq="o_orderkey", keep=1)
    rejects = spark.read.parquet(f"{root}/orders_rejects").where("v = 2")
    return held.select("o_custkey", "o_orderkey", F.lit("table").alias("place")).unionByName(rejects.select(F.lit(-1).cast("bigint").alias("o_custkey"), "o_orderkey", F.lit("rejects").alias("place")))


@check("csv_snapshot_order", """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, 'none' AS absent FROM part""")
def csv_snapshot_order(spark, sf_dir):
    """A snapshot with a row number, its columns in another order, one too many and one missing."""
    path = scratch(spark, "snapshot")
    rows = table(spark, sf_dir, "part").select(F.monotonically_increasing_id().alias(" "), "p_size", "p_brand", "p_partkey", "p_name")
    K.write_csv(rows, path)
    found = read_snapshot(spark, path, spark.createDataFrame([], "p_partkey bigint, p_name string, p_size bigint, absent string").schema)
    return found.fillna("none", subset=["absent"])
