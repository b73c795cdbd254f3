"""Look-ups and invariants over finished tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, table
from tablewright.plans import lookups


@check("level_lookup", """
  WITH b AS (SELECT p_brand, p_type, min(p_size) AS lo, max(p_size) AS hi FROM part GROUP BY 1, 2)
  SELECT c_custkey, c_custkey % 60 AS level, p_brand, p_type FROM customer JOIN b ON c_custkey % 60 BETWEEN lo AND hi""")
def level_lookup(spark, sf_dir):
    bands = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.min("p_size").alias("MinLvl"), F.max("p_size").alias("MaxLvl"))
    levels = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 60).alias("level"))
    return lookups.rules_at(levels, bands).select("c_custkey", "level", "p_brand", "p_type")


@check("running_totals", """
  SELECT o_custkey, o_orderkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM orders""")
def running_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return lookups.running_total(rows, ["o_custkey"], "o_orderkey", "cents").select("o_custkey", "o_orderkey", "running")


@check("row_sums", """
  SELECT p_partkey, p_partkey % 4 <> 0 AS holds FROM part""")
def row_sums(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("a"), (100 - F.col("p_size") - 0.5).alias("b"), F.when(F.col("p_partkey") % 4 != 0, F.lit(0.5)).alias("c")
    )
    return rows.select("p_partkey", lookups.adds_up(["a", "b", "c"], 100).alias("holds"))
