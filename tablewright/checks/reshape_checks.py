"""Counts, dedupe, long/wide reshaping, unions and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.checks.registry import check, no_gaps, table
from tablewright.operators import reshape as S
from tablewright.rules import COLUMN_ORDER

CENTS = "CAST(round({}*100) AS BIGINT)"


@check("route_counts", """
  SELECT event_type AS "Destination", CAST(count(*) AS BIGINT) AS candidates, CAST(count(*) FILTER (WHERE value <= 50) AS BIGINT) AS skipped,
         CAST(count(*) FILTER (WHERE value > 50) AS BIGINT) AS recorded FROM events GROUP BY 1""")
def route_counts(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "Destination")
    return S.route_counts(events, F.col("value") > 50)


@check("dedupe_rows", "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem")
def dedupe_rows(spark, sf_dir):
    return S.dedupe_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag"))


@check("dedupe_rows_first", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def dedupe_rows_first(spark, sf_dir):
    return S.dedupe_rows(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), seq="event_id")


@check("dedupe_ordered", """
  SELECT event_id, user_id, event_type FROM (SELECT *, coalesce(sum(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) WHERE before = 0""")
def dedupe_ordered(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return S.dedupe_ordered(events, ["user_id"], "event_id", F.col("event_type") != "view")


@check("first_seen", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def first_seen(spark, sf_dir):
    return S.first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_id")


def event_kv(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("key"), "props", F.col("event_id").alias("seq"))


@check("last_wins", "SELECT user_id, event_type AS key, arg_max(props, event_id) AS value FROM events GROUP BY 1, 2")
def last_wins(spark, sf_dir):
    return S.last_wins(event_kv(spark, sf_dir).withColumnRenamed("props", "value"), ["user_id", "key"])


@check("take_first", """
  SELECT user_id, event_type AS key, arg_min(props, event_id) AS value FROM events WHERE value > 20 GROUP BY 1, 2""")
def take_first(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    shown = F.when(F.col("value") > 20, F.col("props")).when(F.col("event_id") % 2 == 0, "")
    kv = events.select("user_id", F.col("event_type").alias("key"), shown.alias("value"), F.col("event_id").alias("seq"))
    return S.take_first(kv, ["user_id", "key"])


@check("pivot_wide", """
  SELECT user_id, arg_max(props, event_id) FILTER (WHERE event_type = 'click') AS click, arg_max(props, event_id) FILTER (WHERE event_type = 'view') AS view,
         arg_max(props, event_id) FILTER (WHERE event_type = 'error') AS error FROM events GROUP BY 1""")
def pivot_wide(spark, sf_dir):
    return S.pivot_wide(event_kv(spark, sf_dir).withColumnRenamed("props", "value"), ["user_id"], ["click", "view", "error"])


@check("union_missing", """
  SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL AS brand FROM customer
  UNION ALL SELECT s_name, s_nationkey, NULL, NULL FROM supplier UNION ALL SELECT p_name, -1, NULL, p_brand FROM part""")
def union_missing(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"))
    return no_gaps(S.union_by_name([c, s, p]), "nation")


@check("fill_cast", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_custkey AS BIGINT) END AS chance, CASE WHEN o_orderstatus = 'P' THEN CAST(7 AS BIGINT) ELSE 0 END AS tick FROM orders""")
def fill_cast(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey").cast("string")).alias("chance"),
        F.when(F.col("o_orderstatus") == "P", "7").alias("tick"),
        F.lit("x").alias("Duration"),
    )
    return S.fill_and_cast(raw.drop("Duration"), ["chance", "tick", "absent"], "bigint")


@check("fill_defaults", """
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'None' ELSE o_orderpriority END AS "EquipSet",
         CASE WHEN o_custkey % 2 = 0 THEN 'Any' ELSE o_orderstatus END AS "ClassName" FROM orders""")
def fill_defaults(spark, sf_dir):
    from tablewright.rules import DEFAULT_VALUES

    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("EquipSet"),
        F.when(F.col("o_custkey") % 2 != 0, F.col("o_orderstatus")).alias("ClassName"),
    )
    return S.fill_defaults(raw, DEFAULT_VALUES)


@check("column_order", """
  SELECT p_partkey, '1:EquipSlot 2:EquipName 3:STR 4:WATK 5:Rank 6:Extra 7:p_partkey' AS columns, p_name || p_type AS both FROM part""")
def column_order(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        F.lit("r").alias("Rank"), F.col("p_type").alias("EquipName"), F.lit("e").alias("Extra"), F.lit(1).alias("WATK"),
        F.lit(2).alias("STR"), F.col("p_name").alias("EquipSlot"), "p_partkey",
    )
    ordered = S.order_columns(raw, COLUMN_ORDER)
    seen = " ".join(f"{i}:{c}" for i, c in enumerate(ordered.columns, 1))
    return ordered.select("p_partkey", F.lit(seen).alias("columns"), F.concat("EquipSlot", "EquipName").alias("both"))


@check("explode_cross", """
  SELECT p_partkey, unnest([p_name, p_name, p_type, p_type, p_brand, p_brand]) AS slot, unnest([p_size, p_size + 1, p_size, p_size + 1, p_size, p_size + 1]) AS lvl FROM part""")
def explode_cross(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        "p_partkey", F.array("p_name", "p_type", "p_brand").alias("slot"), F.array(F.col("p_size"), F.col("p_size") + 1).alias("lvl")
    )
    return S.cross_lists(raw, "slot", "lvl")


@check("explode_overlay", """
  SELECT p_partkey, unnest([p_name, p_type]) AS slot, p_brand AS a, CAST(p_size AS VARCHAR) AS b, 'c' AS c FROM part""")
def explode_overlay(spark, sf_dir):
    from tablewright.functions.records import overlay

    lit, col = F.lit, F.col
    base = F.create_map(lit("a"), lit("old"), lit("c"), lit("c"))
    row = F.create_map(lit("a"), col("p_brand"), lit("b"), col("p_size").cast("string"))
    merged = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array("p_name", "p_type")).alias("slot"), overlay(base, row).alias("m"))
    return merged.select("p_partkey", "slot", *[col("m")[k].alias(k) for k in "abc"])


@check("collapse_cols", """
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '11' WHEN 1 THEN CASE WHEN o_custkey = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END WHEN 2 THEN o_orderpriority END AS "Stat value" FROM orders""")
def collapse_cols(spark, sf_dir):
    form = F.col("o_orderkey") % 4
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(form == 0, "11").otherwise("0").alias("Stat value"),
        F.when(form <= 2, F.col("o_orderpriority")).alias("HP"),
        F.when(form == 1, F.col("o_custkey").cast("string")).when(form == 2, "0").alias("MP"),
    )
    return S.collapse_columns(raw, ["HP", "MP"])


@check("explode_list", """
  SELECT p_partkey, unnest([p_type[1] || lower(p_type[2:]), 'Brand' || substr(p_brand, 6)]) AS weapon FROM part""")
def explode_list(spark, sf_dir):
    from tablewright.functions.text import capitalize

    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array("p_type", "p_brand")).alias("weapon"))
    return rows.withColumn("weapon", capitalize(F.col("weapon")))


@check("unpivot_route", """
  SELECT p_partkey, unnest(['EquipSetEffectAt', 'EquipSetEffectCul', 'EquipSetEffectAt', 'Notes']) AS "Destination",
         unnest([p_name, p_type, p_brand, 'n']) AS "Effect" FROM part""")
def unpivot_route(spark, sf_dir):
    raw = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("Set Effect"), F.col("p_type").alias("Cumulative Effect"),
        F.col("p_brand").alias("Cumulative Set Effect"), F.lit("n").alias("Notes"),
    )
    effects = ["Set Effect", "Cumulative Effect", "Cumulative Set Effect", "Notes"]
    return S.unpivot_routes(raw, ["p_partkey"], effects, [("Set", "EquipSetEffectAt"), ("Cumulative", "EquipSetEffectCul")])


@check("pivot_open", """
  WITH l AS (SELECT user_id, event_type AS key, arg_max(props, event_id) AS value FROM events GROUP BY 1, 2)
  SELECT u.user_id, k.value AS click, o.key AS other_key, o.value AS other_value
  FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN l k ON k.user_id = u.user_id AND k.key = 'click'
  LEFT JOIN l o ON o.user_id = u.user_id AND o.key <> 'click'""")
def pivot_open(spark, sf_dir):
    """One known field; the others of a record, whatever they are, stay with it."""
    long = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("key"), F.col("props").alias("value"), F.col("event_id").alias("seq"))
    wide = S.pivot_wide(long, ["user_id"], ["click"], other="other")
    return wide.select("user_id", "click", F.explode_outer("other").alias("other_key", "other_value"))


@check("fill_cast_large", """
  SELECT o_orderkey, 9007199254740993 + o_orderkey AS large, CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) WHEN o_orderkey % 3 = 1 THEN -1 ELSE o_custkey END AS num,
         CASE WHEN o_orderkey % 3 = 1 THEN 'num is no bigint' ELSE 'kept' END AS reason FROM orders""")
def fill_cast_large(spark, sf_dir):
    """Numbers beyond what a double holds keep their digits; a text is rejected, not read as 0."""
    from tablewright.operators.sinks import split_rejects

    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") + 9007199254740993).cast("string").alias("large"),
        F.when(F.col("o_orderkey") % 3 == 1, "abc").when(F.col("o_orderkey") % 3 == 2, F.col("o_custkey").cast("string")).alias("num"),
    )
    good, bad = split_rejects(raw, S.castable(raw, ["large", "num"], "bigint"))
    both = S.union_by_name([good, bad])
    return S.fill_and_cast(both, ["large", "num"], "bigint").select("o_orderkey", "large", F.coalesce("num", F.lit(-1)).alias("num"), F.coalesce("reason", F.lit("kept")).alias("reason"))
