"""Bonus-stat pages -> one table of tiers per stat, equipment group and level band."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.numbers import OPEN_END, OPEN_START, first_number, level_band, parse_number
from tablewright.functions.records import stat_and_group
from tablewright.operators import layout as Y
from tablewright.operators.reshape import dedupe_ordered
from tablewright.sources.markup import cells_of, stored_nodes

# Section anchor, stats with tables per equipment type, and tier columns.
ANCHOR = "Stats"
ATTACK_STATS = ["Attack Power", "Magic Attack"]
SPECIAL_STAT = "Special Bonus Stats"
TIERS = [f"Tier {n}" for n in range(1, 8)]


def _blocks(rows: DataFrame) -> DataFrame:
    named = Y.with_headings(Y.heading_labels(Y.by_page(Y.outside_tables(rows))), ("h3", "h4", "dl", "p"), value="headline")
    started = Y.seen_before((F.col("tag") == "h2") & (F.col("label") == ANCHOR))
    return named.withColumn("started", started)


def flame_tables(pages: DataFrame) -> DataFrame:
    """Tiers by level band; columns that are not among the known ones go to the map ``Other``, as text."""
    rows = stored_nodes(pages, ("h2", "h3", "h4", "span", "dl", "p", "table", "th", "td"), "flame-nodes")
    by_h3, by_h4 = stat_and_group(F.col("h3")), stat_and_group(F.col("h4"))
    tables = _blocks(rows).where((F.col("tag") == "table") & F.col("started") & F.col("h3").isNotNull()).select(
        "page_id", "node_id", "dl", "p", by_h3.alias("top"), by_h4.alias("sub")
    )
    special = F.col("top")["Stat"] == SPECIAL_STAT
    per_type = F.col("top")["Stat"].isin(ATTACK_STATS) & (F.col("top")["EquipGrp"] == "Weapons")
    named = tables.select(
        "page_id",
        "node_id",
        "p",
        F.col("top")["Stat"].alias("TopStat"),
        F.col("top")["EquipGrp"].alias("TopGrp"),
        F.when(special, F.col("sub")["Stat"]).otherwise(F.col("top")["Stat"]).alias("Stat"),
        F.when(special, F.col("sub")["EquipGrp"]).otherwise(F.col("top")["EquipGrp"]).alias("EquipGrp"),
        F.when(per_type, F.when(F.coalesce(F.col("dl"), F.lit("")).contains("Normal"), "Normal").otherwise("Special")).otherwise("Common").alias("EquipType"),
    )
    kept = dedupe_ordered(
        named, ["page_id", "Stat", "EquipGrp"], "node_id", F.col("EquipType") != "Normal", checked=["page_id", "TopStat", "TopGrp"]
    ).withColumnRenamed("node_id", "table_id")

    cells = Y.with_header(Y.by_page(cells_of(rows)))
    cells = cells.withColumn("header", F.when(F.col("header").contains("level"), "level").otherwise(F.col("header")))
    wide = Y.record_columns(cells, {"level": "level", **{t: t for t in TIERS}}, other="Other")
    at_least = first_number(F.regexp_extract("p", r"at least level\s+(\d+)", 1))
    start = F.when(F.col("p").contains("Not affected") & ~F.col("p").contains("at least"), F.lit(OPEN_START)).otherwise(at_least)
    band = level_band(F.col("level"))
    listed = F.col("level").isNotNull()
    return wide.join(kept, ["page_id", "table_id"]).select(
        "page_id",
        "EquipGrp",
        "EquipType",
        "Stat",
        F.when(listed, band["MinLvl"]).otherwise(start).alias("MinLvl"),
        F.when(listed, band["MaxLvl"]).otherwise(F.lit(OPEN_END)).alias("MaxLvl"),
        *[parse_number(F.col(t)).alias(t) for t in TIERS],
        "Other",
    )
