"""Potential pages -> value rows and chance rows per slot, grade and stat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.numbers import OPEN_END, effect_facts, first_number, inline_percent, level_band
from tablewright.functions.records import grade_parts
from tablewright.functions.text import ascii_only, split_list, trim_set
from tablewright.operators import layout as Y
from tablewright.operators.reshape import dedupe_rows
from tablewright.session import stage
from tablewright.sources.markup import TEXT_TAGS, cells_of, stored_nodes

# The class of the content boxes and the text that marks another region's rows.
CONTENT_CLASS = "collapsible-content"
OTHER_REGION = ["GMS"]
KEYS = ["Kind", "Slot", "Grade", "Prime", "DisplayStat"]


def _walk(rows: DataFrame) -> DataFrame:
    rows = Y.by_page(Y.outside_tables(rows))
    rows = Y.with_headings(Y.heading_labels(rows), ("h2", "h3", "h4"), value="headline")
    graded = (F.col("tag") == "div") & F.col("h4").isNotNull()
    rows = rows.withColumn("graded", Y.enclosing(graded, "h2", "h3", "h4"))
    rows = rows.where(F.col("graded").isNotNull())
    content = (F.col("tag") == "div") & Y.has_class(CONTENT_CLASS)
    rows = rows.withColumn("content", Y.enclosing(content)).where(F.col("content").isNotNull())
    rows = rows.withColumn("child", F.col("parent_id") == F.col("content")["node_id"])
    rows = Y.classify_blocks(rows, drop=False)
    level = F.when(F.col("child") & (F.col("tag") == "p") & F.lower("text").contains("level requirement"), first_number(Y.after_colon(F.col("text"))))
    rows = rows.withColumn("MinLvl", Y.last_so_far(level, "block"))
    in_div = (F.col("tag") == "div") & F.col("child")
    rows = rows.withColumn("div", Y.enclosing(in_div, "block", "heading", "MinLvl"))
    low = F.lower("text")
    cubes = F.when(low.contains("cubes"), F.translate("text", ",", ";"))
    chance = F.when(~low.contains("cubes") & low.contains("chance"), trim_set(F.element_at(F.split(F.trim("text"), " "), -1), " +%\n"))
    boxed = F.col("div").isNotNull() & ~F.col("child") & (F.col("tag") != "table")
    return rows.withColumns(
        {"CubeType": Y.last_so_far(F.when(boxed, cubes)), "BoxChance": Y.last_so_far(F.when(boxed, chance))}
    )


def _tables(rows: DataFrame) -> DataFrame:
    """One row per table: its block, kind and what the walk knows at that point."""
    boxed = F.col("div").isNotNull()
    pick = lambda c: F.when(boxed, F.col("div")[c]).otherwise(F.col(c))
    tables = rows.where((F.col("tag") == "table") & (boxed | F.col("child")))
    return tables.select(
        "page_id",
        F.col("node_id").alias("table_id"),
        F.col("content")["node_id"].alias("content_id"),
        "graded",
        pick("block").alias("block"),
        pick("heading").alias("heading"),
        pick("MinLvl").alias("MinLvl"),
        F.when(boxed, F.lit("boxed")).otherwise(F.col("kind")).alias("table_kind"),
        F.when(boxed, F.col("CubeType")).alias("CubeType"),
        F.when(boxed, F.col("BoxChance")).alias("BoxChance"),
    ).where(F.col("block") > 0)


def _with_facts(rows: DataFrame) -> DataFrame:
    """Kind, slots, grade and effect facts of the headings a row stands under."""
    display = F.trim(ascii_only(F.col("heading")))
    grade = grade_parts(F.col("graded")["h4"])
    facts = effect_facts(display)
    return rows.select(
        "*",
        F.when(F.lower(F.col("graded")["h2"]).contains("bonus"), "Bonus").otherwise("Main").alias("Kind"),
        F.explode(split_list(F.col("graded")["h3"])).alias("Slot"),
        grade["Grade"].alias("Grade"),
        grade["Prime"].alias("Prime"),
        display.alias("DisplayStat"),
        facts["Chance"].alias("FactChance"),
        facts["Tick"].alias("Tick"),
        facts["StatT"].alias("FactStatT"),
        F.when(F.col("MinLvl").isNotNull(), inline_percent(display)).alias("Inline"),
    )


def _field(h: Column) -> Column:
    return F.trim(F.split_part(h, F.lit("("), F.lit(1)))


def _table_fields(rows: DataFrame) -> DataFrame:
    """Cells zipped to headers: band and chance by name, the rest as a map of values in order."""
    cells = Y.with_header(Y.by_page(cells_of(rows)))
    clean = Y.drop_noise_rows(cells, OTHER_REGION)
    low = F.lower("header")
    value = trim_set(F.split_part(F.replace("text", F.lit("seconds"), F.lit("")), F.lit("("), F.lit(1)), " +\n")
    other = ~low.contains("level") & ~low.contains("chance")
    last = lambda named, text: F.max_by(F.when(named, text), F.when(named, F.col("col_idx")))
    return clean.groupBy("page_id", "table_id", "row_idx").agg(
        last(low.contains("level"), F.col("text")).alias("Level"),
        last(low.contains("chance"), trim_set(F.col("text"), " +%\n")).alias("RowChance"),
        F.sort_array(F.collect_list(F.when(other & (value != ""), F.struct("col_idx", _field(F.col("header")).alias("key"), value.alias("value"))))).alias("values"),
    )


def potential_tables(pages: DataFrame) -> dict[str, DataFrame]:
    rows = stored_nodes(pages, (TEXT_TAGS - {"li", "ul", "script", "title"}) | {"div", "table"}, "potential-nodes")
    fields = _table_fields(rows)
    tables = stage(_tables(_walk(rows)), "potential-tables", walk=True)
    # Each chance table of a block releases the last value table before it, so several pairs may share a heading.
    block = ["page_id", "content_id", "block"]
    is_chance = F.col("table_kind") == "chance"
    value_table = F.when(F.col("table_kind") == "value", F.col("table_id"))
    before = Window.partitionBy(*block).orderBy("table_id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = tables.withColumn("pair", F.coalesce(F.count_if(is_chance).over(before), F.lit(0)))
    within, pair = Window.partitionBy(*block), Window.partitionBy(*block, "pair")
    facts = numbered.withColumns(
        {
            "chances": F.count_if(is_chance).over(within),
            "has_boxes": F.some(F.col("table_kind") == "boxed").over(within),
            "any_value": F.max(value_table).over(within),
            "pair_value": F.max(value_table).over(pair),
        }
    )
    released = (F.col("pair") < F.col("chances")) & ~F.col("has_boxes") & (F.col("table_id") == F.col("pair_value"))
    used = facts.where((F.col("table_kind") == "boxed") | released)
    bare = facts.where(is_chance & F.col("any_value").isNull() & ~F.col("has_boxes"))
    valued = _with_facts(used).join(fields, ["page_id", "table_id"])
    alone = _with_facts(bare)
    values = dedupe_rows(_value_rows(valued).unionByName(_value_rows(alone, bare=True)))

    chances = _with_facts(facts.where(is_chance)).join(fields, ["page_id", "table_id"])
    rates = dedupe_rows(
        chances.select(
            *KEYS,
            F.col("RowChance").try_cast("double").alias("Chance"),
            F.explode_outer(F.transform("values", lambda v: F.struct(v["key"].alias("Field"), v["value"].alias("Value")))).alias("f"),
        ).select(*KEYS, "Chance", "f.Field", "f.Value")
    )
    of = lambda df, kind: df.where(F.col("Kind") == kind).drop("Kind")
    return {
        "PotentialData": of(values, "Main"),
        "PotentialCubeRatesData": of(rates, "Main"),
        "BonusData": of(values, "Bonus"),
        "BonusCubeRatesData": of(rates, "Bonus"),
    }


def _value_rows(df: DataFrame, bare: bool = False) -> DataFrame:
    band = level_band(F.lit(None).cast("string") if bare else F.col("Level"))
    filled = F.lit(None).cast("string") if bare else F.element_at(F.filter(F.transform("values", lambda v: v["value"]), lambda v: ~v.isin("0")), -1)
    own_chance = F.lit(None).cast("string") if bare else F.col("RowChance")
    # An inline figure of the heading stands unless it is zero; else the last value column does.
    text = F.coalesce(F.when(F.col("Inline") != 0, F.col("Inline").cast("string")), filled)
    percent = F.coalesce(text.contains("%"), F.lit(False))
    return df.select(
        *KEYS,
        F.coalesce(band["MinLvl"], "MinLvl", F.lit(0)).cast("int").alias("MinLvl"),
        F.coalesce(band["MaxLvl"], F.when(F.col("MinLvl").isNotNull(), F.lit(OPEN_END)), F.lit(0)).cast("int").alias("MaxLvl"),
        F.coalesce(own_chance.try_cast("double"), F.col("BoxChance").try_cast("double"), F.col("FactChance").cast("double"), F.lit(0.0)).alias("Chance"),
        F.coalesce("Tick", F.lit(0)).cast("int").alias("Tick"),
        F.when(percent, "Perc").otherwise(F.col("FactStatT")).alias("StatT"),
        F.coalesce(F.trim(F.replace(text, F.lit("%"), F.lit(""))), F.lit("0")).alias("Stat value"),
        F.coalesce("CubeType", F.lit("0")).alias("CubeType"),
    )
