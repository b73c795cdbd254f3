"""Set lists and set pages -> effects per set, class and number of worn items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.records import key_value
from tablewright.functions.text import clean_lines
from tablewright.operators import layout as Y, predicates as P, rename, reshape
from tablewright.operators.links import address, base_named, resolve, with_base
from tablewright.rules import RulePack
from tablewright.session import stage
from tablewright.sources.markup import cells_of, stored_nodes

# Anchor of the set section, and destination by header word, in test order.
SECTION = "Equipment_Set"
ROUTES = [("Set", "EquipSetEffectAt"), ("Cumulative", "EquipSetEffectCul")]


def class_of_tab(title: Column) -> Column:
    return F.when(title == "Common", F.lit("Any")).otherwise(title)


def set_index(pages: DataFrame, rules: RulePack = RulePack()) -> DataFrame:
    """Tracked sets named by index pages: ``(page_id, ClassType, EquipSet, link)``.

    The first tab box after the section heading has one tab per class; the i-th table belongs
    to the i-th tab. Links that hold a picture are not names.
    """
    read = stored_nodes(pages, ("h2", "span", "div", "li", "table", "a", "img"), "set-lists")
    rows = Y.heading_labels(Y.by_page(Y.outside_tables(read)))
    rows = rows.withColumn("after", Y.seen_before((F.col("tag") == "h2") & (F.col("label") == SECTION)))
    box = (F.col("tag") == "div") & Y.has_class("tabber") & F.col("after")
    rows = rows.withColumn("nth", Y.running_count(box)).withColumn("box", Y.enclosing(box & (F.col("nth") == 1))).where(F.col("box").isNotNull())
    rows = stage(rows.select("page_id", "node_id", "tag", "attrs", "text", "top_id"), "set-boxes", walk=True)
    titles = Y.numbered(rows.where((F.col("tag") == "li") & Y.has_class("wds-tabs__tab"))).select("page_id", "pos", F.trim("text").alias("title"))
    grids = Y.numbered(rows.where((F.col("tag") == "table") & Y.has_class("wikitable"))).select("page_id", "pos", "top_id")
    owned = titles.join(grids, ["page_id", "pos"]).select("page_id", "top_id", class_of_tab(F.col("title")).alias("ClassType"))
    named = Y.by_page(read.where(F.col("top_id").isNotNull() & F.col("tag").isin("a", "img"))).withColumn("pictured", Y.holds(F.col("tag") == "img"))
    links = named.where((F.col("tag") == "a") & ~F.col("pictured") & F.col("attrs")["href"].isNotNull()).select(
        "page_id", "top_id", F.col("attrs")["href"].alias("href")
    )
    found = links.join(owned, ["page_id", "top_id"]).join(with_base(pages.select("page_id", "url", base_named(F.col("html")).alias("_base"))).drop("url"), "page_id")
    return tracked_sets(found, rules=rules).select("page_id", "ClassType", "EquipSet", resolve(F.col("base"), address(F.col("href"))).alias("link"))


def tracked_sets(links: DataFrame, class_type: str = "ClassType", rules: RulePack = RulePack()) -> DataFrame:
    """Links of tracked sets with the set's name: separators, the word "Set" and the class removed."""
    plain = F.replace(F.regexp_replace(F.element_at(F.split("href", "/"), -1), r"%|_|-|#|27s", " "), F.lit("Set"), F.lit(""))
    name = F.rtrim(F.split_part(F.rtrim(F.replace(plain, F.col(class_type), F.lit(""))), F.lit("("), F.lit(1)))
    return links.withColumn("EquipSet", name).where(P.name_allowed(F.col("EquipSet"), rules.tracked_sets, rules.ignored_sets))


def set_effects(pages: DataFrame, known: Sequence[str], rules: RulePack = RulePack(), other: str | None = "Other") -> DataFrame:
    """Effect records of set pages: ``pages(page_id, html, EquipSet, ClassType)``.

    Each header is one destination. The threshold stands in the bold text of a row; the lines
    of the cell under a header are its effects. Rows without a threshold are skipped. Effects that
    are not ``known`` go to the map ``other`` and are left out only if that is None.
    """
    read = stored_nodes(pages, ("table", "th", "td", "b"), "set-nodes")
    grid = (F.col("tag") == "table") & Y.has_class("wikitable")
    grids = Y.by_page(Y.outside_tables(read)).withColumn("nth", Y.running_count(grid)).where(grid & (F.col("nth") == 1))
    rows = stage(Y.block_rows(read, grids), "set-rows")
    marks = rows.groupBy("page_id", "table_id", "row_idx").agg(
        F.min_by(F.when(F.col("tag") == "b", F.col("text")), F.when(F.col("tag") == "b", F.col("node_id"))).alias("mark"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("tag") == "b", F.col("lines"))))).alias("bold"),
    )
    cells = Y.with_header(cells_of(rows)).where(F.col("header").isNotNull())
    route = reshape.routed(F.col("header"), ROUTES)
    found = cells.join(marks.where(F.col("mark").isNotNull()), ["page_id", "table_id", "row_idx"]).join(
        pages.select("page_id", "EquipSet", "ClassType"), "page_id"
    )
    keys = ["EquipSet", "ClassType", "SetAt", "Destination"]
    lines = F.filter(clean_lines("lines"), lambda s: F.trim(s) != "")
    own = F.filter(lines, lambda s: ~F.array_contains("bold", s))
    # A threshold without effects is a record too.
    long = found.select(
        "EquipSet", "ClassType", F.split_part("mark", F.lit(" "), F.lit(1)).alias("SetAt"), route.alias("Destination"),
        F.posexplode_outer(own).alias("pos", "line"), "table_id", "row_idx",
    )
    pair = key_value(F.col("line"))
    kv = long.select(
        *keys,
        F.coalesce(pair["key"], F.lit("")).alias("key"),
        F.coalesce(pair["value"], F.lit("")).alias("value"),
        F.struct("row_idx", "pos").alias("seq"),
    )
    named = rename.name_fields(kv, rules.field_names)
    wide = reshape.pivot_wide(named, keys, list(known), other=other)
    if other:
        # A threshold without effects has one field, without name and value.
        wide = wide.withColumn(other, F.map_filter(other, lambda k, v: (k != "") | (v != "")))
    return reshape.order_columns(wide, rules.column_order)
