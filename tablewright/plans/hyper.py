"""Hyper-stat pages -> points per level, effect per stat level and cost per stat level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.numbers import misread, parse_number, whole_number
from tablewright.functions.text import after_last, ascii_only, replace_each
from tablewright.operators import layout as Y, reshape
from tablewright.session import stage
from tablewright.sources.markup import cells_of, stored_nodes

# Section anchors and columns of the result tables.
POINTS_ANCHOR = "Hyper_Stats_Points_Distribution"
STATS_ANCHOR = "Hyper_Stats"
POINTS_COLUMNS = ["Level", "Points Awarded", "Total Points Awarded"]
EFFECT_COLUMNS = ["Hyper Stat Level", "Overall Effect", "Effect Increase from previous level"]
COST_COLUMNS = ["Hyper Stat Next Level", "Level up Cost", "Total Cost"]


def _read(whole: list[str], real: list[str] = []) -> dict[str, Column]:
    value = lambda c: parse_number(F.when(F.col(c).contains("+"), after_last(F.col(c), "+")).otherwise(F.col(c)))
    return {**{c: whole_number(value(c)) for c in whole}, **{c: value(c) for c in real}}


def _rejects(df: DataFrame, table: str, read: dict[str, Column]) -> DataFrame:
    """Cells that hold something that is no number of their column's kind: ``(Table, StatIncrease, Of, Field, Value)``."""
    stat = F.col("StatIncrease") if "StatIncrease" in df.columns else F.lit(None).cast("string")
    entries = F.explode(misread({c: (F.col(c), number) for c, number in read.items()})).alias("e")
    return df.select(F.lit(table).alias("Table"), stat.alias("StatIncrease"), F.col(next(iter(read))).alias("Of"), entries).select("Table", "StatIncrease", "Of", "e.*")


def hyper_tables(pages: DataFrame) -> dict[str, DataFrame]:
    heads = ("h1", "h2", "h3", "h4", "h5")
    read = stored_nodes(pages, (*heads, "span", "div", "table", "th", "td"), "hyper-nodes")
    rows = Y.with_headings(Y.heading_labels(Y.by_page(Y.outside_tables(read))), ("h3",), value="headline")
    at = lambda anchor: F.col("tag").isin(*heads) & (F.col("label") == anchor)
    rows = rows.withColumns({"in_points": Y.seen_before(at(POINTS_ANCHOR)), "in_stats": Y.seen_before(at(STATS_ANCHOR))})
    first_div = (F.col("tag") == "div") & F.col("in_points")
    rows = rows.withColumn("div_no", Y.running_count(first_div)).withColumn(
        "points", Y.enclosing(first_div & (F.col("div_no") == 1))
    )
    of_points = F.col("points").isNotNull()
    blocks = rows.where((F.col("tag") == "table") & (of_points | F.col("in_stats"))).withColumn("of_points", of_points)
    rows = stage(Y.block_rows(read, blocks, "of_points", "h3"), "hyper", walk=True)
    points_rows = rows.where(F.col("block")["of_points"])
    stat_rows = rows.where(~F.col("block")["of_points"])

    canon = lambda df: df.withColumn("header", Y.canonical_header(F.col("header")))
    points_cells = canon(Y.with_header(cells_of(points_rows)))
    by_name = lambda columns: {c: c for c in columns}
    points = Y.record_columns(points_cells, by_name(POINTS_COLUMNS)).select(*POINTS_COLUMNS)

    shown = replace_each(ascii_only(F.col("block")["h3"]), ["%", "Weapon and Magic"])
    # A table without a heading before it lists costs.
    name = F.when(F.col("block")["h3"].isNotNull(), F.trim(replace_each(shown, ["Increase"])))
    named = stat_rows.withColumn("StatIncrease", name)
    stat_cells = canon(Y.with_header(cells_of(named, keep=["StatIncrease"])))
    effect_cells, cost_cells = (stat_cells.where(p) for p in (F.col("StatIncrease").isNotNull(), F.col("StatIncrease").isNull()))
    effects = Y.record_columns(effect_cells, by_name(EFFECT_COLUMNS), keep=["StatIncrease"])
    costs = Y.record_columns(cost_cells, by_name(COST_COLUMNS))
    # What the tables hold beyond their columns, by table, stat and first column.
    further = reshape.union_by_name([
        Y.further_fields(points_cells, "HyperStatDistribution", by_name(POINTS_COLUMNS)).withColumn("StatIncrease", F.lit(None).cast("string")),
        Y.further_fields(effect_cells, "HyperStat", by_name(EFFECT_COLUMNS), keep=["StatIncrease"]),
        Y.further_fields(cost_cells, "HyperStatCost", by_name(COST_COLUMNS), keep=["StatIncrease"]),
    ])
    of_points, of_effects, of_costs = _read(POINTS_COLUMNS), _read(EFFECT_COLUMNS[:1], EFFECT_COLUMNS[1:]), _read(COST_COLUMNS)
    return {
        "HyperStatDistribution": points.withColumns(of_points),
        "HyperStat": effects.select("StatIncrease", *EFFECT_COLUMNS).withColumns(of_effects),
        "HyperStatCost": costs.select(*COST_COLUMNS).withColumns(of_costs),
        "HyperStatOther": further,
        "HyperStatRejects": reshape.union_by_name([
            _rejects(points, "HyperStatDistribution", of_points), _rejects(effects, "HyperStat", of_effects), _rejects(costs, "HyperStatCost", of_costs),
        ]),
    }
