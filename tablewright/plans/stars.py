"""One page with many table kinds -> limits, success rates and stat boosts per star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.numbers import OPEN_END, level_band, misread, pair_maxima, parse_number, whole_number
from tablewright.functions.records import section_key
from tablewright.operators import layout as Y
from tablewright.session import stage
from tablewright.sources.markup import cells_of, stored_nodes

# Section names, titles and columns of the result tables.
FIRST_TITLE = "Normal_Equips"
FIRST_ANCHOR = "Normal_Equip"
LAST_TITLE = "Superior_Items"
IGNORED_SECTIONS = ["Total_Stats", "Meso_Cost"]
LIMIT_COLUMNS = ["Level", "Max Stars"]
RATE_COLUMNS = ["Attempt", "Success", "Maintain", "Decrease", "Destroy"]
NORMAL_COLUMNS = [
    "Job Stat", "Non-Weapon Visible DEF", "Overall Visible DEF", "Category A Max HP", "Weapon Max MP",
    "Weapon Visible ATT", "Weapon Visible Magic ATT", "Shoes Speed", "Shoes Jump", "Gloves Visible ATT",
    "Gloves Visible Magic ATT", "Visible Stat", "Non-Weapon Weapon ATT", "Non-Weapon Magic ATT",
]
SUPERIOR_COLUMNS = ["Visible DEF", "Visible Stats", "Visible ATT"]


def _sectioned(pages: DataFrame) -> DataFrame:
    read = stored_nodes(pages, ("h3", "h4", "h5", "span", "table", "th", "td", "ul"), "star-nodes")
    walked = Y.with_sections(
        Y.heading_labels(Y.by_page(Y.outside_tables(read))), ignored=IGNORED_SECTIONS, stop_text="Total_Stats", stop_title=LAST_TITLE
    )
    title = F.when(F.col("title") == FIRST_ANCHOR, FIRST_TITLE).otherwise(F.col("title"))
    walked = walked.withColumns({"title": title, "section": section_key(F.col("section"))})
    blocks = walked.where((F.col("tag") == "table") & F.col("title").isNotNull() & F.col("section").isNotNull())
    return Y.block_rows(read, blocks, "title", "section")


def _section_cells(rows: DataFrame, section: str) -> DataFrame:
    inside = rows.where(F.col("block")["section"] == section).withColumn("Title", F.col("block")["title"])
    return Y.with_header(cells_of(inside, keep=["Title"]))


def _limit_cells(rows: DataFrame) -> DataFrame:
    return _section_cells(rows, "StarLimit").withColumn("header", F.when(F.col("header").contains("Level"), "Level").otherwise(F.col("header")))


def _rate_cells(rows: DataFrame) -> DataFrame:
    return _section_cells(rows, "SuccessRates").withColumn("header", Y.canonical_header(F.col("header")))


def _max_stars() -> Column:
    return whole_number(parse_number(F.col("Max Stars")))


def _rates() -> dict[str, Column]:
    """A cell that is absent, or present and empty, is a rate of 0."""
    number = lambda c: parse_number(Y.cell_values(F.col(c)), absent=0)
    return {c: whole_number(number(c)) if c == "Attempt" else number(c) for c in RATE_COLUMNS}


def star_limits(rows: DataFrame) -> DataFrame:
    wide = Y.record_columns(_limit_cells(rows), {c: c for c in LIMIT_COLUMNS}, keep=["Title"])
    band = level_band(F.col("Level"))
    return wide.select("Title", band["MinLvl"].alias("MinLvl"), band["MaxLvl"].alias("MaxLvl"), _max_stars().alias("Max Stars"))


def success_rates(rows: DataFrame) -> DataFrame:
    wide = Y.record_columns(_rate_cells(rows), {c: c for c in RATE_COLUMNS}, keep=["Title"])
    return wide.select("Title", *[number.alias(c) for c, number in _rates().items()])


def rejects(rows: DataFrame) -> DataFrame:
    """Cells of limits and rates that hold something that is no number of their column's kind: ``(Table, Title, Of, Field, Value)``."""
    def wrong(cells: DataFrame, table: str, columns: list[str], read: dict[str, Column]) -> DataFrame:
        wide = Y.record_columns(cells, {c: c for c in columns}, keep=["Title"])
        entries = F.explode(misread({c: (F.col(c), number) for c, number in read.items()})).alias("e")
        return wide.select(F.lit(table).alias("Table"), "Title", F.col(columns[0]).alias("Of"), entries).select("Table", "Title", "Of", "e.*")

    limits = wrong(_limit_cells(rows), "StarLimit", LIMIT_COLUMNS, {"Max Stars": _max_stars()})
    return limits.unionByName(wrong(_rate_cells(rows), "SFSuccessRates", RATE_COLUMNS, _rates()))


def stat_boosts(rows: DataFrame) -> DataFrame:
    """Rows ``(Title, SFID, MinLvl, MaxLvl, fields)``; ``fields`` maps stat to value."""
    boosts = rows.where(F.col("block")["section"] == "StatsBoost")
    title_of = Y.block_title(boosts)
    outer, inner = Y.nested_stats(boosts)
    merged = Y.overlay_inner(outer, inner)
    band = level_band(F.col("band"), lone="open")
    labels = outer.select("page_id", F.col("table_id").alias("outer_table"), F.col("row_idx").alias("outer_row"), "label", F.col("fields").alias("own"))
    both = labels.join(merged.drop("label"), ["page_id", "outer_table", "outer_row"], "left").where(
        F.col("fields").isNull() | F.col("band").rlike(r"\d")
    )
    plain = F.col("fields").isNull()
    rows_out = both.select(
        "page_id",
        "outer_table",
        F.explode(pair_maxima(F.col("label"))).alias("SFID"),
        F.when(plain, F.lit(0)).otherwise(band["MinLvl"]).alias("MinLvl"),
        F.when(plain, F.lit(OPEN_END)).otherwise(band["MaxLvl"]).alias("MaxLvl"),
        F.coalesce("fields", "own").alias("fields"),
    )
    return rows_out.join(title_of, ["page_id", "outer_table"]).select("Title", "SFID", "MinLvl", "MaxLvl", "fields")


def _boost_table(boosts: DataFrame, title: str, columns: list[str]) -> DataFrame:
    """Known stats as columns, the others in the map ``Other``."""
    values = [F.coalesce(F.col("fields")[c], F.lit(0)).cast("int").alias(c) for c in columns]
    other = F.map_filter("fields", lambda stat, _: ~stat.isin(*columns)).alias("Other")
    return boosts.where(F.col("Title") == title).select("SFID", "MinLvl", "MaxLvl", *values, other)


def further_fields(rows: DataFrame) -> DataFrame:
    """What limits and rates hold beyond their columns: ``(Table, Title, Of, Other)``."""
    limits = Y.further_fields(_limit_cells(rows), "StarLimit", {c: c for c in LIMIT_COLUMNS}, keep=["Title"])
    return limits.unionByName(Y.further_fields(_rate_cells(rows), "SFSuccessRates", {c: c for c in RATE_COLUMNS}, keep=["Title"]))


def star_tables(pages: DataFrame) -> dict[str, DataFrame]:
    rows = stage(_sectioned(pages), "stars")
    boosts = stat_boosts(rows)
    return {
        "StarLimit": star_limits(rows),
        "SFSuccessRates": success_rates(rows),
        "NormalEquipSF": _boost_table(boosts, FIRST_TITLE, NORMAL_COLUMNS),
        "SuperiorItemsSF": _boost_table(boosts, LAST_TITLE, SUPERIOR_COLUMNS),
        "StarOther": further_fields(rows),
        "StarRejects": rejects(rows),
    }
