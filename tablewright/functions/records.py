"""Field-level rules: names of fields, key/value lines, processors per field, map overlays."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

from tablewright.functions.text import after_last, ascii_only, before, contains_any, replace_each, trim_set
from tablewright.functions.numbers import number_or_null

# Stat words that make a bonus a main-stat bonus.
MAIN_STATS = ["STR", "DEX", "INT", "LUK"]


def grade_parts(c: Column) -> Column:
    """``Epic (Prime)`` -> grade ``Epic``, prime ``Prime``."""
    second = F.split_part(c, F.lit(" "), F.lit(2))
    return F.struct(before(c, " ").alias("Grade"), F.translate(second, "()", "").alias("Prime"))


def stat_and_group(c: Column) -> Column:
    """Name of a bonus and the equipment group it is for."""
    plain = F.trim(F.regexp_replace(ascii_only(c), r"\s*increase\s*", " "))
    mixed = F.when(plain.rlike(r"\band\b"), F.lit("Mixed Stats")).otherwise(plain)
    named = F.when(contains_any(mixed, MAIN_STATS), F.lit("Main Stats")).otherwise(mixed)
    group = F.trim(F.replace(after_last(named, "("), F.lit(")"), F.lit("")))
    stat = F.trim(before(named, "("))
    return F.struct(
        F.trim(F.replace(stat, F.lit("%"), F.lit(""))).alias("Stat"),
        F.when(named.contains("("), group).otherwise(F.lit("Common")).alias("EquipGrp"),
    )


def section_key(heading_id: Column) -> Column:
    """First two ``_`` tokens of a heading id, joined."""
    return F.array_join(F.slice(F.split(heading_id, "_"), 1, 2), "")


def field_name(key: Column, value: Column) -> Column:
    """Field name without requirement marks and blanks; HP/MP given in percent get a prefix."""
    name = F.trim(replace_each(key, ["REQ", "\n"]))
    percent = value.contains("%") & (name.contains("HP") | name.contains("MP"))
    name = F.when(percent, F.concat(F.lit("Perc "), name)).otherwise(name)
    return F.replace(name, F.lit(" "), F.lit(""))


def field_value(value: Column) -> Column:
    return F.trim(replace_each(value, ["+", "%"]))


def key_value(line: Column) -> Column:
    """One line of a stat block as (key, value).

    ``Max HP: +10%`` becomes ``Perc Max HP``; a note in parentheses is cut from the value; a
    line without a colon gives its last word as the value.
    """
    percent = line.contains("Max") & line.contains("%") & line.contains(":")
    has_colon = line.contains(":")
    left = before(line, ":")
    right = F.split_part(line, F.lit(":"), F.lit(2))
    plain_value = F.replace(trim_set(before(right, "("), " +%\n"), F.lit(","), F.lit(""))
    last_word = F.replace(F.regexp_replace(after_last(line, " "), r"[ +%\n]+$", ""), F.lit(","), F.lit(""))
    head = F.regexp_extract(line, r"(?s)^(.*) [^ ]*$", 1)
    return F.struct(
        F.when(percent, F.concat(F.lit("Perc "), left)).when(has_colon, left).otherwise(head).alias("key"),
        F.when(percent, trim_set(right, " +%\n")).when(has_colon, plain_value).otherwise(last_word).alias("value"),
    )


def last_entries(entries: Column) -> Column:
    """The last entry of each key, by key, so that ``map_from_entries`` never meets a repeat. Entries without a key go."""
    keyed = F.filter(entries, lambda e: e["key"].isNotNull())
    placed = F.sort_array(F.transform(keyed, lambda e, i: F.struct(e["key"].alias("key"), i.alias("place"), e["value"].alias("value"))))
    # Sorted once, as an element of its own: the next entry of the same key is the next element.
    last = lambda found: F.filter(found, lambda e, i: ~F.coalesce(F.get(found, i + 1)["key"] == e["key"], F.lit(False)))
    return F.get(F.transform(F.array(placed), last), F.lit(0))


def to_map(entries: Column) -> Column:
    kept = F.transform(last_entries(entries), lambda e: F.struct(e["key"], e["value"]))
    return F.map_from_entries(kept)


def overlay(base: Column, row: Column) -> Column:
    """Map with the entries of both; those of ``row`` win."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(row, k)), row)


# One expression per field, applied where the field exists. A user adds or replaces entries.
Processor = Callable[[Column], Column]


def level_text(c: Column) -> Column:
    """``Level 120`` -> 120, ``None`` -> 0, other texts -> null."""
    return F.when(F.lower(c).contains("level"), number_or_null(F.split_part(c, F.lit(" "), F.lit(2)))).when(
        F.lower(c).contains("none"), F.lit(0).cast("bigint")
    )


def slot_list(c: Column) -> Column:
    return F.split(trim_set(c, "\n\t"), "/")


FIELD_PROCESSORS: Mapping[str, Processor] = {
    "EquipSlot": lambda c: F.get(slot_list(c), F.lit(0)),
    "EquipName": lambda c: F.translate(trim_set(c, "\n"), ",<>", ""),
    "EquipLevel": level_text,
    "Category": lambda c: F.replace(trim_set(c, "\n"), F.lit(","), F.lit(";")),
}


def apply_processors(df, processors: Mapping[str, Processor] = FIELD_PROCESSORS):
    present = {name: fn(F.col(name)) for name, fn in processors.items() if name in df.columns}
    return df.withColumns(present) if present else df
