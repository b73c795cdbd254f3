"""Renames and look-ups by dictionary."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.text import capwords, contains_any, replace_each
from tablewright.rules import RulePack, Variants, lookup, variants


def rename_exact(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    names = lookup(df.sparkSession, mapping, "_old", "_new")
    return df.join(names, df[column] == names["_old"], "left").withColumn(
        column, F.coalesce("_new", column)
    ).drop("_old", "_new")


def normal_key(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit(""))


def lookup_variant(df: DataFrame, column: str, dictionary: Variants, normalise: bool = False) -> DataFrame:
    """Variant to canonical name by equality; unknown values stay."""
    names = variants(df.sparkSession, dictionary).select("variant", "canonical")
    key = normal_key(df[column]) if normalise else df[column]
    return df.join(names, key == names["variant"], "left").withColumn(
        column, F.coalesce("canonical", column)
    ).drop("variant", "canonical")


def rename_substring(value: Column, dictionary: Variants) -> Column:
    """First dictionary entry with a variant inside the value wins; all its variants are replaced.

    The result is lower case apart from the canonical name; values without a match stay as they are.
    """
    low = F.lower(value)
    renamed = value
    for canonical, names in reversed(list(dictionary.items())):
        if names:
            renamed = F.when(contains_any(low, names), replace_each(low, names, canonical)).otherwise(renamed)
    return renamed


def rename_by_substrings(df: DataFrame, column: str, dictionary: Variants) -> DataFrame:
    """``rename_substring`` for dictionaries of names that are too many to be written as an expression.

    Each distinct value is read once by an automaton of all variants, whatever their number, so a hot
    value is matched once and only values that hold a variant have a row beyond that. An entry's
    variants are joined to these and replaced. The automaton is as large as the dictionary.
    """
    spark = df.sparkSession
    rules = variants(spark, dictionary)
    ranks: dict[str, int] = {}
    for row in rules.select("variant", "rank").toLocalIterator():
        ranks[row.variant] = min(row["rank"], ranks.get(row.variant, row["rank"]))
    shared = spark.sparkContext.broadcast(ranks)
    values = df.select(F.col(column).alias("_value")).where(F.col(column).isNotNull()).distinct()

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for variant, rank in shared.value.items():
            if variant:
                automaton.add_word(variant, rank)
        everywhere = shared.value.get("")
        if len(automaton):
            automaton.make_automaton()
        for batch in batches:
            found, best = [], []
            for value, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hits = (rank for _, rank in automaton.iter(low)) if len(automaton) else iter(())
                rank = min(hits, default=everywhere)
                if rank is not None and everywhere is not None:
                    rank = min(rank, everywhere)
                if rank is not None:
                    found.append(value)
                    best.append(rank)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(best, pa.int32())], ["_value", "rank"])

    best = values.select("_value", F.lower("_value").alias("low")).mapInArrow(matched, "_value string, rank int")
    entries = rules.groupBy("rank").agg(
        F.first("canonical").alias("canonical"), F.sort_array(F.collect_list(F.struct("step", "variant"))).alias("names")
    )
    named = best.join(entries, "rank").select(
        F.col("_value").alias("_key"),
        F.aggregate("names", F.lower("_value"), lambda acc, n: F.replace(acc, n["variant"], F.col("canonical"))).alias("_new"),
    )
    return df.join(named, df[column] == named["_key"], "left").withColumn(column, F.coalesce("_new", column)).drop("_key", "_new")


def drop_class_words(value: Column, class_type: Column, class_types: Variants, also: Sequence[str] = ("set",)) -> Column:
    """Remove the words of the row's class, the word "set" and parentheses from a set name."""
    base = F.lower(value)
    words = lambda names: r"\b(?:" + "|".join(rf"\Q{n}\E" for n in names) + r")\b|[()]"
    cleaned = F.regexp_replace(base, words(also), "")
    for name, names in class_types.items():
        if names:
            cleaned = F.when(class_type == name, F.regexp_replace(base, words([*names, *also]), "")).otherwise(cleaned)
    return cleaned


def rename_record(df: DataFrame, rules: RulePack = RulePack(), destination: str = "Destination") -> DataFrame:
    """Set and category renames of set and equipment names; changed values are re-capitalised."""
    out = df
    if "EquipSet" in df.columns:
        named = rename_substring(F.col("EquipSet"), rules.set_names)
        if "ClassType" in df.columns:
            named = drop_class_words(named, F.col("ClassType"), rules.class_types)
        out = out.withColumn("EquipSet", F.when(~named.eqNullSafe(F.col("EquipSet")), capwords(named)).otherwise(F.col("EquipSet")))
    if "EquipName" in df.columns:
        named = rename_substring(F.col("EquipName"), rules.set_names)
        if destination in df.columns:
            after_set, category = named, F.regexp_replace(F.col(destination), "^Equip", "")
            for kind, dictionary in rules.category_names.items():
                named = F.when(category == kind, rename_substring(after_set, dictionary)).otherwise(named)
        out = out.withColumn("EquipName", F.when(named != F.col("EquipName"), capwords(named)).otherwise(F.col("EquipName")))
    return out


def name_fields(kv: DataFrame, field_names: Mapping[str, str]) -> DataFrame:
    """Canonical field names and clean values of long records ``(…, key, value)``."""
    from tablewright.functions.records import field_name, field_value

    shaped = kv.withColumns({"key": field_name(F.col("key"), F.col("value")), "value": field_value(F.col("value"))})
    names = lookup(kv.sparkSession, field_names, "_field", "_name")
    return shaped.join(names, F.lower("key") == names["_field"], "left").withColumn(
        "key", F.coalesce("_name", "key")
    ).drop("_field", "_name")


def slot_category(slot: Column, armor: Sequence[str], accessories: Sequence[str]) -> Column:
    return (
        F.when(slot.isin(*armor), F.lit("EquipArmor"))
        .when(slot.isin(*accessories), F.lit("EquipAccessory"))
        .when(slot == "Shield", F.lit("EquipSecondary"))
        .otherwise(F.concat(F.lit("Equip"), slot))
    )
