"""Row, key and name rules that decide what is kept."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.text import contains_any, has_phrase, is_ascii
from tablewright.rules import local_rows, lookup


def row_kept(name: Column, level: Column, minimum: Column, ignored: Iterable[str]) -> Column:
    """ASCII name, level not below the minimum, no ignored word in the name. Unknown counts as no."""
    return F.coalesce(is_ascii(name) & (level >= F.coalesce(minimum, F.lit(0))) & ~contains_any(name, ignored), F.lit(False))


def with_minimum(df: DataFrame, slot: str, minimum: Mapping[str, int], into: str = "MinimumLevel") -> DataFrame:
    return df.join(lookup(df.sparkSession, minimum, slot, into), slot, "left")


def key_skipped(key: Column, phrases: Iterable[str], by_word: bool = False) -> Column:
    """Keys that are not facts: levels, requirements other than the job, and the skip phrases.

    A phrase has to occur as a whole; ``by_word`` skips on any word shared with a phrase.
    """
    phrases = list(phrases)
    if by_word:
        words = sorted({w for p in phrases for w in p.lower().split(" ")})
        listed = F.arrays_overlap(F.split(F.lower(key), " "), F.array(*[F.lit(w) for w in words]))
    else:
        listed = has_phrase(key, phrases)
    return (key == "Level") | (key.contains("REQ") & ~key.contains("Job")) | listed


def name_allowed(name: Column, allowed: Iterable[str], ignored: Iterable[str]) -> Column:
    return contains_any(name, allowed) & ~contains_any(name, ignored)


def update_where(df: DataFrame, mask: Column, column: str, value: Column | str) -> DataFrame:
    """Set ``column`` where the mask holds; a new column is null elsewhere."""
    new = F.lit(value) if not isinstance(value, Column) else value
    old = F.col(f"`{column}`") if column in df.columns else F.lit(None)
    return df.withColumn(column, F.when(mask, new).otherwise(old))


def exclude(df: DataFrame, key: Column, listed: Iterable[str]) -> DataFrame:
    """Drop rows whose key is listed."""
    import pyarrow as pa

    gone = local_rows(df.sparkSession, [(v,) for v in listed], [("_gone", pa.string())])
    return df.join(gone, key == gone["_gone"], "left_anti")
