"""Distinct, ordered dedupe, long/wide reshaping, unions and fills.

Groups may be hot, so nothing here ranks rows inside a group: every "first" and "last" is an
aggregation that combines on the map side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def route_counts(df: DataFrame, kept: Column, by: str = "Destination") -> DataFrame:
    return df.groupBy(by).agg(
        F.count("*").alias("candidates"),
        F.count_if(~kept).alias("skipped"),
        F.count_if(kept).alias("recorded"),
    )


def dedupe_rows(df: DataFrame, seq: str | None = None) -> DataFrame:
    """Full-row dedupe. With ``seq``, the column tells order, is no part of the row, and the first is kept."""
    if seq is None:
        return df.dropDuplicates()
    return df.groupBy(*[c for c in df.columns if c != seq]).agg(F.min(seq).alias(seq))


def dedupe_ordered(
    df: DataFrame, keys: Sequence[str], order: str, blocks: Column, checked: Sequence[str] | None = None
) -> DataFrame:
    """Keep a row unless an earlier row of its key, for which ``blocks`` holds, came before it.

    The first blocking row of a key is always kept, so the rule is "not after the first
    blocking row": one pre-combined minimum per key joined back, instead of a running window
    over a group of any size. ``checked`` names other key columns to look rows up by.
    """
    checked = list(checked or keys)
    first = df.where(blocks).groupBy(*keys).agg(F.min(order).alias("_first"))
    for own, other in zip(keys, checked):
        first = first.withColumnRenamed(own, f"_k_{other}")
    match = reduce(lambda a, b: a & b, [df[c].eqNullSafe(first[f"_k_{c}"]) for c in checked])
    return (
        df.join(first, match, "left")
        .where(F.col("_first").isNull() | (F.col(order) <= F.col("_first")))
        .select(*df.columns)
    )


def first_seen(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    return df.groupBy(*key).agg(F.min(seq).alias(seq))


def last_wins(df: DataFrame, record: Sequence[str], value: str = "value", seq: str = "seq") -> DataFrame:
    return df.groupBy(*record).agg(F.max_by(value, seq).alias(value))


def take_first(df: DataFrame, record: Sequence[str], value: str = "value", seq: str = "seq") -> DataFrame:
    """First value that is neither missing nor empty."""
    usable = df.where(F.col(value).isNotNull() & (F.col(value) != ""))
    return usable.groupBy(*record).agg(F.min_by(value, seq).alias(value))


def pivot_wide(
    df: DataFrame, record: Sequence[str], known: Sequence[str], key: str = "key", value: str = "value", seq: str = "seq", other: str | None = None
) -> DataFrame:
    """Long records to columns, for the known keys; the last value of a key wins. One aggregation.

    With ``other`` a record is open: fields that are not known go to a map column of that name, so
    none is lost and the columns do not depend on the data. A field without a name goes there as "".
    """
    last = F.max_by(value, seq).alias(value)
    if other is None:
        picked = [F.max_by(F.when(F.col(key) == k, F.col(value)), F.when(F.col(key) == k, F.col(seq))).alias(k) for k in known]
        return df.groupBy(*record).agg(*picked)
    # The last value of each key first: what is collected for a record is then one entry a key.
    fields = df.withColumn(key, F.coalesce(key, F.lit(""))).groupBy(*record, key).agg(last)
    rest = F.collect_list(F.when(~F.coalesce(F.col(key).isin(*known), F.lit(True)), F.struct(F.col(key).alias("key"), F.col(value).alias("value"))))
    return fields.groupBy(*record).agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(k) for k in known], F.map_from_entries(rest).alias(other))


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def fill_and_cast(df: DataFrame, columns: Iterable[str], to: str = "int") -> DataFrame:
    """Missing becomes 0, then the columns are cast, straight to their type: no digit is lost on the way.

    A text that is no such number becomes missing; ``castable`` gives the rules that send such rows
    to the rejects first.
    """
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.when(F.col(f"`{c}`").isNull(), F.lit(0).cast(to)).otherwise(F.col(f"`{c}`").try_cast(to)) for c in present})


def castable(df: DataFrame, columns: Iterable[str], to: str = "int") -> dict[str, Column]:
    """Rules for ``split_rejects``: every value of the columns is missing or such a number."""
    present = [c for c in columns if c in df.columns]
    return {f"{c} is no {to}": F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(to).isNotNull() for c in present}


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.fillna(present) if present else df


def order_columns(df: DataFrame, canonical: Sequence[str]) -> DataFrame:
    """Canonical columns first and in order; unknown ones after them."""
    known = [c for c in canonical if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in known])


def cross_lists(df: DataFrame, left: str, right: str) -> DataFrame:
    """Each element of one list column with each element of another, within a row."""
    return df.withColumn(left, F.explode(left)).withColumn(right, F.explode(right))


def collapse_columns(df: DataFrame, columns: Sequence[str], into: str = "Stat value") -> DataFrame:
    """Several sparse columns become one: the last one that is neither missing nor zero."""
    def filled(c: str) -> Column:
        return F.when(~F.col(f"`{c}`").cast("string").isin("0", "0.0"), F.col(f"`{c}`").cast("string"))

    own = [filled(into)] if into in df.columns else []
    value = F.coalesce(*own, *[filled(c) for c in reversed(columns)])
    return df.withColumn(into, value).drop(*[c for c in columns if c != into])


def routed(header: Column, routes: Sequence[tuple[str, str]]) -> Column:
    """Destination of the first word of ``routes`` that a header contains, else the header."""
    return F.coalesce(*[F.when(header.contains(word), F.lit(to)) for word, to in routes], header)


def unpivot_routes(df: DataFrame, ids: Sequence[str], columns: Sequence[str], routes: Sequence[tuple[str, str]]) -> DataFrame:
    """Each effect column becomes records of the destination its name is routed to."""
    long = df.unpivot(list(ids), list(columns), "Header", "Effect")
    return long.withColumn("Destination", routed(F.col("Header"), routes)).drop("Header")
