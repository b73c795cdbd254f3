"""Questions asked of the finished tables: the rule for a level, running totals, rows that must add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Where bands with an open end stop.
LONGEST = 2**61


def rules_at(levels: DataFrame, bands: DataFrame, level: str = "level", low: str = "MinLvl", high: str = "MaxLvl") -> DataFrame:
    """Each level with the bands that hold it.

    A band is cut into bins whose sizes are powers of two, at most two of a size, and a level looks
    itself up once for each size that any band has: a join on equality that Spark may broadcast or
    shuffle by size, in which no level meets a band that does not hold it, however wide bands are.
    A missing end is open; a band whose end is before its start holds none, and a missing level is in none.
    """
    first, last = (F.coalesce(F.col(c).cast("bigint"), F.lit(open_end).cast("bigint")) for c, open_end in ((low, -LONGEST), (high, LONGEST)))
    cut = bands.withColumn("_bin", F.explode(bins(first, last)))
    # One number for each power of two at most.
    sizes = sorted(r.size for r in cut.select(F.col("_bin.size").alias("size")).distinct().collect())
    at = F.col(level).cast("bigint")
    asked = F.array(*[F.struct(F.lit(s).alias("size"), F.shiftright(at, s).alias("place")) for s in sizes]) if sizes else F.array().cast("array<struct<size:int,place:bigint>>")
    placed = levels.where(at.isNotNull() & at.between(-LONGEST, LONGEST)).withColumn("_at", F.explode(asked))
    found = placed.join(cut, (placed["_at.size"] == cut["_bin.size"]) & (placed["_at.place"] == cut["_bin.place"])).drop("_at", "_bin")
    reaches = lambda c, ok: F.coalesce(ok(F.col(c)), F.lit(True))
    return found.where(reaches(low, lambda c: F.col(level) >= c) & reaches(high, lambda c: F.col(level) <= c))


def bins(first: Column, last: Column) -> Column:
    """The fewest bins ``(size, place)`` that hold the whole numbers from ``first`` to ``last``: place * 2^size up to the next place."""
    state = F.struct(first.alias("first"), last.alias("last"), F.array().cast("array<struct<size:int,place:bigint>>").alias("bins"))

    def step(acc: Column, size: Column) -> Column:
        # A first place that is odd, or a last one that is even, is no half of a larger bin of the band.
        bin_at = lambda place: F.array(F.struct(size.alias("size"), place.alias("place")))
        none = F.array().cast("array<struct<size:int,place:bigint>>")
        a, b = acc["first"], acc["last"]
        odd, even = (a <= b) & (a.bitwiseAND(F.lit(1)) == 1), (a <= b) & (b.bitwiseAND(F.lit(1)) == 0)
        taken = F.concat(acc["bins"], F.when(odd, bin_at(a)).otherwise(none), F.when(even & ~(odd & (a == b)), bin_at(b)).otherwise(none))
        up, down = a + odd.cast("bigint"), b - even.cast("bigint")
        return F.struct(
            F.when(up <= down, F.shiftright(up, 1)).otherwise(F.lit(1).cast("bigint")).alias("first"),
            F.when(up <= down, F.shiftright(down, 1)).otherwise(F.lit(0).cast("bigint")).alias("last"),
            taken.alias("bins"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(62)), state, step, lambda acc: acc["bins"])


def running_total(df: DataFrame, by: Sequence[str], order: str, value: str, into: str = "running") -> DataFrame:
    """The sum of a column up to each row of its series."""
    return df.withColumn(into, F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def adds_up(columns: Sequence[str], total: float, slack: float = 1e-6) -> Column:
    """True where the columns of a row, a missing one being 0, sum up to the total."""
    return F.abs(sum((F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0)) - total) <= slack
