"""Numbers hidden in text: bands, percentages, stars, tiers and effect sentences."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablewright.functions.text import before, trim_set

# Level bands without an upper end run to 300; without a lower end they start at 0.
OPEN_END = 300
OPEN_START = 0


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def first_number(c: Column) -> Column:
    """First integer in a text, or null."""
    return to_int(F.regexp_extract(c, r"(\d+)", 1))


def level_band(c: Column, lone: str = "closed") -> Column:
    """``10-19``, ``95~107``, ``138 and above``, ``250+``, ``at least level 70.``, ``120``.

    A single level closes the band at itself (``lone='closed'``) or opens it upwards
    (``lone='open'``), whichever the table kind calls for.
    """
    low = first_number(c)
    high = to_int(F.regexp_extract(c, r"\d+\s*[-~]\s*(\d+)", 1))
    opens = c.rlike(r"(?i)\+|and above|at least|requirement")
    single = F.lit(OPEN_END) if lone == "open" else low
    top = F.when(opens, F.lit(OPEN_END)).otherwise(F.coalesce(high, single))
    return F.struct(low.alias("MinLvl"), F.when(low.isNotNull(), top).alias("MaxLvl"))


def parse_number(c: Column, absent: float | None = None) -> Column:
    """``95%`` -> 95, ``3★`` -> 3, ``+12`` -> 12, ``1,500`` -> 1500; ``absent`` stands in for null."""
    digits = F.regexp_extract(c, r"(-?\d[\d,]*(?:\.\d+)?)", 1)
    number = F.replace(digits, F.lit(","), F.lit("")).try_cast("double")
    if absent is None:
        return number
    return F.when(c.isNull(), F.lit(float(absent))).otherwise(number)


def whole_number(c: Column) -> Column:
    """A number without a fraction that fits an integer, else null: nothing is cut and nothing overflows."""
    return F.when(c == F.floor(c), c.try_cast("int"))


def misread(read: dict[str, tuple[Column, Column]]) -> Column:
    """Entries (Field, Value) of the texts that hold something and gave no number: name -> (text, number)."""
    found = [F.struct(F.lit(name).alias("Field"), text.alias("Value"), (number.isNull() & (F.trim(text) != "")).alias("wrong")) for name, (text, number) in read.items()]
    return F.transform(F.filter(F.array(*found), lambda e: e["wrong"]), lambda e: F.struct(e["Field"], e["Value"]))


def number_or_null(c: Column) -> Column:
    """A text made of digits only becomes a number; anything else is null."""
    return F.when(c.rlike(r"^\d+$"), to_long(c))


def pair_maxima(c: Column) -> Column:
    """``1★ → 2★, 2★ → 3★`` -> ``[2, 3]``: the larger id of each pair."""
    pairs = F.split(c, ",")
    ids = F.transform(
        pairs,
        lambda p: F.array_max(
            F.transform(F.regexp_extract_all(p, F.lit(r"(\d+)"), F.lit(1)), lambda d: d.try_cast("int"))
        ),
    )
    return F.filter(ids, lambda x: x.isNotNull())


def flat_or_percent(c: Column) -> Column:
    return F.when(c.contains("%"), F.lit("Perc")).otherwise(F.lit("Flat"))


def flat_by_word(c: Column) -> Column:
    return F.when(c.contains("flat"), F.lit("Flat")).otherwise(F.lit("Perc"))


def effect_facts(c: Column) -> Column:
    """Chance, duration, tick and flat/percent kind of an effect sentence.

    The number in front of "chance to" is the chance; the one in front of "second(s)" is a
    duration, or a tick when "every" comes before it. The kind looks at the clause in front
    of "when", without the chance figure.
    """
    chance = F.regexp_extract(c, r"(\S+)\s+chance to", 1)
    timed = F.regexp_extract(c, r"(\S+)\s+second", 1)
    ticking = c.rlike(r"(?:^|\s)every\s.*second")
    seconds = first_number(timed)
    clause = F.trim(F.regexp_extract(c, r"(?s)^(.*?)(?:when|$)", 1))
    for figure in (chance, timed):
        clause = F.when(figure != "", F.replace(clause, figure, F.lit(""))).otherwise(clause)
    return F.struct(
        first_number(chance).alias("Chance"),
        F.when(~ticking, seconds).alias("Duration"),
        F.when(ticking, seconds).alias("Tick"),
        flat_or_percent(clause).alias("StatT"),
    )


def inline_percent(c: Column) -> Column:
    """The number in front of the first ``%`` of a sentence that does not speak of an increase."""
    return F.when(
        c.contains("%") & ~c.contains("Increase"),
        to_int(F.regexp_extract(c, r"^[^%]*?(\d+)\s*%", 1)),
    )


def tier_values(c: Column) -> Column:
    """Five slash-separated tiers; the last one loses ``%``, notes in brackets and ranges."""
    parts = F.split(c, "/")
    last = F.rtrim(F.regexp_extract(F.replace(F.get(parts, F.lit(4)), F.lit("%"), F.lit("")), r"^([^\-\[]*)", 1))
    names = ("B", "A", "S", "SS")
    return F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)], last.alias("SSS"))


def plus_entries(lines: Column) -> Column:
    """``["Max HP +5", "Knight's DEF +3%"]`` -> entries (key, value), apostrophes removed."""
    return F.transform(
        F.filter(lines, lambda s: s.contains("+")),
        lambda s: F.struct(
            F.trim(F.replace(F.replace(before(s, "+"), F.lit("'s"), F.lit("")), F.lit("'"), F.lit(""))).alias("key"),
            to_int(trim_set(F.split_part(s, F.lit("+"), F.lit(2)), " %\n")).alias("value"),
        ),
    )
