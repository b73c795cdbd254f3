"""Text clean-up as ``Column -> Column`` expressions (all run in the JVM, none is a UDF)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def contains_any(c: Column, needles: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(n) for n in needles], F.lit(False))


def contains_all(c: Column, needles: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [c.contains(n) for n in needles], F.lit(True))


def replace_each(c: Column, needles: Iterable[str], by: str = "") -> Column:
    """Replace the needles one after the other; a missing text becomes the empty text.

    The order of the needles matters, so this is a fold and not one alternation.
    """
    return reduce(
        lambda acc, n: F.replace(acc, F.lit(n), F.lit(by)), needles, F.coalesce(c, F.lit(""))
    )


def clean_lines(lines: Column) -> Column:
    """Drop texts that hold nothing but a line break (and blanks); trim line breaks off the rest."""
    kept = F.filter(lines, lambda x: F.btrim(x, F.lit(" ")) != "\n")
    return F.transform(kept, lambda x: F.btrim(x, F.lit("\n")))


def trim_set(c: Column, chars: str) -> Column:
    """Trim any of ``chars`` from both ends."""
    return F.btrim(c, F.lit(chars))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def is_ascii(c: Column) -> Column:
    return ~c.rlike(r"[^\x00-\x7F]")


def squeeze(c: Column) -> Column:
    """Collapse runs of white space to one blank and trim."""
    return F.btrim(F.regexp_replace(c, r"\s+", " "))


def capwords(c: Column) -> Column:
    return F.initcap(squeeze(c))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def upper_first(c: Column) -> Column:
    """Upper-case the first letter and leave the others as they are."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))


def before(c: Column, delimiter: str) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(1))


def after_last(c: Column, delimiter: str) -> Column:
    return F.split_part(c, F.lit(delimiter), F.lit(-1))


def without_parens(c: Column) -> Column:
    """The text in front of the first opening parenthesis."""
    return F.rtrim(before(c, "("))


def split_list(c: Column) -> Column:
    """Split an enumeration at commas and at the word ``and``."""
    parts = F.split(c, r"\s*,\s*(?:and\s+)?|\s+and\s+")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def bucket_special(c: Column, marker: str, label: str = "SPECIAL") -> Column:
    """Texts that list several values are put in one bucket."""
    return F.when(c.contains(marker), F.lit(label)).otherwise(c)


def has_phrase(c: Column, phrases: Iterable[str]) -> Column:
    """True where a whole phrase occurs, bounded by non-word characters."""
    body = "|".join(r"\Q" + p + r"\E" for p in phrases)
    return c.rlike(rf"(?i)(?:^|\W)(?:{body})(?:\W|$)")
