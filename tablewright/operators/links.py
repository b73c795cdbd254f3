"""Links of stored pages: extraction, resolution, predicates, dedupe and the next frontier."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from functools import reduce
from html import entities

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.session import Buckets

# After so many rounds the pieces of a long search are written as one.
_COMPACT_ROUNDS = 8
# Inside of a tag: it ends at the first bracket outside quoted values. Repeated possessively, so that the
# matcher runs over it in a loop: a repeated choice would take a step of its stack for each character.
TAG = r"(?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+"
# What holds no markup: comments, scripts and styles, also those that are never closed.
NOT_MARKUP = rf"(?is)<!--.*?(?:-->|\z)|<script\b{TAG}>.*?(?:</script\s*>|\z)|<style\b{TAG}>.*?(?:</style\s*>|\z)"
# An anchor starts at ``<a`` and ends at ``</a>``, at the next anchor, or, never closed, at the next tag.
ANCHOR_START = r"(?i)<a(?=\s)"
BASE = rf"(?is)<base(\s{TAG})>"
OPENING = rf"(?s)^(\s{TAG})>"
BODY = rf"(?is)^\s{TAG}>(.*?(?=</a\s*>)|[^<]*)"


def attribute(attrs: Column, name: str) -> Column:
    """Value of an attribute, quoted or not, or null."""
    given = F.regexp_extract(attrs, rf"(?is)(?:^|\s){name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    value = lambda v: F.when(v != "", F.when(F.substring(v, 1, 1).isin('"', "'"), F.substring(v, 2, F.length(v) - 2)).otherwise(v))
    # An element of a list is looked for once, however often it is read.
    return F.get(F.transform(F.array(given), value), F.lit(0))


# The names of entities are those the parse pass knows; old ones need no semicolon.
_OLD_NAMES = sorted((n for n in entities.html5 if not n.endswith(";")), key=len, reverse=True)
_ENTITY = r"^(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;|(?:" + "|".join(_OLD_NAMES) + "))"


def _named(names: Iterable[str]) -> Column:
    return F.from_json(F.lit(json.dumps({n: entities.html5[n] for n in names})), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a number, read as browsers do: Windows letters, and none for control codes."""
    windows = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    control = code.between(1, 8) | code.between(14, 31) | (code == 11) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF) | code.isNull(), F.lit("\ufffd"))
        .when(code.between(0x80, 0x9F), F.try_element_at(F.from_json(F.lit(json.dumps(windows)), "map<string,string>"), code.cast("string")))
        .when(code == 13, F.lit("\r"))
        .when(control, F.lit(""))
        .otherwise(plain)
    )


def unescape(c: Column) -> Column:
    """All entities, named and numeric, as the parse pass reads them; texts without any are passed by."""

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, _ENTITY, 1)
        # An exact name, or the longest old name that the text begins with.
        whole = F.try_element_at(_named(entities.html5), name)
        old = F.regexp_extract(part, "^(?:" + "|".join(_OLD_NAMES) + ")", 0)
        taken = F.when(name.startswith("#") | whole.isNotNull(), name).otherwise(old)
        hexadecimal = name.rlike("^#[xX]")
        digits = F.regexp_replace(F.when(hexadecimal, F.substr(name, F.lit(3))).otherwise(F.substr(name, F.lit(2))), "^0+(?=.)|;$", "")
        value = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
        number = F.when(F.length(digits) > 9, F.lit(0)).otherwise(value.try_cast("bigint"))
        char = F.when(name.startswith("#"), _character(number)).otherwise(F.coalesce(whole, F.try_element_at(_named(_OLD_NAMES), old)))
        return F.when(taken == "", F.concat(F.lit("&"), part)).otherwise(F.concat(char, F.substr(part, F.length(taken) + 1)))

    parts = F.split(c, "&")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
    return F.when(c.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


def _markup(html: Column) -> Column:
    """A page without comments, scripts and styles; pages without any are not copied."""
    return F.when(html.rlike(r"(?i)<!--|<script|<style"), F.regexp_replace(html, NOT_MARKUP, "")).otherwise(html)


def address(href: Column) -> Column:
    """An address as browsers read it: blanks around it and line ends within it do not count."""
    return F.translate(F.btrim(href, F.lit(" \t\n\r\f")), "\t\n\r", "")


def base_named(html: Column) -> Column:
    """The address in the first base element of a page that has any, as it is written, else null."""
    named = attribute(F.regexp_extract(_markup(html), BASE, 1), "href")
    return F.when(html.rlike(r"(?i)<base\s"), address(F.replace(named, F.lit("&amp;"), F.lit("&"))))


def with_base(df: DataFrame, named: str = "_base") -> DataFrame:
    """``df`` with ``base``, what the links of a page are relative to: its ``url``, unless its base element names another.

    ``named`` is the column that holds ``base_named`` of the page, and goes: a column of its own, as resolving reads it many times.
    """
    base = F.when(F.col(named).isNull(), F.col("url")).otherwise(resolve(F.col("url"), F.col(named)))
    return df.withColumn("base", base).drop(named)


def extract(pages: DataFrame, region: str | None = None, text: bool = True) -> DataFrame:
    """One row per anchor: ``page_id, url, base, pos, href, title, text, attrs, body``; without ``text`` that column is left out.

    Stays in the JVM and reads each page once, closed anchors or not: the page is split where
    anchors start, and small patterns take the pieces apart. ``region`` is a pattern whose first
    group is the part of the page to look at. Addresses are relative to ``base``.
    """
    area = _markup(F.col("html") if region is None else F.regexp_extract("html", region, 1))
    pieces = F.split(area, ANCHOR_START)
    # A length beyond any page: the size of the pieces would have the page split a second time.
    anchors = F.slice(pieces, 2, 1 << 30)
    named = base_named(F.col("html")).alias("_base")
    found = with_base(pages.where(F.col("html").isNotNull()).select("page_id", "url", named, F.posexplode(anchors).alias("pos", "anchor")))
    attrs = F.regexp_extract("anchor", OPENING, 1)
    body = F.regexp_extract("anchor", BODY, 1)
    taken = found.select("page_id", "url", "base", "pos", attrs.alias("attrs"), body.alias("body"))
    texts = F.array(attribute(F.col("attrs"), "href"), attribute(F.col("attrs"), "title"), *([F.trim(F.regexp_replace("body", r"<[^>]*>", ""))] if text else []))
    # Decoded as elements of one list: the rules for entities are many, and planned once so. Exploded from a list
    # of its own, as filters on what was read would else go below and read it again, each for itself.
    read = taken.select("*", F.explode(F.array(F.transform(texts, unescape))).alias("_read"))
    return read.select(
        "page_id",
        "url",
        "base",
        "pos",
        address(F.col("_read")[0]).alias("href"),
        F.col("_read")[1].alias("title"),
        *([F.col("_read")[2].alias("text")] if text else []),
        "attrs",
        "body",
    ).where(F.col("href").isNotNull())


def site(url: Column) -> Column:
    return F.regexp_extract(url, r"^(\w[\w+.-]*://[^/?#]*)", 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^\w[\w+.-]*://([^/?#]*)", 1)


def _fold_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path."""
    segments = F.split(path, "/")
    tail = F.element_at(segments, -1)
    folded = F.aggregate(
        F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    slash = F.when(tail.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(folded, "/"))
    return F.when(joined == "/", joined).otherwise(F.concat(joined, slash))


def resolve(url: Column, href: Column) -> Column:
    """Absolute URL of a link found on the page at ``url``."""
    origin = site(url)
    scheme = F.regexp_extract(url, r"^(\w[\w+.-]*:)", 1)
    rest = F.substr(url, F.length(origin) + 1)
    path = F.regexp_extract(rest, r"^([^?#]*)", 1)
    no_fragment = F.regexp_extract(url, r"^([^#]*)", 1)
    no_query = F.regexp_extract(url, r"^([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_rest = F.substr(href, F.length(href_path) + 1)
    target = F.when(href.startswith("/"), href_path).otherwise(F.concat(folder, href_path))
    dotted = target.rlike(r"(?:^|/)\.\.?(?:/|$)")
    clean = F.when(dotted, _fold_dots(target)).otherwise(target)
    return (
        F.when(href.rlike(r"^[a-zA-Z][\w+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", url)
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(origin, clean, href_rest))
    )


def canonical(url: Column) -> Column:
    """URL without its fragment: two addresses that differ only there are one page."""
    return F.regexp_extract(url, r"^([^#]*)", 1)


def keep_links(links: DataFrame, containing: str | None = None, without: Iterable[str] = ("redlink",), images: bool = False) -> DataFrame:
    """Link predicates: part of the address, excluded parts, no image links."""
    kept = links
    if containing:
        kept = kept.where(F.col("href").contains(containing))
    for part in without:
        kept = kept.where(~F.col("href").contains(part))
    if not images:
        image_class = F.coalesce(attribute(F.col("attrs"), "class"), F.lit("")).contains("image")
        kept = kept.where(~image_class & ~F.col("body").rlike(r"(?i)<img[\s/>]"))
    return kept


def slug(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def slug_name(url: Column, drop: Iterable[str] = ()) -> Column:
    """Name out of the last path segment: separators to blanks, words dropped, cut at ``(``."""
    name = F.regexp_replace(slug(url), r"%|_|-|#|27s", " ")
    for word in drop:
        name = F.replace(name, F.lit(word), F.lit(""))
    return F.rtrim(F.split_part(name, F.lit("("), F.lit(1)))


def slug_tokens(url: Column) -> Column:
    return F.split(slug(url), "[- ]")


def overlaps(tokens: Column, phrases: Iterable[str]) -> Column:
    """True where a token equals any word of the phrases."""
    words = [w for phrase in phrases for w in phrase.split(" ")]
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words]))


def templated(prefix: str, build: Column | str, url: Column, suffix: str = ".json") -> Column:
    """``prefix/build/<last two path segments>.json``."""
    build = F.lit(build) if isinstance(build, str) else build
    tail = F.array_join(F.slice(F.split(url, "/"), -2, 2), "/")
    return F.concat(F.lit(prefix.rstrip("/") + "/"), build, F.lit("/"), tail, F.lit(suffix))


def distinct_urls(links: DataFrame, column: str = "target", keep_repeats: Column | None = None) -> DataFrame:
    """One row per address. Rows for which ``keep_repeats`` holds are exempt."""
    def once(df: DataFrame) -> DataFrame:
        return df.select(canonical(F.col(column)).alias("url")).distinct()

    if keep_repeats is None:
        return once(links)
    exempt = F.coalesce(keep_repeats, F.lit(False))
    return once(links.where(~exempt)).unionByName(links.where(exempt).select(canonical(F.col(column)).alias("url")))


def frontier_facts(pages: DataFrame) -> DataFrame:
    """Rows ``(url, held)``: every page held and every address it links to, from one scan."""
    links = extract(pages).select(canonical(resolve(F.col("base"), F.col("href"))).alias("url"), F.lit(0).alias("held"))
    held = pages.select(canonical(F.col("url")).alias("url"), F.lit(1).alias("held"))
    return links.unionByName(held)


def settle(facts: DataFrame) -> DataFrame:
    """Addresses seen but not held.

    Distinct and anti-join in one aggregation: it combines on the map side, so an address
    that a third of all links point at still reaches its reducer as one row per task, and
    facts may be merged in any order (a stream does).
    """
    return facts.groupBy("url").agg(F.max("held").alias("held")).where(F.col("held") == 0).select("url")


def frontier(pages: DataFrame) -> DataFrame:
    return settle(frontier_facts(pages))


def per_host(urls: DataFrame) -> DataFrame:
    return urls.groupBy(host(F.col("url")).alias("host")).agg(F.count("*").alias("urls"))


def link_edges(pages: DataFrame, containing: str | None = None) -> DataFrame:
    """Distinct ``(src, dst)`` pairs of the link graph."""
    links = extract(pages)
    if containing:
        links = links.where(F.col("href").contains(containing))
    return links.select(
        canonical(F.col("url")).alias("src"), canonical(resolve(F.col("base"), F.col("href"))).alias("dst")
    ).distinct()


def reach(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Addresses reached from ``seeds(url)`` with the round each is first seen in.

    Same-kind expansion: each round follows the links of the addresses the last round added
    and the loop ends when a round adds none. The edges are shuffled once, into buckets by
    source, and every round is written in the same buckets by address: a round follows the links
    of the last one where they lie, and is held against all rounds before it where these lie. What
    is shuffled in a round is the addresses it reaches, each once per task at most. Rounds are on
    shared storage, so a lost executor costs the running one only; what the driver sees of a round
    is whether it is empty.
    """
    with Buckets(seeds.sparkSession, "reach") as buckets:
        held = buckets.write(edges.select("src", "dst"), "src")
        rounds = [buckets.write(seeds.select("url").distinct().withColumn("round", F.lit(0)), "url")]
        newest, step = rounds[0], 0
        while not newest.isEmpty():
            step += 1
            found = follow(newest, held, rounds).withColumn("round", F.lit(step))
            newest = buckets.write(found, "url", dealt=True)
            rounds.append(newest)
            if len(rounds) > _COMPACT_ROUNDS:
                rounds = [buckets.write(reduce(lambda a, b: a.unionByName(b), rounds), "url")]
        return reduce(lambda a, b: a.unionByName(b), [buckets.files(r) for r in rounds])


def follow(newest: DataFrame, edges: DataFrame, rounds: Sequence[DataFrame]) -> DataFrame:
    """Addresses one link away from ``newest`` that no round holds."""
    found = newest.select("url").join(edges, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct()
    for before in rounds:
        found = found.join(before.select("url"), "url", "left_anti")
    return found
