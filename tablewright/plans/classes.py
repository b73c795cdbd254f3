"""JSON documents, one per class -> class facts, union effects, main and second weapons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.numbers import flat_by_word, tier_values
from tablewright.functions.text import before, bucket_special, capitalize, replace_each
from tablewright.operators.details import linked_pages
from tablewright.operators.links import attribute, canonical, extract, overlaps, resolve, slug_tokens, templated
from tablewright.operators.rename import rename_exact
from tablewright.operators.reshape import dedupe_rows
from tablewright.rules import RulePack
from tablewright.session import stage
from tablewright.sources.corpus import json_fields, script_json

# What names the links to classes and the script with the number of the build; shape of a class document.
CLASS_ANCHOR, BUILD_SCRIPT = "hvr-float", "__NEXT_DATA__"
CLASS_DOCUMENT = (
    "pageProps struct<post: struct<class: string, content: struct<legion: string, legionValue: string, "
    "classGroup: string, jobGroup: string, mainStat: string, secondaryStat: string, "
    "equipment: array<struct<weapon: array<string>, secondary: array<string>>>>>>"
)


def class_links(links: DataFrame, column: str = "href", rules: RulePack = RulePack()) -> DataFrame:
    """Links to class pages, without those of excluded classes."""
    return links.where(~overlaps(slug_tokens(F.col(column)), rules.excluded_class_phrases))


def class_addresses(pages: DataFrame, prefix: str, rules: RulePack = RulePack()) -> DataFrame:
    """Addresses ``(page_id, link)`` of the documents of all classes that list pages link to, each once per page.

    Links to classes are anchors of their own class. Where their documents lie depends on the build
    that a page names in a script; pages that name none, or hold no such anchor, have no addresses.
    """
    # Both tests come before any anchor is taken apart.
    listing = pages.where(F.col("html").contains(CLASS_ANCHOR) & F.col("html").contains(BUILD_SCRIPT))
    builds = listing.select(F.col("page_id").alias("_page"), script_json(F.col("html"), BUILD_SCRIPT, "$.buildId").alias("build")).where("build IS NOT NULL")
    # Names are judged as written: resolving reads an address many times, and a filter on the result would do it again.
    named = class_links(extract(listing).where(attribute(F.col("attrs"), "class") == CLASS_ANCHOR), rules=rules)
    kept = named.select("page_id", canonical(resolve(F.col("base"), F.col("href"))).alias("target")).distinct()
    return kept.join(builds, F.col("page_id") == F.col("_page")).select("page_id", templated(prefix, F.col("build"), F.col("target")).alias("link"))


def class_jobs(pages: DataFrame, prefix: str, only: Iterable[str] = (), rules: RulePack = RulePack()) -> dict[str, DataFrame]:
    """From stored pages to the tables of ``class_tables``, and ``Missing``: addresses of documents that are not held.

    ``pages`` holds the list pages and, as ``html``, the JSON documents they lead to; it may be a
    page store, and then documents that no list page leads to are not read. Addresses are written
    once. Of several pages with one address the one with the smallest id counts.
    """
    links = stage(class_addresses(pages, prefix, rules).select("link").distinct(), "class-addresses")
    documents = stage(linked_pages(pages, links).select("url", F.col("html").alias("text")), "class-documents")
    found = class_tables(documents, rules=rules)
    missing = links.join(documents.select("url"), F.col("link") == F.col("url"), "left_anti").select(F.col("link").alias("url"))
    return {name: df for name, df in {**found, "Missing": missing}.items() if not only or name in set(only)}


def class_tables(documents: DataFrame, text: str = "text", rules: RulePack = RulePack()) -> dict[str, DataFrame]:
    post = json_fields(documents, text, CLASS_DOCUMENT, []).select("doc.pageProps.post.*")
    read = post.where(F.col("class").isNotNull()).select(F.trim(replace_each(F.col("class"), [","])).alias("ClassName"), "content.*")
    effect = before(replace_each(F.col("legion"), ["%", ","]), "(")
    read = read.withColumns({"UnionEffect": effect, "UnionStatType": flat_by_word(F.col("legion"))})
    tiers = tier_values(F.col("legionValue"))
    character = read.select(
        "ClassName",
        F.rtrim(before(F.col("classGroup"), "(")).alias("Faction"),
        bucket_special(F.col("jobGroup"), "+").alias("ClassType"),
        bucket_special(F.col("mainStat"), ",").alias("MainStat"),
        bucket_special(F.col("secondaryStat"), "+").alias("SecStat"),
        "UnionEffect",
        "UnionStatType",
    )
    union = read.select(
        F.col("UnionEffect").alias("Effect"), F.col("UnionStatType").alias("EffectType"), *[tiers[t].alias(t) for t in ("B", "A", "S", "SS", "SSS")]
    )
    listed = lambda i, field, name: read.select(
        "ClassName", F.explode(F.get("equipment", F.lit(i))[field]).alias(name)
    ).withColumn(name, capitalize(F.col(name)))
    return {
        "CharacterData": character,
        "UnionEffect": dedupe_rows(union),
        "ClassMainWeapon": rename_exact(listed(0, "weapon", "Weapon"), "Weapon", rules.main_weapon_names),
        "ClassSecWeapon": rename_exact(listed(1, "secondary", "Secondary"), "Secondary", rules.second_weapon_names),
    }
