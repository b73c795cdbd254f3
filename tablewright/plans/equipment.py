"""List pages and their detail pages -> equipment records, renamed, routed and keyed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.records import key_value, level_text
from tablewright.functions.text import clean_lines
from tablewright.operators import details, layout as Y, predicates as P, rename, reshape
from tablewright.operators.links import address, base_named, canonical, extract, reach, resolve, slug, slug_name, with_base
from tablewright.operators.sinks import cast_inferred, destination, save, save_rejects
from tablewright.operators.steps import run_steps
from tablewright.rules import RulePack
from tablewright.session import stage
from tablewright.sources.markup import cells_of, nodes, stored_nodes
from tablewright.specs import TableSpec

# A slot that is not used, classes of the tab boxes, and fields a record starts with.
UNUSED_SLOT = "Totem"
TABBER = "wds-tabber"
TAB_TITLE = "wds-tabs"
LIST_FIELDS = ["EquipSlot", "EquipName", "EquipLevel", "Category", "Destination"]


def slot_index(links: DataFrame, rules: RulePack = RulePack()) -> DataFrame:
    """Slots named by the links of an index page: ``(EquipSlot, link)``."""
    named = links.where(F.col("title").isNotNull() & (F.col("title") != UNUSED_SLOT)).select(
        F.col("title").alias("EquipSlot"), resolve(F.col("base"), F.col("href")).alias("link")
    )
    return rename.lookup_variant(named, "EquipSlot", rules.slot_names, normalise=True)


def type_index(links: DataFrame, rules: RulePack = RulePack(), second: bool = False) -> DataFrame:
    """Weapon types named by the links of an index page, without those of excluded classes."""
    name = F.rtrim(F.split_part(F.regexp_replace(slug(F.col("href")), "_|-", " "), F.lit("("), F.lit(1)))
    gone = [kinds[1 if second else 0] for kinds in rules.excluded_classes.values()]
    found = links.where(F.col("href").contains("/")).select(name.alias("WeaponType"), resolve(F.col("base"), F.col("href")).alias("link"))
    return P.exclude(found, F.lower("WeaponType"), gone)


def slot_corpus(index: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages that list the equipment of the slots in ``index(EquipSlot, link)``, with ``slot``.

    A list page may link to further pages of its slot, by titles that start with the slot and
    a slash; these are followed until no new one turns up. A page that two slots reach goes
    to the first by name.
    """
    # The search follows pairs of slot and address, each written as one JSON text.
    at = lambda slot, url: F.to_json(F.struct(slot.alias("slot"), canonical(url).alias("at")))
    links = extract(pages, text=False).where(F.col("title").contains("/"))
    slot = F.split_part("title", F.lit("/"), F.lit(1))
    edges = links.select(at(slot, F.col("url")).alias("src"), at(slot, resolve(F.col("base"), F.col("href"))).alias("dst")).distinct()
    reached = reach(index.select(at(F.col("EquipSlot"), F.col("link")).alias("url")), edges)
    pair = F.from_json("url", "slot string, at string")
    owner = reached.select(pair["slot"].alias("slot"), pair["at"].alias("_at")).groupBy("_at").agg(F.min("slot").alias("slot"))
    return pages.join(owner, canonical(F.col("url")) == owner["_at"]).drop("_at")


def slot_pages(pages: DataFrame, slot: Column) -> DataFrame:
    """Pages that list the equipment of one slot; pages of no slot are never parsed."""
    return pages.withColumn("slot", slot).where(F.col("slot").isNotNull())


def list_rows(pages: DataFrame, rules: RulePack = RulePack()) -> DataFrame:
    """Rows of the list tables: slot, name, level, tab, link, texts and whether the row is kept.

    Tables inside the tab box are preferred; a page without a tab box gives its other tables.
    """
    read = stored_nodes(pages, ("div", "ul", "li", "table", "td", "th", "a"), "list-nodes")
    rows = Y.by_page(Y.outside_tables(read))
    rows = rows.withColumn("tabbed", F.coalesce(Y.inside((F.col("tag") == "div") & Y.has_class(TABBER)), F.lit(False)))
    rows = rows.withColumn("titles", F.coalesce(Y.inside((F.col("tag") == "ul") & Y.has_class(TAB_TITLE)), F.lit(False)))
    listed = (F.col("tag") == "table") & Y.has_class("wikitable")
    grids = Y.numbered(Y.fallback(rows.where(listed & F.col("tabbed")), rows.where(listed & ~F.col("tabbed"))))
    titles = Y.numbered(rows.where((F.col("tag") == "li") & F.col("titles"))).select("page_id", "pos", F.trim("text").alias("title"))
    untitled = grids.join(titles.select("page_id").distinct(), "page_id", "left_anti").select(
        "page_id", F.col("node_id").alias("table_id"), F.lit("").alias("title")
    )
    titled = Y.align_tabs(titles, grids.select("page_id", "pos", F.col("node_id").alias("table_id"))).select("page_id", "table_id", "title")
    tabs = titled.unionByName(untitled)

    cell = F.col("tag").isin("td", "th")
    picture = Y.has_class("image") | F.coalesce(F.col("attrs")["href"], F.lit("")).contains("redlink")
    href = F.when((F.col("tag") == "a") & ~picture, F.col("attrs")["href"])
    per_row = (
        read.where((cell | (F.col("tag") == "a")) & (F.col("row_idx") > 0))
        .groupBy("page_id", "table_id", "row_idx")
        .agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.when(cell, F.struct("col_idx", "lines")))), lambda c: c["lines"])).alias("raw"),
            F.min_by(href, F.when(href.isNotNull(), F.col("node_id"))).alias("href"),
        )
        .withColumn("texts", F.filter(clean_lines("raw"), lambda t: F.trim(t) != ""))
    )
    located = per_row.join(tabs, ["page_id", "table_id"]).join(with_base(pages.select("page_id", "url", "slot", base_named(F.col("html")).alias("_base"))).drop("url"), "page_id")
    level = F.get(F.filter(F.transform("texts", level_of), lambda v: v.isNotNull()), F.lit(0))
    named = located.select(
        "page_id",
        "table_id",
        "row_idx",
        F.col("slot").alias("EquipSlot"),
        F.translate(F.get("texts", F.lit(0)), ",<>", "").alias("EquipName"),
        level.alias("EquipLevel"),
        F.replace("title", F.lit(","), F.lit(";")).alias("Category"),
        rename.slot_category(F.col("slot"), rules.armor_slots, rules.accessory_slots).alias("Destination"),
        F.when(F.col("href").isNotNull(), resolve(F.col("base"), address(F.col("href")))).alias("link"),
        "texts",
    )
    with_min = P.with_minimum(named, "EquipSlot", rules.slot_min_level)
    return with_min.withColumn(
        "kept", P.row_kept(F.col("EquipName"), F.col("EquipLevel"), F.col("MinimumLevel"), rules.ignored_words)
    ).drop("MinimumLevel")


def level_of(text: Column) -> Column:
    return level_text(F.trim(text))


def _facts(pages: DataFrame, rows: DataFrame, rules: RulePack) -> DataFrame:
    """Facts of the linked detail pages, one map of (key, value, seq) entries per address."""
    wanted = details.linked_pages(pages, rows)
    boxed = Y.infobox(Y.by_page(nodes(wanted, ("table", "th", "td"))))
    kept = boxed.where(~P.key_skipped(F.col("key"), rules.skipped_keys))
    per_page = kept.groupBy("page_id").agg(F.collect_list(F.struct("key", "value", "seq")).alias("facts"))
    return wanted.select("page_id", "url").join(per_page, "page_id", "left").select("url", "facts")


def equipment_records(lists: DataFrame, pages: DataFrame, known: Sequence[str], rules: RulePack = RulePack(), other: str | None = "Other", order: str | None = None) -> DataFrame:
    """Records of all slots with the ``known`` stat fields, renamed and with defaults filled.

    Further fields go to the map ``other`` and are left out only if that is None; ``order`` names a
    column that says where in the lists a record stands.
    """
    return records_of(stage(list_rows(lists, rules), "rows"), pages, known, rules, other, order)


def records_and_counts(lists: DataFrame, pages: DataFrame, known: Sequence[str], rules: RulePack = RulePack(), other: str | None = "Other", order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records as ``equipment_records`` gives them, and per destination how many list rows were seen, skipped and recorded.

    The list pages are parsed once: both come from the rows that the parse has written.
    """
    rows = stage(list_rows(lists, rules), "rows")
    return records_of(rows, pages, known, rules, other, order), reshape.route_counts(rows, F.col("kept"))


def records_of(rows: DataFrame, pages: DataFrame, known: Sequence[str], rules: RulePack, other: str | None, order: str | None) -> DataFrame:
    """``equipment_records`` from the written rows of the list tables."""
    rows = rows.where("kept").drop("kept")
    android = F.col("EquipSlot") == "Android"
    joined = details.join_details(rows, _facts(pages, rows.where(~android), rules), list_only=android)
    own = F.transform(
        F.filter("texts", lambda t: t.contains(":")),
        lambda t, i: F.struct(F.split_part(t, F.lit(":"), F.lit(1)).alias("key"), F.split_part(t, F.lit(":"), F.lit(-1)).alias("value"), i.cast("bigint").alias("seq")),
    )
    list_only = F.col("link").isNull() | android
    facts = F.when(list_only, own).otherwise(F.coalesce("facts", _no_facts()))
    return _assembled(joined.withColumn("facts", facts), ["page_id", "table_id", "row_idx"], LIST_FIELDS, known, rules, other, order)


def _no_facts() -> Column:
    return F.array().cast("array<struct<key:string,value:string,seq:bigint>>")


def _assembled(rows: DataFrame, base: list[str], fields: list[str], known: Sequence[str], rules: RulePack, other: str | None, order: str | None) -> DataFrame:
    """Rows with (key, value, seq) ``facts`` as records: fields named and pivoted, defaults, renames, column order.

    A fact named like one of the ``fields`` that a record starts with is a further field: both are kept.
    """
    long = rows.select(*base, F.explode("facts").alias("f")).select(*base, "f.key", "f.value", "f.seq")
    named = rename.name_fields(long, rules.field_names)
    wide = reshape.pivot_wide(named, base, [k for k in known if k not in fields], other=other)
    whole = rows.select(*base, *fields).join(wide, base, "left")
    if order:
        whole = whole.withColumn(order, F.struct(*base))
    return run_steps(
        whole.drop(*base),
        {
            700: lambda df: reshape.fill_defaults(df, rules.defaults),
            800: lambda df: rename.rename_record(df, rules),
            900: lambda df: reshape.order_columns(df, rules.column_order),
        },
    )


def record_counts(lists: DataFrame, rules: RulePack = RulePack()) -> DataFrame:
    return reshape.route_counts(list_rows(lists, rules), F.col("kept"))


def weapon_links(links: DataFrame, sets: Sequence[str] | None = None, rules: RulePack = RulePack()) -> DataFrame:
    """Links to the weapons of the tracked sets, with name and set; sealed forms are left out."""
    name = slug_name(F.col("href"))
    tracked = F.array_intersect(F.split("EquipName", " "), F.array(*[F.lit(s) for s in (rules.weapon_sets if sets is None else sets)]))
    return (
        links.withColumn("EquipName", name)
        .where(~F.col("EquipName").contains("Sealed"))
        .withColumn("EquipSet", F.get(tracked, F.lit(0)))
        .where(F.col("EquipSet").isNotNull())
        .withColumn("link", resolve(F.col("base"), F.col("href")))
    )


def weapon_records(links: DataFrame, pages: DataFrame, known: Sequence[str], rules: RulePack = RulePack(), other: str | None = "Other", order: str | None = None) -> DataFrame:
    """Records of the weapons that ``links(…, pos, WeaponType)`` name, with the facts of their detail pages."""
    rows = weapon_links(links, rules=rules).select(
        "page_id", "pos", F.lit("Weapon").alias("EquipSlot"), "EquipName", "EquipSet", "WeaponType", F.lit("EquipWeapon").alias("Destination"), "link"
    )
    rows = stage(rows, "weapons")
    joined = details.join_details(rows, _facts(pages, rows, rules))
    fields = ["EquipSlot", "EquipName", "EquipSet", "WeaponType", "Destination"]
    return _assembled(joined.withColumn("facts", F.coalesce("facts", _no_facts())), ["page_id", "pos"], fields, known, rules, other, order)


def secondary_rows(pages: DataFrame, weapon_type: Column, sets: Sequence[str] | None = None, rules: RulePack = RulePack()) -> DataFrame:
    """Second-weapon pages: the i-th class named in the prose owns the i-th table of the page.

    A table ends at a row whose first text speaks of equipment: what follows is not of the class.
    Returns ``(page_id, WeaponType, ClassName, EquipName, header, lines)`` in long form.
    """
    return _secondary_cells(pages, weapon_type, sets, rules).select("page_id", "WeaponType", "ClassName", "EquipName", "header", "lines")


def _secondary_cells(pages: DataFrame, weapon_type: Column, sets: Sequence[str] | None, rules: RulePack) -> DataFrame:
    sets = rules.weapon_sets if sets is None else sets
    rows = stage(Y.by_page(nodes(pages, ("p", "a", "table", "td", "th"))), "secondary")
    names = Y.prose_names(rows, skip=["Shade"]).select("page_id", F.col("idx").alias("pos"), F.translate("name", ",", "").alias("ClassName"))
    typed = pages.select("page_id", weapon_type.alias("WeaponType"))
    # Fixed value: a type whose owner the prose does not link.
    extra = typed.where(F.col("WeaponType") == "Demon Aegis").join(names.groupBy("page_id").agg(F.count("*").alias("n")), "page_id", "left").select(
        "page_id", F.coalesce("n", F.lit(0)).cast("int").alias("pos"), F.lit("Demon").alias("ClassName")
    )
    grids = Y.numbered(rows.where((F.col("tag") == "table") & Y.has_class("wikitable"))).select("page_id", "pos", F.col("node_id").alias("table_id"))
    owned = names.withColumn("pos", F.col("pos").cast("int")).unionByName(extra).join(grids, ["page_id", "pos"]).join(typed, "page_id")
    cells = Y.with_header(cells_of(rows))
    is_first = F.col("col_idx") == 0
    ends = F.min(F.when(is_first & F.lower("text").contains("equipment"), F.col("row_idx"))).over(Window.partitionBy("page_id", "table_id"))
    cells = cells.withColumn("ends", ends).where(F.col("ends").isNull() | (F.col("row_idx") < F.col("ends"))).drop("ends")
    first = cells.where(is_first).select("page_id", "table_id", "row_idx", F.trim(F.translate("text", ",<>", "")).alias("EquipName"))
    values = cells.where((F.col("col_idx") > 0) & F.col("header").isNotNull()).select("page_id", "table_id", "row_idx", "col_idx", "header", "lines")
    found = values.join(first, ["page_id", "table_id", "row_idx"]).join(owned.drop("pos"), ["page_id", "table_id"])
    in_set = F.arrays_overlap(F.split("EquipName", " "), F.array(*[F.lit(s) for s in sets]))
    return found.where((F.col("WeaponType") != "Katara") | in_set)


def secondary_records(pages: DataFrame, weapon_type: Column, known: Sequence[str], rules: RulePack = RulePack(), other: str | None = "Other", order: str | None = None) -> DataFrame:
    """Records of second weapons: lines of requirement and effect columns are fields, other columns one field each."""
    cells = _secondary_cells(pages, weapon_type, None, rules)
    base = ["page_id", "table_id", "row_idx"]
    lines = F.filter(clean_lines("lines"), lambda t: F.trim(t) != "")
    many = F.lower("header").rlike("requirements|effects")
    entry = lambda key, value, seq: F.struct(key.alias("key"), value.alias("value"), seq.cast("bigint").alias("seq"))
    place = lambda i: F.col("col_idx").cast("bigint") * F.lit(1 << 20) + i
    parsed = F.transform(lines, lambda t, i: entry(key_value(t)["key"], key_value(t)["value"], place(i)))
    whole = F.array(entry(F.col("header"), F.array_join(lines, " "), place(F.lit(0))))
    per_cell = cells.withColumn("facts", F.when(many, parsed).otherwise(whole))
    # A row has as many facts as its cells have lines.
    rows = per_cell.groupBy(*base).agg(
        *[F.first(c).alias(c) for c in ("ClassName", "EquipName", "WeaponType")], F.flatten(F.collect_list("facts")).alias("facts")
    )
    rows = rows.withColumns({"EquipSlot": F.lit("Secondary"), "Destination": F.lit("EquipSecondary")})
    return _assembled(rows, base, ["EquipSlot", "ClassName", "EquipName", "WeaponType", "Destination"], known, rules, other, order)


def store_records(
    records: DataFrame, root: str, specs: Mapping[str, TableSpec], seq: str, stats: Sequence[str], rules: RulePack = RulePack(), batch: tuple[str, int] | None = None
) -> dict[str, DataFrame]:
    """Upsert records into the table of their destination and return what the tables then hold.

    Stat fields get the type that all their values have. Records are written once for all tables.
    Those without a destination, or with one that ``specs`` do not name, go to ``Destination_rejects``.
    ``batch`` is committed with each table, so a repeated batch of a stream changes nothing.
    """
    held = stage(records, "records")
    typed = cast_inferred(held, [c for c in stats if c in held.columns])
    save_rejects(typed.where(~F.coalesce(F.col("Destination").isin(*specs), F.lit(False))), f"{root}/Destination_rejects")
    return {name: save(destination(typed, name), spec.named(name), root, seq=seq, defaults=rules.defaults, columns=rules.column_order, batch=batch) for name, spec in specs.items()}
