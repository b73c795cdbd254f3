"""From node and cell rows to records: headings, sections, headers, tabs, boxes and prose.

Every window here is bounded by one page, which is one row of the corpus and therefore fits
one task. ``by_page`` co-locates the rows of a page once; the windows that follow reuse it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.functions.numbers import plus_entries
from tablewright.functions.records import overlay, to_map
from tablewright.functions.text import contains_any
from tablewright.session import stage

HEADS = ("h1", "h2", "h3", "h4", "h5")


def by_page(rows: DataFrame) -> DataFrame:
    return rows.repartition("page_id")


def _page_order() -> Window:
    return Window.partitionBy("page_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)


def _sibling_order() -> Window:
    return Window.partitionBy("page_id", "parent_id").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)


def inside(region: Column) -> Column:
    """True for nodes within any node for which ``region`` holds (or that node itself)."""
    return F.max(F.when(region, F.col("end_id"))).over(_page_order()) >= F.col("node_id")


def seen_before(mark: Column) -> Column:
    """True from the first marked sibling on."""
    return F.coalesce(F.max(mark).over(_sibling_order()), F.lit(False))


def running_count(mark: Column) -> Column:
    """How many marked siblings there are up to here."""
    return F.sum(F.coalesce(mark, F.lit(False)).cast("int")).over(_sibling_order())


def last_so_far(value: Column, *within: str) -> Column:
    """Last value that is not null among the siblings up to here, restarted per ``within``."""
    order = Window.partitionBy("page_id", "parent_id", *within).orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(order)


def after_colon(c: Column) -> Column:
    return F.split_part(c, F.lit(":"), F.lit(-1))


def holds(mark: Column) -> Column:
    """True for nodes with a marked node inside them: the nearest one ahead lies within."""
    backwards = Window.partitionBy("page_id").orderBy(F.desc("node_id")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.last(F.when(mark, F.col("node_id")), ignorenulls=True).over(backwards)
    return F.coalesce(ahead <= F.col("end_id"), F.lit(False))


def has_class(name: str) -> Column:
    return F.coalesce(F.col("attrs")["class"], F.lit("")).contains(name)


def with_headings(nodes: DataFrame, kinds: Iterable[str] = HEADS, value: str = "text") -> DataFrame:
    """Nearest preceding sibling heading of each kind; a later ``h2`` does not reset ``h3``."""
    order = _sibling_order()
    return nodes.withColumns(
        {k: F.last(F.when(F.col("tag") == k, F.col(value)), ignorenulls=True).over(order) for k in kinds}
    )


def with_sections(
    nodes: DataFrame,
    section: str = "h4",
    title: str = "h3",
    skip_at: str = "h5",
    ignored: Iterable[str] = (),
    stop_text: str | None = None,
    stop_title: str | None = None,
    drop: bool = True,
) -> DataFrame:
    """Walk sibling blocks in order and label each with its title and section.

    A ``section`` heading opens a section unless its id names an ignored one; ``skip_at`` ends
    it; both hold until the next section heading. Blocks from the sentinel on (a ``skip_at``
    heading whose id has ``stop_text`` under ``stop_title``) are skipped too. Headings are
    labelled by their anchor id, in ``label``. ``drop=False`` keeps skipped blocks, flagged.
    """
    order = _sibling_order()
    label = F.col("label")
    opens = (F.col("tag") == section) & ~contains_any(label, ignored)
    shuts = ((F.col("tag") == section) & contains_any(label, ignored)) | (F.col("tag") == skip_at)
    out = nodes.withColumns(
        {
            "title": F.last(F.when(F.col("tag") == title, label), ignorenulls=True).over(order),
            "section": F.last(F.when(F.col("tag") == section, label), ignorenulls=True).over(order),
            "skipped": F.coalesce(F.last(F.when(opens, F.lit(False)).when(shuts, F.lit(True)), ignorenulls=True).over(order), F.lit(False)),
        }
    )
    if stop_text:
        sentinel = (F.col("tag") == skip_at) & label.contains(stop_text)
        if stop_title:
            sentinel = sentinel & (F.col("title") == stop_title)
        past = F.coalesce(F.max(sentinel).over(order), F.lit(False))
        out = out.withColumn("skipped", F.col("skipped") | past)
    return out.where(~F.col("skipped")).drop("skipped") if drop else out


def enclosing(blocks: Column, *carried: str) -> Column:
    """Struct of the ``carried`` columns of the block a node lies in, or null.

    ``blocks`` tells the blocks apart from other nodes; they must not lie in one another.
    """
    last = F.last(F.when(blocks, F.struct("node_id", "end_id", *carried)), ignorenulls=True).over(_page_order())
    return F.when(last["end_id"] >= F.col("node_id"), last)


def outside_tables(nodes: DataFrame) -> DataFrame:
    """Headings, notes and top-level tables: the few rows a walk over a page needs."""
    return nodes.where(F.col("table_id").isNull())


def block_rows(nodes: DataFrame, blocks: DataFrame, *carried: str) -> DataFrame:
    """All rows of the tables in ``blocks``, with a struct ``block`` of the ``carried`` columns.

    ``blocks`` are top-level table rows out of a walk. They are put next to the rows inside
    them, and one window per table hands the struct on; rows of other tables are dropped.
    """
    columns = [c for c in nodes.columns if c != "text"]
    marked = blocks.select(*columns, "text", F.struct("node_id", *carried).alias("block"))
    others = nodes.where(F.col("top_id").isNotNull() & (F.col("node_id") != F.col("top_id"))).select(*columns, "text")
    together = by_page(marked.unionByName(others, allowMissingColumns=True))
    handed = F.max("block").over(Window.partitionBy("page_id", "top_id"))
    return together.withColumn("block", handed).where(F.col("block").isNotNull())


def heading_labels(nodes: DataFrame) -> DataFrame:
    """Adds ``label`` and ``headline`` to headings: id and text of their headline anchor.

    Without an anchor the heading's own id and text serve. Expects the ``span`` nodes too.
    """
    # Read backwards, the nearest following anchor is the last one seen: a running frame costs
    # one step per row, a frame that reaches to the end would cost one step per pair of rows.
    backwards = Window.partitionBy("page_id").orderBy(F.desc("node_id")).rowsBetween(Window.unboundedPreceding, 0)
    anchor = (F.col("tag") == "span") & has_class("headline")
    found = F.struct(F.col("node_id").alias("n"), F.col("attrs")["id"].alias("id"), F.col("text").alias("text"))
    following = F.last(F.when(anchor, found), ignorenulls=True).over(backwards)
    own = F.when(following["n"] <= F.col("end_id"), following)
    heading = F.col("tag").isin(*HEADS)
    return nodes.withColumns(
        {
            "label": F.when(heading, F.coalesce(own["id"], F.col("attrs")["id"], F.col("text"))),
            "headline": F.when(heading, F.coalesce(own["text"], F.col("text"))).otherwise(F.col("text")),
        }
    )


def classify_blocks(nodes: DataFrame, head: str = "h5", drop: bool = True) -> DataFrame:
    """Blocks under each heading, with tables told apart by what stands before them.

    A table that directly follows a ``dl`` lists chances; any other lists values. Needs all
    element children of the parent among the nodes. ``drop=False`` keeps the nodes without a
    heading before them, with ``block`` 0.
    """
    order = Window.partitionBy("page_id", "parent_id").orderBy("node_id")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.lag("tag").over(order)
    kind = F.when(F.col("tag") == "table", F.when(previous == "dl", F.lit("chance")).otherwise(F.lit("value"))).when(
        F.col("tag") == head, F.lit("heading")
    ).otherwise(F.lit("note"))
    out = nodes.withColumns(
        {
            "block": F.sum((F.col("tag") == head).cast("int")).over(running),
            "heading": F.last(F.when(F.col("tag") == head, F.col("text")), ignorenulls=True).over(running),
            "kind": kind,
        }
    )
    return out.where(F.col("block") > 0) if drop else out


def row_arrays(cells: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """One row per table row: its cell texts in column order. A row of a table is bounded by its page."""
    return (
        cells.groupBy("page_id", "table_id", "row_idx", *keep)
        .agg(
            F.sort_array(F.collect_list(F.struct("col_idx", "text", "lines"))).alias("cells"),
            F.every("is_header").alias("all_header"),
        )
        .withColumn("texts", F.transform("cells", lambda c: c["text"]))
    )


def with_header(cells: DataFrame) -> DataFrame:
    """Attach the column's header text to each data cell and drop header rows.

    The header is the first row of a table that is all header cells; later rows that repeat
    it are dropped with it. Where a header cell spans columns and further header rows follow at
    once, each column is named by the first of them that names it alone. Windows over the cells
    of a page, no join.
    """
    table = Window.partitionBy("page_id", "table_id")
    row = Window.partitionBy("page_id", "table_id", "row_idx")
    column = Window.partitionBy("page_id", "table_id", "col_idx")
    flagged = cells.withColumn("head_row", F.every("is_header").over(row))
    first_head = F.min(F.when(F.col("head_row"), F.col("row_idx"))).over(table)
    flagged = flagged.withColumn("head_at", first_head)
    header = F.max(F.when(F.col("row_idx") == F.col("head_at"), F.col("text"))).over(column)
    if "col_span" in cells.columns:
        flagged = flagged.withColumn("head_end", F.min(F.when(~F.col("head_row") & (F.col("row_idx") > F.col("head_at")), F.col("row_idx"))).over(table))
        leading = F.col("head_row") & (F.col("head_end").isNull() | (F.col("row_idx") < F.col("head_end")))
        alone = F.min(F.when(leading & (F.col("col_span") == 1), F.struct("row_idx", "text"))).over(column)
        header = F.coalesce(alone["text"], header)
    return flagged.withColumn("header", header).where(~F.col("head_row")).drop("head_row", "head_at", "head_end")


def drop_noise_rows(cells: DataFrame, markers: Iterable[str] = ()) -> DataFrame:
    """Drop empty rows, rows equal to the header and rows that name another region."""
    row = Window.partitionBy("page_id", "table_id", "row_idx")
    noisy = contains_any(F.col("text"), markers)
    out = cells.withColumns(
        {
            "row_empty": F.every(F.col("text") == "").over(row),
            "row_noise": F.some(noisy).over(row),
            "row_repeat": F.every(F.coalesce(F.col("text") == F.col("header"), F.lit(False))).over(row),
        }
    )
    return out.where(~F.col("row_empty") & ~F.col("row_noise") & ~F.col("row_repeat")).drop("row_empty", "row_noise", "row_repeat")


def cell_values(text: Column) -> Column:
    """Empty cells count as absent."""
    return F.nullif(text, F.lit(""))


def records(cells: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Zip headers and cells of each row into a map ``fields``; of equal headers the last wins."""
    row = ["page_id", "table_id", "row_idx", *keep]
    named = cells.where(F.col("header").isNotNull() & (F.col("header") != ""))
    per_field = named.groupBy(*row, "header").agg(F.max_by("text", "col_idx").alias("text"))
    return per_field.groupBy(*row).agg(F.map_from_entries(F.collect_list(F.struct("header", "text"))).alias("fields"))


def record_columns(cells: DataFrame, wanted: dict[str, str], keep: Iterable[str] = (), other: str | None = None) -> DataFrame:
    """Known headers as columns: ``wanted`` maps header text to column name. One aggregation.

    Of equal headers the last wins. With ``other`` no field is lost: the headers that are not
    known go to a map column of that name.
    """
    known = F.col("header").isin(*wanted)
    others = []
    if other is None:
        cells = cells.where(known)
    else:
        cells = cells.where(F.col("header").isNotNull())
        rest = F.sort_array(F.collect_list(F.when(~known & (F.col("header") != ""), F.struct("col_idx", F.col("header").alias("key"), F.col("text").alias("value")))))
        others = [to_map(rest).alias(other)]
    return cells.groupBy("page_id", "table_id", "row_idx", *keep).agg(
        *[F.max_by(F.when(F.col("header") == h, F.col("text")), F.when(F.col("header") == h, F.col("col_idx"))).alias(c) for h, c in wanted.items()],
        *others,
    )


def further_fields(cells: DataFrame, table: str, wanted: dict[str, str], keep: Iterable[str] = ()) -> DataFrame:
    """Rows of a table with fixed columns that have further fields: ``(Table, *keep, Of, Other)``.

    ``Of`` is the text of the first column wanted, which names the row; ``Other`` maps header to text.
    """
    rows = record_columns(cells, wanted, keep, other="Other").where(F.size("Other") > 0)
    return rows.select(F.lit(table).alias("Table"), *keep, F.col(f"`{next(iter(wanted.values()))}`").alias("Of"), "Other")


def canonical_header(h: Column) -> Column:
    """Header text to field name.

    ``Chance (Success)`` is named by the word in parentheses, a level column loses its note,
    a cost column ends in ``Cost`` and the overall stat is an effect.
    """
    inner = F.regexp_extract(h, r"\(([^)]*)\)", 1)
    outer = F.trim(F.split_part(h, F.lit("("), F.lit(1)))
    return (
        F.when(h.contains("Level") & h.contains("("), outer)
        .when(h.contains("Cost"), F.concat_ws(" ", F.nullif(F.trim(F.split_part(h, F.lit("Cost"), F.lit(1))), F.lit("")), F.lit("Cost")))
        .when(h == "Overall Stat", F.lit("Overall Effect"))
        .when(h.contains("("), F.trim(inner))
        .otherwise(h)
    )


def numbered(nodes: DataFrame) -> DataFrame:
    """``pos`` counts the given nodes of a page from 0, in document order."""
    return nodes.withColumn("pos", F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")) - 1)


def align_tabs(titles: DataFrame, tables: DataFrame, drop_word: str = "unobtainable") -> DataFrame:
    """Pair the i-th title with the i-th table of a page; the first dropped tab leaves both lists.

    ``titles(page_id, pos, title)`` and ``tables(page_id, pos, ...)`` both count from 0.
    """
    bad = F.lower("title").contains(drop_word)
    marked = titles.withColumn("bad_at", F.min(F.when(bad, F.col("pos"))).over(Window.partitionBy("page_id")))
    kept = marked.where(F.col("bad_at").isNull() | (F.col("pos") != F.col("bad_at"))).withColumn(
        "tab", F.col("pos") - F.when(F.col("pos") > F.col("bad_at"), F.lit(1)).otherwise(F.lit(0))
    )
    return kept.select("page_id", "pos", "tab", "title").join(tables, ["page_id", "pos"])


def infobox(nodes: DataFrame, skip_rows: int = 2, stop_word: str = "recipe", skip_class: str = "collapsible") -> DataFrame:
    """Key/value rows ``(page_id, key, value, seq)`` of the fact boxes on detail pages.

    The first rows of a table are its caption and picture. Tables from the one that opens with
    ``stop_word`` on are not facts. Expects the table, th and td nodes of the pages.
    """
    page = Window.partitionBy("page_id")
    tables = nodes.withColumn("boxed", F.when(F.col("tag") == "table", ~has_class(skip_class)))
    own = Window.partitionBy("page_id", F.when(F.col("tag") == "table", F.col("node_id")).otherwise(F.col("table_id")))
    first_cell = F.min_by(F.when(F.col("tag") != "table", F.col("text")), F.when(F.col("tag") != "table", F.col("node_id"))).over(own)
    boxed = tables.withColumns({"boxed": F.max("boxed").over(own), "opening": first_cell}).where(
        F.col("boxed") & (F.col("tag") != "table")
    )
    stop_at = F.min(F.when(F.lower("opening").contains(stop_word), F.col("table_id"))).over(page)
    facts = boxed.withColumn("stop_at", stop_at).where(
        (F.col("stop_at").isNull() | (F.col("table_id") < F.col("stop_at"))) & (F.col("row_idx") >= skip_rows)
    )
    return (
        facts.groupBy("page_id", "table_id", "row_idx")
        .agg(
            F.min_by(F.when(F.col("tag") == "th", F.get("lines", F.lit(0))), F.when(F.col("tag") == "th", F.col("col_idx"))).alias("key"),
            F.sort_array(F.collect_list(F.when(F.col("tag") == "td", F.struct("col_idx", "lines")))).alias("tds"),
        )
        .where(F.col("key").isNotNull())
        .select(
            "page_id",
            F.trim(F.replace("key", F.lit("\n"), F.lit(""))).alias("key"),
            F.array_join(F.flatten(F.transform("tds", lambda c: c["lines"])), " ").alias("value"),
            (F.shiftleft(F.col("table_id").cast("bigint"), 32) + F.col("row_idx")).alias("seq"),
        )
    )


def overlay_inner(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Copy an outer row's fields onto each row of the table nested in it; the inner row wins.

    ``outer(page_id, table_id, row_idx, fields)`` and
    ``inner(page_id, outer_table, outer_row, inner_row, fields)``. The keys name one row of one
    page on the outer side, so the join never multiplies.
    """
    keyed = outer.select("page_id", F.col("table_id").alias("outer_table"), F.col("row_idx").alias("outer_row"), F.col("fields").alias("common"))
    return inner.join(keyed, ["page_id", "outer_table", "outer_row"], "left").withColumn(
        "fields", F.when(F.col("common").isNull(), F.col("fields")).otherwise(overlay(F.col("common"), F.col("fields")))
    ).drop("common")


def nested_stats(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Outer rows and the rows of tables nested in them, each with its ``key +value`` lines as a map.

    An outer row holds a label cell and a cell with common stats and, at will, a table of
    level bands: ``outer(page_id, table_id, row_idx, label, fields)`` and
    ``inner(page_id, outer_table, outer_row, inner_row, band, fields)``. Expects table, th, td
    and ul nodes. The own text of an outer cell never holds that of the inner table.
    """
    held = enclosing_row()
    rows = nodes.withColumn("held", held)
    cells = rows.where((F.col("tag") == "td"))
    plus = lambda lines: to_map(plus_entries(lines))
    per_row = cells.groupBy("page_id", "table_id", "row_idx", "held").agg(
        F.max(F.when(F.col("col_idx") == 0, F.get("lines", F.lit(0)))).alias("label"),
        F.max(F.when(F.col("col_idx") == 1, F.col("lines"))).alias("stat_lines"),
    )
    stats = per_row.withColumn("fields", plus(F.coalesce("stat_lines", F.array().cast("array<string>"))))
    outer = stats.where(F.col("held").isNull()).select("page_id", "table_id", "row_idx", "label", "fields")
    inner = stats.where(F.col("held").isNotNull()).select(
        "page_id",
        F.col("held")["table_id"].alias("outer_table"),
        F.col("held")["row_idx"].alias("outer_row"),
        F.col("row_idx").alias("inner_row"),
        F.col("label").alias("band"),
        "fields",
    )
    return outer, inner


def nested_rows(nodes: DataFrame) -> DataFrame:
    """Rows of all tables with their ``key +value`` lines, and the row each table lies in.

    ``(page_id, table_id, row_idx, label, fields, outer_table, outer_row)``; the last two are missing
    for tables that lie in no other. Expects table, td and th nodes.
    """
    per_row = (
        nodes.withColumn("held", enclosing_row()).where(F.col("tag") == "td").groupBy("page_id", "table_id", "row_idx", "held")
        .agg(
            F.max(F.when(F.col("col_idx") == 0, F.get("lines", F.lit(0)))).alias("label"),
            F.max(F.when(F.col("col_idx") == 1, F.col("lines"))).alias("stat_lines"),
        )
    )
    fields = to_map(plus_entries(F.coalesce("stat_lines", F.array().cast("array<string>"))))
    return per_row.select("page_id", "table_id", "row_idx", "label", fields.alias("fields"), F.col("held.table_id").alias("outer_table"), F.col("held.row_idx").alias("outer_row"))


def inherit_fields(rows: DataFrame) -> DataFrame:
    """``nested_rows`` with the fields of all rows around each row; of equal ones the innermost counts.

    Pointer jumping: in a round a row takes over what its outer row has gathered, and that row's own
    outer row as its next. Rounds are as many as the logarithm of the depth; each is written, as the
    next reads it twice. A row has one outer row, so rows never multiply.
    """
    found = stage(rows, "nested")
    while not found.where(F.col("outer_table").isNotNull()).isEmpty():
        above = found.select(
            "page_id", F.col("table_id").alias("outer_table"), F.col("row_idx").alias("outer_row"),
            F.col("fields").alias("common"), F.col("outer_table").alias("next_table"), F.col("outer_row").alias("next_row"),
        )
        joined = found.join(above, ["page_id", "outer_table", "outer_row"], "left")
        fields = F.when(F.col("common").isNull(), F.col("fields")).otherwise(overlay(F.col("common"), F.col("fields")))
        found = stage(
            joined.select("page_id", "table_id", "row_idx", "label", fields.alias("fields"), F.col("next_table").alias("outer_table"), F.col("next_row").alias("outer_row")), "nested"
        )
    return found.drop("outer_table", "outer_row")


def block_title(rows: DataFrame) -> DataFrame:
    """Title of each labelled block table: ``(page_id, outer_table, Title)``."""
    is_block = (F.col("tag") == "table") & (F.col("node_id") == F.col("block")["node_id"])
    return rows.where(is_block).select("page_id", F.col("node_id").alias("outer_table"), F.col("block")["title"].alias("Title"))


def enclosing_row() -> Column:
    """Outer table and row of the cells of a nested table, or null. Needs the table nodes."""
    own = Window.partitionBy("page_id", F.when(F.col("tag") == "table", F.col("node_id")).otherwise(F.col("table_id")))
    return F.max(F.when((F.col("tag") == "table") & F.col("table_id").isNotNull(), F.struct("table_id", "row_idx"))).over(own)


def prose_names(nodes: DataFrame, on: str = "exclusive", off: Iterable[str] = ("conjunction", "."), skip: Iterable[str] = ()) -> DataFrame:
    """Linked names in running text, between a word that opens the list and one that ends it.

    Expects ``p`` and ``a`` nodes. A paragraph is left at its first closing piece. Names are
    returned once per page, numbered by first appearance.
    """
    order = _page_order()
    para = F.last(F.when(F.col("tag") == "p", F.struct("node_id", "end_id")), ignorenulls=True).over(order)
    placed = nodes.where(F.col("tag").isin("p", "a")).withColumn("para", para).where(
        F.col("node_id") <= F.col("para")["end_id"]
    )
    # A pre-aggregated set of link texts per paragraph, next to its pieces.
    per_para = placed.groupBy("page_id", F.col("para")["node_id"].alias("p_id")).agg(
        F.max(F.when(F.col("tag") == "p", F.col("lines"))).alias("pieces"),
        F.flatten(F.collect_list(F.when(F.col("tag") == "a", F.col("lines")))).alias("linked"),
    )
    opens = lambda s: s.contains(on)
    closes = lambda s: ~s.contains(on) & contains_any(s, off)
    stop = F.coalesce(
        F.array_min(F.filter(F.transform("pieces", lambda s, i: F.when(closes(s), i)), lambda i: i.isNotNull())),
        F.size("pieces"),
    )
    pieces = per_para.withColumn("stop", stop).select(
        "page_id", "p_id", "linked", "stop", F.posexplode("pieces").alias("i", "piece")
    ).where(F.col("i") <= F.col("stop"))
    reading = Window.partitionBy("page_id").orderBy("p_id", "i").rowsBetween(Window.unboundedPreceding, 0)
    state = F.last(F.when(opens(F.col("piece")), F.lit(True)).when(F.col("i") == F.col("stop"), F.lit(False)), ignorenulls=True)
    named = pieces.withColumn("reading", state.over(reading)).where(
        F.col("reading") & ~opens(F.col("piece")) & (F.trim("piece") != "") & F.array_contains("linked", F.col("piece")) & ~contains_any(F.col("piece"), skip)
    )
    firsts = named.groupBy("page_id", F.col("piece").alias("name")).agg(F.min(F.struct("p_id", "i")).alias("first"))
    return firsts.select(
        "page_id", "name", (F.row_number().over(Window.partitionBy("page_id").orderBy("first")) - 1).alias("idx")
    )


def fallback(primary: DataFrame, alternative: DataFrame) -> DataFrame:
    """Rows of the alternative region for those pages on which the first region gave nothing."""
    found = primary.select("page_id").distinct()
    return primary.unionByName(alternative.join(found, "page_id", "left_anti"))
