"""The parse pass: HTML text to flat node rows, the one step that runs in Python.

Everything after it is DataFrame work. The pass reads ``(page_id, html)`` batches and writes
one row per element of the wanted kinds, so filters on pages belong in front of it and
filters on elements go in as ``tags``: neither can move through it by itself.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tablewright.session import stage

# The parse pass travels to the executors with its task: they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = (
    "page_id bigint, node_id int, end_id int, parent_id int, pos int, tag string, "
    "attrs map<string,string>, lines array<string>, table_id int, row_idx int, col_idx int, top_id int, row_span int, col_span int"
)
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("node_id", pa.int32()),
        ("end_id", pa.int32()),
        ("parent_id", pa.int32()),
        ("pos", pa.int32()),
        ("tag", pa.string()),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("lines", pa.list_(pa.string())),
        ("table_id", pa.int32()),
        ("row_idx", pa.int32()),
        ("col_idx", pa.int32()),
        ("top_id", pa.int32()),
        ("row_span", pa.int32()),
        ("col_span", pa.int32()),
    ]
)
# What waits before it is handed on: rows, and characters of their texts.
_FLUSH_ROWS, _FLUSH_CHARS = 20_000, 16 << 20

# One token of markup. Script and style come with their whole text, as nothing in it is markup.
# Quotes count after an equals sign only, so a stray one does not swallow the page; no part can
# run past the next "<" outside quotes, so broken pages still take one pass. Bare tags that repeat the
# one before them, as in deep nesting, come with it in one piece.
_ATTRIBUTES = r"((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)"
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^<>]*>"
    r"|<(script|style)\b" + _ATTRIBUTES + r">(.*?)(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][\w:-]*)" + _ATTRIBUTES + r">((?:<(?-i:\4\5)>)*+)",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# The largest spans of a cell that HTML knows.
_MOST_ROWS, _MOST_COLUMNS = 65534, 1000
_SPAN = re.compile(r"\s*\+?0*(\d{1,9})")

# HTML element kinds that decide how tags nest.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details div dl dd dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
_HEADS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# What an opening tag closes, and the tags beyond which it must not look.
_IMPLIED = {
    "li": (("li",), ("ul", "ol", "table")),
    "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}
_P_SCOPE = frozenset(("table", "tbody", "tr", "td", "th", "li", "dd", "div", "article", "section", "body", "#root"))
# Elements whose text is handed on, in the pieces in which it is written.
TEXT_TAGS = frozenset(
    "h1 h2 h3 h4 h5 h6 p li a td th dt dd dl b span caption title script ul".split()
)


class _Text:
    """Pieces of text in document order, of the page or of one table, and how many open elements want them."""

    __slots__ = ("pieces", "readers")

    def __init__(self):
        self.pieces: list[str] = []
        self.readers = 0


class _Open:
    """One open element while a page is read; its text begins at piece ``first`` of ``around``.

    It also stands for the ``outer`` elements right around it that are of its kind, hold nothing else
    up to it and are not wanted: their numbers are those before its own.
    """

    __slots__ = ("tag", "node_id", "at", "children", "inside", "around", "first", "table", "tr", "td", "top", "outer")

    def __init__(self, tag, node_id, at, inside, around, first, table, tr, td, top):
        self.tag, self.node_id, self.at = tag, node_id, at
        self.inside, self.around, self.first = inside, around, first
        self.table, self.tr, self.td, self.top = table, tr, td, top
        self.children = self.outer = 0


class _Grid:
    """The rows of one table as they come, and which of their columns are taken by cells from above.

    Taken columns are kept as ranges with the last row they reach, so a span costs the same
    whatever it claims. Rows of a group (``tbody`` and the like) end all spans of the group.
    """

    __slots__ = ("node_id", "row", "group", "col", "at", "held", "fresh", "expires", "tall", "wide", "width")

    def __init__(self, node_id: int):
        self.node_id, self.row, self.group = node_id, -1, None
        self.col = self.at = self.width = 0
        self.held: list[tuple[int, int, int]] = []
        self.fresh: list[tuple[int, int, int]] = []
        self.expires = -1
        # Cells that span rows of this group, and those that span columns: place among the nodes, row or column.
        self.tall: list[tuple[int, int]] = []
        self.wide: list[tuple[int, int]] = []

    def open_row(self, group: int, row_spans: list) -> None:
        if group != self.group:
            self.close_group(row_spans)
            self.group = group
        self.row += 1
        self.col = self.at = 0
        if self.fresh or (self.held and self.expires < self.row):
            merged: list[tuple[int, int, int]] = []
            for first, end, last in sorted([h for h in self.held if h[2] >= self.row] + [h for h in self.fresh if h[2] >= self.row]):
                if merged and merged[-1][1] == first and merged[-1][2] == last:
                    first = merged.pop()[0]
                merged.append((first, end, last))
            self.held, self.fresh = merged, []
            self.expires = min((h[2] for h in merged), default=-1)

    def place(self, rows: int, columns: int) -> tuple[int, int]:
        """Column of the next cell of the row, and how many it takes: up to those taken from above."""
        held = self.held
        while self.at < len(held) and held[self.at][0] <= self.col:
            self.col = max(self.col, held[self.at][1])
            self.at += 1
        col = self.col
        if self.at < len(held):
            columns = min(columns, held[self.at][0] - col)
        self.col += columns
        self.width = max(self.width, col + 1)
        if rows > 1:
            self.fresh.append((col, col + columns, self.row + rows - 1))
        return col, columns

    def close_group(self, row_spans: list) -> None:
        """Spans end at the last row of their group."""
        for place, row in self.tall:
            row_spans[place] = min(row_spans[place], self.row - row + 1)
        self.tall, self.held, self.fresh, self.expires = [], [], [], -1

    def close(self, row_spans: list, col_spans: list) -> None:
        """Spans end at the last column in which a cell of the table begins."""
        self.close_group(row_spans)
        for place, col in self.wide:
            col_spans[place] = max(1, min(col_spans[place], self.width - col))
        self.wide = []


def _span(text: str | None, most: int, zero: int) -> int:
    found = _SPAN.match(text or "")
    return min(int(found[1]) or zero, most) if found else 1


class Columns:
    """Node columns of any number of pages, in the order of the schema."""

    def __init__(self) -> None:
        self.values: list[list] = [[] for _ in _ARROW]
        self.chars = 0

    def __len__(self) -> int:
        return len(self.values[0])

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(v, f.type) for v, f in zip(self.values, _ARROW)]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

    def rows(self) -> list[tuple]:
        return list(zip(*self.values))


def _attributes(text: str) -> list[tuple[str, str]]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), entities.unescape(value) if "&" in value else value)
    return list(found.items())


def _nearest(depths: dict[str, list[int]], tags, stop) -> int:
    """Depth of the innermost open element of ``tags`` above the nearest of ``stop``, or 0."""
    found = max((depths[t][-1] for t in tags if depths.get(t)), default=0)
    return found if found > max((depths[t][-1] for t in stop if depths.get(t)), default=0) else 0


def read_page(page_id: int, source: str, out: Columns, wanted: frozenset[str] | None = None) -> None:
    """Append the nodes of one page, those of the ``wanted`` tags only.

    ``node_id`` counts elements in document order and ``end_id`` is the id of the last element
    inside, so "x is inside y" reads ``y.node_id < x.node_id <= y.end_id``. ``table_id`` is the
    innermost table around a node and ``top_id`` the outermost, a table counting as its own.
    ``col_idx`` is the column of the grid that a cell begins in, past those that cells from above
    take; ``row_span`` and ``col_span`` tell how far it reaches, within its table.
    """
    page_ids, node_ids, end_ids, parents, places, tags, attributes, texts, tables, table_rows, table_cols, tops, row_spans, col_spans = out.values
    whole = _Text()
    stack = [_Open("#root", 0, -1, whole, whole, -1, None, None, None, None)]
    # Depths at which each tag is open, so that the nearest is one look-up however deep a page nests.
    depths: dict[str, list[int]] = {}
    counter = 0

    def close_last(count: int) -> int:
        """Close so many of the elements that the innermost entry stands for, as far as it goes; how many are left to close."""
        top = stack[-1]
        if count > top.outer:
            left = count - top.outer - 1
            close_to(len(stack) - 1)
            return left
        top.outer -= count
        top.node_id -= count
        top.children = 1
        return 0

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            gone = stack.pop()
            depths[gone.tag].pop()
            if gone.tag == "table":
                gone.table.close(row_spans, col_spans)
            if gone.at >= 0:
                end_ids[gone.at] = counter
                if gone.first >= 0:
                    lines = texts[gone.at] = gone.around.pieces[gone.first :]
                    gone.around.readers -= 1
                    out.chars += sum(map(len, lines))

    # Pieces come as text, then the groups of the token that follows it.
    pieces = _MARKUP.split(source)
    last = len(pieces) - 1
    for at in range(0, last + 1, 8):
        text = pieces[at]
        if text:
            inside = stack[-1].inside
            if inside.readers:
                inside.pieces.append(entities.unescape(text) if "&" in text else text)
        if at == last:
            break
        raw, raw_attrs, raw_text, closing, tag, attrs, again = pieces[at + 1 : at + 8]
        if raw is not None:
            tag, attrs = raw, raw_attrs
        elif tag is None:
            continue
        # How many bare tags that repeat this one come with it.
        more = len(again) // (len(tag) + (3 if closing else 2)) if again else 0
        tag = tag.lower()
        if closing:
            left = more + 1
            while left:
                depth = len(stack) - 1 if stack[-1].tag == tag else _nearest(depths, (tag,), () if tag == "table" else ("table",))
                if not depth:
                    break
                close_to(depth + 1)
                left = close_last(left)
            continue
        for repeat in range(more, -1, -1):
            if repeat < more:
                attrs = ""
            top = stack[-1]
            if top.tag not in _P_SCOPE and tag in _CLOSES_P:
                depth = _nearest(depths, ("p",), _P_SCOPE)
                if depth:
                    close_to(depth)
            rule = _IMPLIED.get(tag)
            if rule is not None:
                if top.tag not in rule[1]:
                    depth = _nearest(depths, *rule)
                    if depth:
                        close_to(depth)
            elif tag in _HEADS and stack[-1].tag in _HEADS:
                close_to(len(stack) - 1)

            parent = stack[-1]
            parent.children += 1
            counter += 1
            table, tr, td, outermost = parent.table, parent.tr, parent.td, parent.top
            rows_over = columns_over = None
            if tag == "tr" and table:
                table.open_row(parent.node_id, row_spans)
                tr, td = table.row, None
            elif (tag == "td" or tag == "th") and tr is not None:
                rows_over = columns_over = 1
                if "span" in attrs.lower():
                    spans = dict(_attributes(attrs))
                    rows_over, columns_over = _span(spans.get("rowspan"), _MOST_ROWS, _MOST_ROWS), _span(spans.get("colspan"), _MOST_COLUMNS, 1)
                td, columns_over = table.place(rows_over, columns_over)
            if outermost is None and tag == "table":
                outermost = counter
            place, first, around = -1, -1, parent.inside
            if wanted is None or tag in wanted:
                place = len(node_ids)
                read = tag in TEXT_TAGS
                page_ids.append(page_id)
                node_ids.append(counter)
                end_ids.append(counter)
                parents.append(parent.node_id)
                places.append(parent.children)
                tags.append(tag)
                attributes.append(_attributes(attrs) if "=" in attrs else ())
                texts.append([] if read else None)
                tables.append(table.node_id if table else None)
                table_rows.append(tr)
                table_cols.append(td)
                tops.append(outermost)
                row_spans.append(rows_over)
                col_spans.append(columns_over)
                if rows_over is not None and rows_over > 1:
                    table.tall.append((place, tr))
                if columns_over is not None and columns_over > 1:
                    table.wide.append((place, td))
                if read and tag not in _VOID:
                    first = len(around.pieces)
                    around.readers += 1
            if tag in _VOID:
                continue
            if raw is not None and around.readers:
                around.pieces.append(raw_text)
            # Text of an inner table stays out of the outer cell.
            inside = _Text() if tag == "table" else around
            depths.setdefault(tag, []).append(len(stack))
            if tag == "table":
                table, tr, td = _Grid(counter), None, None
            stack.append(_Open(tag, counter, place, inside, around, first, table, tr, td, outermost))
            if raw is not None:
                close_to(len(stack) - 1)
            if repeat and place < 0 and tag not in _IMPLIED and tag not in _HEADS and tag != "table" and (tag in _P_SCOPE or tag not in _CLOSES_P):
                # Nothing is closed by the others and nobody wants them: one entry stands for all.
                inner = stack[-1]
                inner.outer = repeat
                inner.node_id += repeat
                counter += repeat
                break
    close_to(1)


def nodes(pages: DataFrame, tags: Iterable[str] | None = None) -> DataFrame:
    """Parse ``pages(page_id, html)`` into node rows, of the given ``tags`` only."""
    wanted = frozenset(tags) if tags is not None else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = Columns()
        for batch in batches:
            for page_id, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                if source.is_valid:
                    read_page(page_id, source.as_py(), pending, wanted)
                if len(pending) >= _FLUSH_ROWS or pending.chars >= _FLUSH_CHARS:
                    yield pending.batch()
                    pending = Columns()
        if len(pending):
            yield pending.batch()

    return _with_text(pages.select(F.col("page_id").cast("bigint"), "html").mapInArrow(parse, NODE_SCHEMA))


def _with_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text", F.array_join("lines", ""))


def stored_nodes(pages: DataFrame, tags: Iterable[str], label: str) -> DataFrame:
    """Node rows written to shared storage, for jobs that read them more than once."""
    return _with_text(stage(nodes(pages, tags).drop("text"), label))


def cells_of(node_rows: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Cells of all tables among node rows, in long form; rows count from 0 within their table.

    A cell that spans rows or columns is in each of them, ``col_span`` being its own width. Spans
    reach no further than their table, so there are as many rows here as the table has places.
    """
    found = node_rows.where(F.col("tag").isin("td", "th") & F.col("table_id").isNotNull()).select(
        "page_id",
        "table_id",
        "row_idx",
        "col_idx",
        (F.col("tag") == "th").alias("is_header"),
        F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"),
        "lines",
        "row_span",
        "col_span",
        *keep,
    )
    over = lambda span: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(span), F.lit(1)) - 1))
    rows = found.withColumn("_down", over("row_span")).withColumn("row_idx", F.col("row_idx") + F.col("_down")).drop("_down", "row_span")
    return rows.withColumn("_right", over("col_span")).withColumn("col_idx", F.col("col_idx") + F.col("_right")).drop("_right")


def cells(pages: DataFrame) -> DataFrame:
    """Cells of every table of every page. Pages without a table never reach the parser."""
    return cells_of(nodes(pages.where(F.col("html").rlike(r"(?i)<t[dh]\b")), ("td", "th")))
