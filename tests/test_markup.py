"""The parse pass on nested, unclosed and odd markup."""

import time

import pytest
from hypothesis import given, settings, strategies as st

from tablewright.sources.markup import Columns, read_page


def rows(source, wanted=None):
    out = Columns()
    read_page(1, source, out, wanted)
    names = ["page", "id", "end", "parent", "pos", "tag", "attrs", "lines", "table", "row", "col", "top"]
    return [dict(zip(names, r)) for r in out.rows()]


def of(found, tag):
    return [r for r in found if r["tag"] == tag]


def test_cells_without_end_tags():
    cells = of(rows("<table><tr><th>A<th>B<tr><td>1<td>2 &amp; 3</table>"), "td")
    assert [(c["row"], c["col"], c["lines"]) for c in cells] == [(1, 0, ["1"]), (1, 1, ["2 & 3"])]


def test_inner_table_stays_out_of_the_outer_cell():
    found = rows("<table><tr><td>a<table><tr><td>in</td></tr></table>b</td><td>c</td></tr></table>")
    cells = of(found, "td")
    assert [c["lines"] for c in cells] == [["a", "b"], ["in"], ["c"]]
    outer, inner = of(found, "table")
    assert (inner["table"], inner["row"], inner["col"]) == (outer["id"], 0, 0)
    assert [c["table"] for c in cells] == [outer["id"], inner["id"], outer["id"]]
    assert {r["top"] for r in found} == {outer["id"]}


def test_paragraph_closes_over_open_bold():
    found = rows("<p><b>one<br><p>two</p><h2>three")
    assert [(r["tag"], r["parent"]) for r in found if r["tag"] in ("p", "h2")] == [("p", 0), ("p", 0), ("h2", 0)]
    assert [r["lines"] for r in of(found, "p")] == [["one"], ["two"]]


def test_script_is_text():
    found = rows('<div><script id="x">var t="</p><td>&amp;";</script><p>q</p></div>')
    assert of(found, "script")[0]["lines"] == ['var t="</p><td>&amp;";']
    assert not of(found, "td") and of(found, "p")[0]["lines"] == ["q"]


def test_comment_doctype_and_quoted_brackets():
    found = rows("<!DOCTYPE html><!-- <td>no</td> --><a href='x>y' TITLE=\"T\" class=plain>go</a>")
    assert [(r["tag"], r["attrs"]) for r in found] == [("a", [("href", "x>y"), ("title", "T"), ("class", "plain")])]


def test_stray_quotes_and_unfinished_tags():
    found = rows("<p class='it's'>a</p><td>b <c <i title=\"x>y\" alt=\"open>z</i><p>d")
    assert [(r["tag"], r["lines"]) for r in found if r["tag"] == "p"] == [("p", ["a"]), ("p", ["d"])]
    assert of(found, "i")[0]["attrs"][0] == ("title", "x>y")


@pytest.mark.parametrize("piece", ["<a ", "<a b='", "<!", "<!-- ", "<script>", "<a \"", "<td>", "<p><b>", "</x>", "<a href=\"<", "&lt"])
def test_broken_pages_take_one_pass(piece):
    began = time.perf_counter()
    rows(piece * 20_000)
    assert time.perf_counter() - began < 8


def test_lists_and_definition_lists():
    found = rows("<ul><li>a<li>b<ul><li>c</ul></ul><dl><dt>d<dd>e<dt>f</dl>")
    assert [r["parent"] for r in of(found, "li")] == [1, 1, of(found, "ul")[1]["id"]]
    assert [r["lines"] for r in of(found, "dt")] == [["d"], ["f"]]


def test_wanted_tags_keep_their_ids():
    source = "<div><table><tr><td>x</td></tr></table></div>"
    assert rows(source, frozenset(("td",))) == of(rows(source), "td")


def test_deep_nesting_is_bounded():
    began = time.perf_counter()
    found = rows("<b>" * 20_000 + "x" + "</i>" * 20_000 + "<table><tr><td>y")
    assert len(found) == 20_003 and time.perf_counter() - began < 8
    assert rows("<div>" * 600 + "<p>x</p>")[-1]["lines"] == ["x"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/\"'= abtdrph1&;!-", max_size=60))
def test_any_text_can_be_read(source):
    found = rows(source)
    assert [r["id"] for r in found] == list(range(1, len(found) + 1))
    for r in found:
        assert r["parent"] < r["id"] <= r["end"] <= len(found)


@settings(max_examples=100, deadline=None)
@given(st.recursive(st.just("x"), lambda inner: st.lists(inner, min_size=1, max_size=3).map(
    lambda parts: "<table><tr>" + "".join(f"<td>{p}</td>" for p in parts) + "</tr></table>"), max_leaves=8))
def test_nested_tables_are_numbered(source):
    found = rows(source)
    for table in of(found, "table"):
        own = [c for c in of(found, "td") if c["table"] == table["id"]]
        assert [c["col"] for c in own] == list(range(len(own)))
        assert all(table["id"] < c["id"] <= table["end"] for c in own)


@pytest.mark.parametrize("depth", [600, 5000])
def test_deep_cells_are_whole(depth):
    found = rows("<div>" * depth + "<table><tr><td>v<b>w</b></td><td>" + "<i>" * depth + "x" + "</i>" * depth + "y</td></tr></table>", frozenset(("td", "b")))
    assert [(r["tag"], r["row"], r["col"], r["lines"]) for r in found] == [("td", 0, 0, ["v", "w"]), ("b", 0, 0, ["w"]), ("td", 0, 1, ["x", "y"])]


def test_text_goes_to_every_open_element_once():
    found = rows("<li>a<p>b<span>c</span>d</p>e<table><tr><td>f</td></tr></table>g</li>h", frozenset(("li", "p", "span", "td")))
    assert [(r["tag"], r["lines"]) for r in found] == [("li", ["a", "b", "c", "d", "e", "g"]), ("p", ["b", "c", "d"]), ("span", ["c"]), ("td", ["f"])]


def grid_of(source):
    """Text by row and column, every span filled in."""
    found = {}
    for r in rows_with_spans(source):
        for i in range(r["row"], r["row"] + r["rows"]):
            for j in range(r["col"], r["col"] + r["cols"]):
                found[i, j] = "".join(r["lines"])
    return found


def rows_with_spans(source):
    out = Columns()
    read_page(1, source, out, frozenset(("td", "th")))
    names = ["page", "id", "end", "parent", "pos", "tag", "attrs", "lines", "table", "row", "col", "top", "rows", "cols"]
    return [dict(zip(names, r)) for r in out.rows()]


def test_spanned_cells_take_their_columns():
    found = grid_of("<table><tr><th>Name<th>STR<th>DEX<tr><td rowspan=2>hat<td>1<td>2<tr><td>3<td>4</table>")
    assert found[2, 0] == "hat" and (found[2, 1], found[2, 2]) == ("3", "4")
    both = grid_of("<table><tr><td rowspan=2 colspan=2>a</td><td>b</td></tr><tr><td>c</td></tr><tr><td>d</td><td>e</td><td>f</td></tr></table>")
    assert [both[i, j] for i in range(3) for j in range(3)] == ["a", "a", "b", "a", "a", "c", "d", "e", "f"]


@pytest.mark.parametrize("span", ["0", "7", "65534", "99999999999999999999999"])
def test_absurd_spans_end_with_their_table(span):
    source = f"<table><tr><td rowspan={span} colspan={span}>a</td></tr><tr><td>b</td><td>c</td></tr><tr><td>d</td></tr></table><table><tr><td>e</td></tr></table>"
    cells = rows_with_spans(source)
    assert sum(c["rows"] * c["cols"] for c in cells) <= 3 * 1002 + 1
    assert cells[0]["rows"] == 3 and cells[-1]["col"] == 0 and cells[-1]["lines"] == ["e"]


def test_spans_end_with_their_rows_group():
    found = grid_of("<table><thead><tr><th rowspan=9>h</th></tr></thead><tbody><tr><td>a</td></tr></tbody><tbody><tr><td rowspan=3>b</td><td>c</td></tr></tbody><tr><td>d</td></tr></table>")
    assert found == {(0, 0): "h", (1, 0): "a", (2, 0): "b", (2, 1): "c", (3, 0): "d"}


def test_inner_tables_have_their_own_columns():
    found = rows_with_spans("<table><tr><td rowspan=2>a<table><tr><td rowspan=5>x</td><td>y</td></tr></table></td><td>b</td></tr><tr><td>c</td></tr></table>")
    assert [("".join(r["lines"]), r["row"], r["col"], r["rows"]) for r in found] == [("a", 0, 0, 2), ("x", 0, 0, 1), ("y", 0, 1, 1), ("b", 0, 1, 1), ("c", 1, 1, 1)]


def plain_grid(shape):
    """Rows of (row span, column span) as HTML places them: a cell takes the next free column and stops before a taken one."""
    taken, out = {}, []
    for i, row in enumerate(shape):
        j = 0
        for n, (down, right) in enumerate(row):
            while (i, j) in taken:
                j += 1
            wide = 1
            while wide < right and (i, j + wide) not in taken:
                wide += 1
            out.append((i, n, j))
            for x in range(i, min(i + down, len(shape))):
                for y in range(j, j + wide):
                    taken[x, y] = True
            j += wide
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=4), min_size=1, max_size=6))
def test_columns_of_any_spans(shape):
    source = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={d} colspan={r}>{n}</td>" for n, (d, r) in enumerate(row)) + "</tr>" for row in shape) + "</table>"
    cells = rows_with_spans(source)
    assert [(c["row"], int(c["lines"][0]), c["col"]) for c in cells] == plain_grid(shape)
    last, width = len(shape) - 1, max((c["col"] for c in cells), default=0)
    assert all(c["row"] + c["rows"] - 1 <= last and (c["cols"] == 1 or c["col"] + c["cols"] - 1 <= width) for c in cells)
    places = [(i, j) for c in cells for i in range(c["row"], c["row"] + c["rows"]) for j in range(c["col"], c["col"] + c["cols"])]
    assert len(places) == len(set(places))


def test_many_spans_cost_one_pass():
    began = time.perf_counter()
    rows_with_spans("<table>" + "<tr>" + "<td rowspan=60000>x" * 3000 + "<tr><td>y" * 3000 + "</table>")
    assert time.perf_counter() - began < 8
