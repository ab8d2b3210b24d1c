"""Visible text of web pages, by layout-aware rendering.

The markup is cut into tokens, a tree builder adds implied end tags (a new ``li`` ends an
open one, a block ends an open ``p``, a cell ends a cell, ...), and the renderer walks the
tree with visibility rules and writes what a reader would see: blocks on lines of their own
with blank lines around paragraphs and headings, list items with bullets or numbers and
indentation, table cells in aligned columns (spanned rows and columns count), preformatted text as it stands. Everything
visible is kept, whichever part of the page it is in, also the words of SVG text and MathML. An element that is not
displayed takes its subtree with it; invisible is inherited, so a visible element inside is shown. Builder and renderer use explicit
stacks, so nesting of any depth is fine.

Results for odd input: null or empty html gives an empty text; broken markup never fails, a
``<`` that opens no tag is text; repeated rows are rendered each; a null id passes through;
other columns are ignored. One narrow pass, without a shuffle.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
#: From the end of a tag's name to its ``>``, which may also stand within quoted values.
_TAG_END = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+>")
_ATTR = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_ASCII_UPPER = re.compile("[A-Z]+")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_DISPLAYED = re.compile(r"(?<![-\w])(?:display\s*:\s*none|content-visibility\s*:\s*hidden)", re.I)
_VISIBILITY = re.compile(r"(?<![-\w])visibility\s*:\s*(visible|hidden|collapse)", re.I)
_NUMBER = re.compile(r"-?[0-9]{1,9}")
#: A tag's attributes that end in the slash of an empty element (not of an unquoted value).
_EMPTY = re.compile(r"(?:^|[\s\"'])/\s*$")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style title head template noscript iframe noembed noframes object audio video canvas datalist param rp".split())
#: Elements in which ``<x/>`` is an empty element.
FOREIGN = ("svg", "math")
#: Parts of SVG and MathML that are not drawn where they stand.
UNDRAWN = frozenset("defs symbol clippath mask marker pattern desc metadata annotation annotation-xml".split())
#: In SVG only the words in these are drawn.
SVG_WORDS = frozenset("text foreignobject".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup html legend li main menu nav ol optgroup option p pre search section summary table ul tr caption thead tbody tfoot".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset".split())
ENDS_P = BLOCK - {"body", "html", "tr", "caption", "thead", "tbody", "tfoot", "option", "optgroup", "legend"} | {"hr"}
#: Start tag -> (open elements it ends, elements that the search for them does not leave).
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
#: An end tag looks no further than these for its start.
WALLS = frozenset("td th table caption button".split())
#: Their end tags look through walls.
OUTER = frozenset("table tr thead tbody tfoot body html".split())
ROW_GROUPS = frozenset("thead tbody tfoot".split())
#: Cells wider than this do not widen their column; the row goes on below them.
CELL_WIDTH = 60
#: Cells that would begin further right just follow the cell before.
WIDEST = 4096


#: Tags that end an open SVG, as the HTML standard has it.
LEAVES_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def attr(self, name: str) -> str | None:
        if name not in self.attrs.lower():
            return None
        for m in _ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(next((g for g in m.groups()[1:] if g is not None), ""))
        return None


class Builder:
    """Stack of open elements; adds the end tags that the markup leaves out."""

    def __init__(self):
        self.root = Node("#root")
        self.stack = [self.root]
        self.opened: Counter[str] = Counter()

    def text(self, text: str) -> None:
        if self.stack[-1].tag == "head" and not text.isspace():
            self.cut(len(self.stack) - 1)
        self.stack[-1].children.append(text)

    def cut(self, k: int) -> None:
        """End the open elements from the k-th on."""
        for n in self.stack[k:]:
            self.opened[n.tag] -= 1
        del self.stack[k:]

    def end(self, tags: set, within: frozenset | set) -> None:
        """End the innermost of ``tags``, not looking beyond ``within``."""
        if any(self.opened[t] for t in tags):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in within and self.stack[k].tag not in tags:
                    return
                if self.stack[k].tag in tags:
                    return self.cut(k)

    def start_tag(self, tag: str, attrs: str) -> Node | None:
        if self.stack[-1].tag == "head" and tag not in UNSEEN and tag not in ("meta", "link", "base"):
            self.cut(len(self.stack) - 1)
        while tag in LEAVES_SVG and self.opened["svg"] and not self.opened["foreignobject"] and not self.opened["desc"]:
            self.end({"svg"}, frozenset())
        if tag in ENDS_P:
            self.end({"p"}, WALLS)
        if tag in IMPLIED:
            self.end(*IMPLIED[tag])
        if tag in ("html", "body") and self.opened[tag]:
            return None
        node = Node(tag, attrs)
        self.stack[-1].children.append(node)
        if (tag in FOREIGN or self.foreign()) and _EMPTY.search(attrs):
            return None
        if tag not in VOID and tag not in RAW:
            self.stack.append(node)
            self.opened[tag] += 1
        return node

    def foreign(self) -> bool:
        return any(self.opened[t] for t in FOREIGN)

    def end_tag(self, tag: str) -> None:
        if tag == "br" or tag == "p" and not self.opened["p"]:
            self.stack[-1].children.append(Node(tag))
        else:
            self.end({tag}, frozenset() if tag in OUTER else WALLS)


def parse(html: str) -> Node:
    """Tree of a page; text children are strings with character references resolved."""
    build, size = Builder(), len(html)
    begun = at = 0  # text not yet handed over starts at begun
    quotes, lower = True, ""
    while (at := html.find("<", at)) >= 0:
        close = html.startswith("/", at + 1)
        name = _NAME.match(html, at + 1 + close)
        if not name and html[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1  # a lone < is text
            continue
        if html.startswith("<!--", at):
            end = html.find("-->", at + 2)
            end = size if end < 0 else end + 3
        elif not name:
            end = html.find(">", at) + 1
        else:
            whole = _TAG_END.match(html, name.end()) if quotes else None
            quotes = whole is not None  # after an open quote that swallows the rest, quotes are ordinary characters
            end = whole.end() if whole else html.find(">", name.end()) + 1
        if not end:
            break  # no > follows: the rest is text
        if at > begun:
            build.text(unescape(html[begun:at]))
        begun = at = end
        if not name:
            continue
        tag = name[0].lower()
        if close:
            build.end_tag(tag)
            continue
        node = build.start_tag(tag, html[name.end() : end - 1])
        if node and tag in RAW:
            lower = lower or _ASCII_UPPER.sub(lambda m: m[0].lower(), html)
            stop = lower.find(f"</{tag}", end)
            stop = size if stop < 0 else stop
            if tag in ("textarea", "title"):
                node.children.append(unescape(html[end:stop]))
            begun = at = html.find(">", stop) + 1 or size
    if begun < size:
        build.text(unescape(html[begun:]))
    return build.root


def hidden(node: Node, foreign: bool = False) -> bool:
    """Does the element not show at all, nor anything in it?"""
    if node.tag in UNSEEN or foreign and node.tag in UNDRAWN:
        return True
    if not node.attrs or node.attrs.isspace():
        return False
    low = node.attrs.lower()
    if "hidden" in low and ((node.attr("hidden") is not None) or (node.tag == "input" and (node.attr("type") or "").lower() == "hidden")):
        return True
    return "style" in low and bool(_NOT_DISPLAYED.search(node.attr("style") or ""))


def visible(node: Node, inherited: bool) -> bool:
    if "isibility" not in node.attrs and "ISIBILITY" not in node.attrs.upper():
        return inherited
    said = _VISIBILITY.findall(node.attr("style") or "")
    return said[-1].lower() == "visible" if said else inherited


class Flow:
    """Lines of one block context: the page, or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False  # a collapsed space is due before the next word
        self.gap = 0  # blank lines due before the next line
        self.indent = 0
        self.mark = ""  # list bullet due on the next line

    def words(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        body = text.strip(" ")
        if text[:1] == " ":
            self.space = True
        if body:
            if self.space and self.parts:
                self.parts.append(" ")
            self.parts.append(body)
            self.space = text[-1] == " "

    def end_line(self) -> None:
        if self.parts:
            self._write("".join(self.parts))
            self.parts = []
        self.space = False

    def _write(self, line: str) -> None:
        if self.lines and self.gap:
            self.lines += [""] * self.gap
        self.gap = 0
        lead = "  " * (self.indent - 1) + self.mark if self.mark else "  " * self.indent
        self.mark = ""
        self.lines.append((lead + line).rstrip(" ") if line else "")

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.lines and not self.mark:
            self.gap = 1

    def verbatim(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._write(line)

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def _placed(rows: list) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of (column, columns spanned, lines): cells stand beside those that reach down from rows above.
    A row None ends a group of rows, and what reaches down in it."""
    out: list[list] = []
    down: dict[int, tuple[int, int]] = {}  # column where a cell from above begins: its end, the first row below it
    jumps: dict[int, tuple[int, int]] = {}  # the same for neighbours taken together
    for row in rows:
        if row is None:
            down, jumps = {}, {}
            continue
        y, at = len(out), 0
        own, new = [], []
        for lines, span, height in row:
            start, free = at, None
            while (jump := jumps.get(at, (0, 0)))[1] > y or (jump := down.get(at, (0, 0)))[1] > y:
                at, free = jump[0], jump[1] if free is None else min(free, jump[1])
            if free is not None:
                jumps[start] = at, free
            own.append((at, span, lines))
            if height != 1:
                new.append((at, at + span, y + height if height else sys.maxsize))
            at += span
        down.update((a, (b, below)) for a, b, below in new)
        out.append(own)
    return out


def _grid(rows: list[list[tuple[list[str], int, int]] | None]) -> list[str]:
    """Lines of a table of cells (lines, columns, rows): cells of a column start at the same place; a cell may have
    several lines. What stands right of a cell too wide for its column goes on in the next line, at its place."""
    placed = _placed(rows)
    widths: dict[int, int] = {}
    spanning = []
    for row in placed:
        for at, span, lines in row:
            width = max(map(len, lines), default=0)
            if width <= CELL_WIDTH and span == 1:
                widths[at] = max(widths.get(at, 0), width)
            elif 0 < width <= CELL_WIDTH:
                spanning.append((at, span, width))
            elif width:
                widths[at] = max(widths.get(at, 0), 1)
    for at, span, width in spanning:
        held = sum(widths[c] + 2 for c in range(at, at + span) if widths.get(c)) - 2
        if held < width:
            last = at + span - 1
            widths[last] = max(widths.get(last, 0) + width - held - (0 if widths.get(last) else 2), 1)
    used = sorted(c for c, width in widths.items() if width)
    ends = [0]  # where the column after each used one begins
    for c in used:
        ends.append(ends[-1] + widths[c] + 2)
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for at, _, lines in row:
                text = lines[k] if k < len(lines) else ""
                if not text:
                    continue
                place = ends[bisect_left(used, at)]
                if place > WIDEST:
                    line += "  " + text
                    continue
                if line and len(line) > place - 2:
                    out.append(line.rstrip(" "))
                    line = ""
                line = line.ljust(place) + text
            out.append(line.rstrip(" "))
    return out


def render(root: Node) -> str:
    flow = Flow()
    flows: list[Flow] = []
    tables: list[list] = []  # rows of the open tables
    lists: list[list] = []  # [ordered, next number] of the open lists
    pre = 0
    shown = [(True, True, False)]  # of the open elements: visible, words are drawn, inside SVG or MathML
    todo: list[tuple] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        seen, drawn, foreign = shown[-1]
        if isinstance(node, str):
            if not (seen and drawn):
                flow.words(" " if drawn else "")
            elif pre:
                first, *rest = node.replace("\r\n", "\n").split("\n")
                flow.parts.append(first)
                for line in rest:
                    flow.verbatim([]) if flow.parts and "".join(flow.parts) else flow._write("")
                    flow.parts = [line]
            else:
                flow.words(node)
            continue
        tag = node.tag
        if leaving:
            shown.pop()
            if foreign and tag == "text":
                flow.words(" ")
            if tag in ROW_GROUPS and tables:
                tables[-1].append(None)
            if tag == "pre":
                pre -= 1
                flow.block(True)
            elif tag in ("td", "th") and tables:
                lines, flow = flow.result(), flows.pop()
                span = (node.attr("colspan") or "").strip()
                span = min(max(int(span), 1), 1000) if span.isascii() and span.isdigit() and len(span) < 6 else 1
                height = (node.attr("rowspan") or "").strip()
                height = min(int(height), 65534) if height.isascii() and height.isdigit() and len(height) < 6 else 1
                if not tables[-1] or tables[-1][-1] is None:
                    tables[-1].append([])
                tables[-1][-1].append((lines, span, height))
            elif tag == "table":
                flow.block(True)
                flow.verbatim(_grid(tables.pop()))
                flow.block(True)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.end_line()
                flow.indent -= 1
                flow.block(not lists)
            elif tag == "li":
                flow.end_line()
                flow.mark = ""
                flow.indent -= not lists
            elif tag in ("dd", "blockquote"):
                flow.end_line()
                flow.indent -= 1
                flow.block(tag in SPACED)
            elif tag == "q" and seen:
                flow.words('"')
            elif tag in BLOCK:
                flow.block(tag in SPACED)
            continue
        if hidden(node, foreign):
            continue
        seen = visible(node, seen)
        if tag == "dialog" and node.attr("open") is None:
            continue
        if tag == "br":
            if flow.parts:
                flow.end_line()
            elif flow.lines and not flow.mark:
                flow.gap = 1
            continue
        if tag in VOID and not seen:
            continue
        if tag == "hr":
            flow.verbatim(["---"])
            continue
        if tag == "img" or tag == "area":
            flow.words(f" {node.attr('alt') or ''} ")
            continue
        if tag == "input":
            if (node.attr("type") or "text").lower() in ("submit", "button", "reset", "text"):
                flow.words(f" {node.attr('value') or ''} ")
            continue
        if tag in VOID:
            continue
        todo.append((node, True))
        if foreign and tag == "text":
            flow.words(" ")
        shown.append((seen, tag != "svg" and (drawn or foreign and tag in SVG_WORDS), (foreign or tag in FOREIGN) and tag != "foreignobject"))
        if tag in ROW_GROUPS and tables:
            tables[-1].append(None)
        if tag == "pre":
            flow.block(True)
            pre += 1
        elif tag == "table":
            flow.block(True)
            tables.append([])
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("td", "th") and tables:
            flows.append(flow)
            flow = Flow()
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.block(not lists)
            flow.indent += 1
            start = (node.attr("start") or "").strip()
            lists.append([tag == "ol", int(start) if _NUMBER.fullmatch(start) else 1])
        elif tag == "li":
            flow.end_line()
            flow.indent += not lists
            if lists and lists[-1][0]:
                value = (node.attr("value") or "").strip()
                if _NUMBER.fullmatch(value):
                    lists[-1][1] = int(value)
                flow.mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            else:
                flow.mark = "- "
        elif tag in ("dd", "blockquote"):
            flow.block(tag in SPACED)
            flow.indent += 1
        elif tag == "q" and seen:
            flow.words('"')
        elif tag in BLOCK:
            flow.block(tag in SPACED)
        for child in reversed(node.children):
            todo.append((child, False))
    return "\n".join(flow.result()).strip("\n")


def html_to_text(html: str | None) -> str:
    return render(parse(html)) if html else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) of every page."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = pa.array([html_to_text(x.as_py()) for x in batch.column(1)], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["page_id", "text"])

    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, text string")
