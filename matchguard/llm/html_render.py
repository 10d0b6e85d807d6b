"""Layout-aware rendering of HTML pages.

A tree builder reads tags with their implied ends (a paragraph ends at a block,
a list item at the next, cells and rows at the next or at their table's end);
visibility rules leave out what a browser would not show; the walk over the tree
then writes all visible text. Blocks stand on lines of their own, paragraphs and
headings between blank lines, list items behind their mark and indented by
depth, and tables as rows of aligned cells.

Both steps keep their own stacks, so nesting of any depth is safe, and each
takes time in proportion to the page. Cells are padded to their column's width,
at most ``CELL`` characters, and indented by at most ``INDENT``; longer text is
written whole. A cell spans at most 100 columns, so padding is at most 160
characters a cell and line. Form fields, drawings and media (``UNSEEN``: select,
textarea, svg, canvas, object, audio, video) are not text of the page and left
out, but for the labels of buttons; formulas are written.

Defined results: null and empty pages give an empty text; broken or unknown tags
are read as a browser would nearly read them and never fail; ids, nulls among
them, pass through; rows that repeat are rendered each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings

CELL, INDENT = 40, 160
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: Element groups of the public HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure dl table ul ol".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe noembed noframes object audio video canvas svg annotation annotation-xml datalist select textarea".split())
TABLE_PARTS = frozenset("caption colgroup thead tbody tfoot tr td th".split())


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


#: A start tag on the left ends an open element on the right, up to the fence.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "table")),
    "dt": (("dt", "dd"), ("dl", "table")),
    "dd": (("dt", "dd"), ("dl", "table")),
    "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th", "caption"), ("tr", "table")),
    "th": (("td", "th", "caption"), ("tr", "table")),
    "thead": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "caption": (("caption", "colgroup"), ("table",)),
    "colgroup": (("caption", "colgroup"), ("table",)),
    "body": (("head",), ("html",)),
}


class Builder:
    """Makes the tree; ``open`` holds, for each tag, the places of its open elements in the stack, so that no step walks it."""

    def __init__(self):
        self.root = Node("#root", {})
        self.stack, self.open = [self.root], {}

    def _nearest(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of ``tags``; 0 if there is none."""
        return max((at[-1] for t in tags if (at := self.open.get(t))), default=0)

    def text(self, data: str) -> None:
        if data:
            self.stack[-1].children.append(data)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in BLOCKS and self.open.get("p"):
            self._until(("p",), ("td", "th", "caption", "table", "button"))
        if self.open.get("head") and tag not in UNSEEN and tag not in ("html", "head"):
            self._until(("head",), ("html",))
        rule = IMPLIED.get(tag)
        if rule and any(self.open.get(x) for x in rule[0]):
            self._until(*rule)
        node = Node(tag, attributes)
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open.setdefault(tag, []).append(len(self.stack) - 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            return self.start("br", {})
        if not self.open.get(tag):
            return
        if tag not in ("table", *TABLE_PARTS) and self.open.get("table"):
            if self._nearest(("td", "th", "caption", "table")) > self.open[tag][-1]:
                return  # an end inside a table does not close what holds the table
        self._cut(self.open[tag][-1])

    def _cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.open[self.stack.pop().tag].pop()

    def _until(self, ends: tuple[str, ...], fence: tuple[str, ...]) -> None:
        """Close the outermost of ``ends`` that is open inside the nearest fence."""
        inside = self._nearest(fence)
        first = [places[i] for t in ends if (places := self.open.get(t)) and (i := bisect.bisect_right(places, inside)) < len(places)]
        if first:
            self._cut(min(first))


def parse(html: str) -> Node:
    b, at = Builder(), 0
    lower = None
    while True:
        m = TAG.search(html, at)
        if m is None:
            break
        b.text(unescape(html[at : m.start()]))
        at = m.end()
        close, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if close:
            b.end(tag)
            continue
        attributes = {a[1].lower(): unescape(a[2] or a[3] or a[4] or "") for a in ATTRIBUTE.finditer(m[3])} if m[3] else {}
        b.start(tag, attributes)
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            stop = lower.find(f"</{tag}", at) if len(lower) == len(html) else _find(html, tag, at)
            stop = len(html) if stop < 0 else stop
            data = html[at:stop]
            b.text(unescape(data) if tag in ("title", "textarea") else data)
            at = stop
    b.text(unescape(html[at:]))
    return b.root


def _find(html: str, tag: str, at: int) -> int:
    m = re.compile(f"</{re.escape(tag)}", re.I).search(html, at)
    return m.start() if m else -1


_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)|opacity\s*:\s*0(?:\.0*)?\s*(?:;|!|$)|font-size\s*:\s*0)", re.I)


def visible(node: Node) -> bool:
    a = node.attributes
    return node.tag not in UNSEEN and "hidden" not in a and not ("style" in a and _STYLE.search(a["style"]))


def width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of one block context: the page or a table cell."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0  # line ends owed before the next text

    def inline(self, data: str, prefix: str) -> None:
        words = data.split()
        if not words:
            self.space = self.space or bool(data)
            return
        self._begin(prefix)
        if (self.space or data[0].isspace()) and self.now[-1:] and self.now[-1] != prefix:
            self.now.append(" ")
        self.now.append(" ".join(words))
        self.space = data[-1].isspace()

    def _begin(self, prefix: str) -> None:
        if not self.now:
            if self.lines and self.gap > 1 and self.lines[-1]:
                self.lines.append("")
            self.gap, self.space = 0, False
            if prefix:
                self.now.append(prefix)

    def end_line(self, gap: int = 1) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        self.gap, self.space = max(self.gap, gap), False

    def raw(self, lines: list[str], prefix: str) -> None:
        self.end_line()
        if lines:
            self._begin("")
            self.lines += [(prefix + x).rstrip() for x in lines]


def table_lines(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of cells (lines, span) with columns aligned."""
    widths: dict[int, int] = {}
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(CELL, max(map(width, lines), default=0)))
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            at, parts = 0, []
            for lines, span in row:
                text = lines[k] if k < len(lines) else ""
                room = sum(widths.get(i, 0) for i in range(at, at + span)) + 3 * (span - 1)
                parts.append(text + " " * (min(room, 4 * CELL) - width(text)))
                at += span
            out.append(" | ".join(parts).rstrip())
    return out


class _Table:
    def __init__(self):
        self.rows: list = []
        self.caption: list[str] = []


def render(html: str | None) -> str:
    """All visible text of a page."""
    if not html:
        return ""
    flows, tables, lists, prefixes = [Flow()], [], [], [""]
    pre = 0
    mark: list[str] = [""]
    work: list = [(parse(html), "")]  # a node and what its start opened
    while work:
        node, leaving = work.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if tables and tables[-1] is not None and not node.strip():
                continue  # white space between cells
            lead = mark[-1] or prefixes[-1]
            if pre:
                for i, line in enumerate(node.split("\n")):
                    if i:
                        if not flow.now:
                            flow._begin("")
                            flow.lines.append("")
                        flow.end_line()
                    if line:
                        flow._begin(mark[-1] or prefixes[-1])
                        mark[-1] = ""
                        flow.now.append(line)
                continue
            flow.inline(node, lead)
            if flow.now:
                mark[-1] = ""
            continue
        tag = node.tag
        if not leaving:
            if not visible(node):
                continue
            opened = "inline"
            if tag == "br":
                if not flow.now and flow.lines:
                    flow._begin("")
                    flow.lines.append("")
                flow.end_line()
                continue
            if tag == "hr":
                flow.raw(["---"], prefixes[-1])
                continue
            if tag == "input":
                kind = node.attributes.get("type", "text").lower()
                if kind in ("submit", "button", "reset") and node.attributes.get("value"):
                    flow.inline(f" {node.attributes['value']} ", mark[-1] or prefixes[-1])
                continue
            if tag in ("td", "th") and tables and tables[-1] is not None:
                flows.append(Flow())
                tables.append(None)  # text inside a cell is not between cells
                prefixes.append("")
                mark.append("")
                opened = "cell"
            elif tag == "caption" and tables and tables[-1] is not None:
                flows.append(Flow())
                tables.append(None)
                prefixes.append("")
                mark.append("")
                opened = "caption"
            elif tag == "tr" and tables and tables[-1] is not None:
                tables[-1].rows.append([])
            elif tag == "table":
                flow.end_line(2)
                tables.append(_Table())
                opened = "table"
            elif tag in BLOCKS:
                flow.end_line(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
                if tag in ("ul", "ol", "menu", "dir"):
                    start = node.attributes.get("start", "1")
                    lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
                    prefixes.append(prefixes[-1])
                elif tag == "li":
                    n = lists[-1] if lists else None
                    sign = "- " if n is None else f"{n}. "
                    if n is not None:
                        lists[-1] += 1
                    mark.append(prefixes[-1] + sign)
                    prefixes.append((prefixes[-1] + " " * len(sign))[:INDENT])
                elif tag in ("dd", "blockquote"):
                    prefixes.append((prefixes[-1] + "    ")[:INDENT])
                elif tag == "pre":
                    pre += 1
                opened = "block"
            work.append((node, opened))
            work.extend((c, "") for c in reversed(node.children))
            continue
        if leaving == "cell":
            flow.end_line()
            flows.pop()
            tables.pop()
            prefixes.pop()
            mark.pop()
            span = node.attributes.get("colspan", "1")
            if not tables[-1].rows:
                tables[-1].rows.append([])
            tables[-1].rows[-1].append((flow.lines, min(100, int(span)) if span.isascii() and span.isdigit() and 0 < len(span) < 5 and int(span) else 1))
        elif leaving == "caption":
            flow.end_line()
            flows.pop()
            tables.pop()
            prefixes.pop()
            mark.pop()
            tables[-1].caption += flow.lines
        elif leaving == "table":
            done = tables.pop()
            lead = mark[-1]
            lines = done.caption + table_lines(done.rows)
            if lines and lead:
                lines[0] = lead[len(prefixes[-1]) - len(lead) :] + lines[0] if len(lead) > len(prefixes[-1]) else lines[0]
                mark[-1] = ""
            flow.end_line(2)
            flow.raw(lines, prefixes[-1])
            flow.end_line(2)
        elif leaving == "block":
            flow.end_line(2 if tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1) else 1)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                prefixes.pop()
            elif tag == "li":
                mark.pop()
                prefixes.pop()
            elif tag in ("dd", "blockquote"):
                prefixes.pop()
            elif tag == "pre":
                pre -= 1
    flows[0].end_line()
    lines = flows[0].lines
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return "\n".join(lines)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page: ``page_id, n_chars, n_lines, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = [render(h) for h in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()), pa.array(texts, pa.string())], names=["page_id", "n_chars", "n_lines", "text"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, n_chars long, n_lines long, text string")
