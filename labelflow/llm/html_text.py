"""Visible text of HTML pages by layout-aware rendering.

A tree builder opens and closes the tags that pages leave out (paragraphs, list items, table
rows and cells, options, ...). The tree is rendered top down: hidden subtrees are skipped,
white space collapses except in preformatted text, blocks start new lines and blocks with a
margin a blank one, list items get a bullet or their number and are indented by depth, and a
table's cells are padded into columns. Both walks use explicit stacks, so depth has no limit.

A null page gives null, an empty one the empty string. Text outside any tag counts as body
text. Unclosed tags end with the page; a "<" that opens nothing is text. Repeated rows are
rendered one by one, other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelflow.llm.common import field, parts

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]{2,}|[\t\n\r\f]")


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


# Element classes of the HTML standard.
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style xmp iframe noembed noframes textarea title")
HIDDEN = _set("area base datalist head iframe link meta noembed noframes noscript param rp script source style template title track "
              "audio canvas object svg video")
MARGIN = _set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu dir listing xmp")
BLOCK = MARGIN | _set("address article aside body center dd details dialog div dt figcaption footer form header hgroup html legend li main "
                      "nav optgroup option search section summary caption")
CLOSES_P = _set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                "header hgroup hr main menu nav ol p pre search section summary table ul li dd dt")
#: An opening tag closes open elements of these names, up to the nearest of its scope.
IMPLIED = {
    "li": (_set("li"), _set("ul ol menu dir table td th")),
    "dd": (_set("dd dt"), _set("dl table td th")),
    "dt": (_set("dd dt"), _set("dl table td th")),
    "td": (_set("td th caption"), _set("table tr")),
    "th": (_set("td th caption"), _set("table tr")),
    "tr": (_set("tr td th caption"), _set("table tbody thead tfoot")),
    "tbody": (_set("tbody thead tfoot tr td th caption colgroup"), _set("table")),
    "thead": (_set("tbody thead tfoot tr td th caption colgroup"), _set("table")),
    "tfoot": (_set("tbody thead tfoot tr td th caption colgroup"), _set("table")),
    "option": (_set("option"), _set("select datalist optgroup")),
    "optgroup": (_set("option optgroup"), _set("select")),
    "body": (_set("head"), _set("html")),
}
#: Elements that only stand in head; any other start tag ends an open head.
HEAD_ONLY = _set("base link meta noscript script style template title")
BARRIER = _set("table td th caption button object template html")
LISTS = _set("ul ol menu dir")
PREFORMATTED = _set("pre listing xmp textarea")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        """Value of an attribute, '' if it has none, None if it is absent."""
        if name not in self.attributes.lower():
            return None
        for key, value in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value[1:-1] if value[:1] in ("'", '"') else value)
        return None


class Builder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]

    def text(self, raw: str) -> None:
        if not raw:
            return
        if self.open[-1].tag == "head" and raw.strip():
            self.open.pop()
        self.open[-1].children.append(html.unescape(raw) if "&" in raw else raw)

    def _close_to(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Closes the outermost open element among ``names`` inside the nearest of ``scope``, with all in it."""
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in scope:
                break
            if tag in names:
                found = i
        if found is not None:
            del self.open[found:]

    def start(self, tag: str, attributes: str) -> None:
        if tag == "html" or (tag == "body" and any(n.tag == "body" for n in self.open)):
            return
        if any(n.tag == "head" for n in self.open[1:2]) and tag not in HEAD_ONLY:
            self._close_to(_set("head"), _set("html"))
        if tag in CLOSES_P:
            self._close_to(_set("p"), BARRIER)
        if tag in IMPLIED:
            self._close_to(*IMPLIED[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr"))
        node = Node(tag, attributes)
        self._push(node)
        if tag in VOID:
            self.open.pop()

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.start("br", "")
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in BARRIER and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                break
        if tag == "p":
            self.open[-1].children.append(Node("p"))


def parse(page: str) -> Node:
    builder, at = Builder(), 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            builder.text(page[at:])
            return builder.root
        builder.text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            builder.end(tag)
            continue
        builder.start(tag, m[3])
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            end = close.start() if close else len(page)
            body = page[at:end]
            builder.open[-1].children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            builder.end(tag)
            at = close.end() if close else len(page)


def hidden(node: Node) -> bool:
    if node.tag in HIDDEN:
        return True
    if not node.attributes:
        return False
    if node.attribute("hidden") is not None:
        return True
    style = node.attribute("style")
    if style and _HIDING.search(style):
        return True
    return node.tag == "input" and (node.attribute("type") or "").lower() == "hidden"


class Lines:
    """Lines of a block context; collapses white space and blank lines as it goes."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.space = False
        self.gap = False
        self.indent = ""
        self.marker = ""

    def text(self, s: str, preformatted: bool) -> None:
        if preformatted:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._add(first)
            for line in rest:
                self.newline()
                self._add(line)
            return
        line = _SPACE.sub(" ", s)
        body = line.strip(" ")
        if not body:
            self.space = self.space or bool(line)
            return
        if self.current and (self.space or line[0] == " "):
            self.current.append(" ")
        self.current.append(body)
        self.space = line[-1] == " "

    def _add(self, s: str) -> None:
        if s:
            self.current.append(s)

    def newline(self) -> None:
        """Ends the line, also an empty one."""
        self._write("".join(self.current))
        self.current, self.space = [], False

    def _write(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        marker, self.marker = self.marker, ""
        pad = self.indent[:max(0, len(self.indent) - len(marker))] + marker
        self.lines.append((pad + line).rstrip())

    def block(self, margin: bool) -> None:
        """Ends the line if it has text; with a margin the next one is set off by a blank line."""
        if self.current:
            self.newline()
        self.space = False
        self.gap = self.gap or (margin and not self.marker)

    def done(self) -> list[str]:
        self.block(False)
        return self.lines


def _span(cell: Node) -> int:
    raw = (cell.attribute("colspan") or "").strip() if cell.attributes else ""
    return max(1, min(1000, int(raw))) if raw.isascii() and raw.isdigit() else 1


def lay_out(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Lines of a table whose rows hold (columns spanned, lines); columns are as wide as their widest single cell."""
    widths: list[int] = []
    for row in rows:
        at = 0
        for span, lines in row:
            widths += [0] * (at + span - len(widths))
            if span == 1:
                widths[at] = max([widths[at], *map(len, lines)])
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for _, lines in row), default=0)):
            at, line = 0, ""
            for span, lines in row:
                here = lines[k] if k < len(lines) else ""
                line += here.ljust(sum(widths[at:at + span]) + 2 * (span - 1)) + "  "
                at += span
            out.append(line.rstrip())
    return out


def render(root: Node) -> str:
    out = Lines()
    contexts: list[Lines] = []
    tables: list[list] = []
    lists: list[int | None] = []
    pre = 0
    stack: list[tuple[Node | str, bool]] = [(root, True)]
    while stack:
        node, entering = stack.pop()
        if isinstance(node, str):
            out.text(node, pre > 0)
            continue
        tag = node.tag
        if entering:
            if hidden(node):
                continue
            if tag == "br":
                out.newline()
                continue
            if tag in BLOCK:
                out.block(tag in MARGIN and not (tag in LISTS and lists))
            if tag in PREFORMATTED:
                pre += 1
            if tag in LISTS:
                start = (node.attribute("start") or "1").strip() if tag == "ol" else ""
                lists.append((int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1) if tag == "ol" else None)
                out.indent += "   " if tag == "ol" else "  "
            elif tag == "li":
                if lists and lists[-1] is not None:
                    out.marker = f"{lists[-1]}. "
                    lists[-1] += 1
                else:
                    out.marker = "- "
            elif tag in ("blockquote", "dd"):
                out.indent += "    "
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                contexts.append(out)
                out = Lines()
            stack.append((node, False))
            stack.extend((child, True) for child in reversed(node.children))
            continue
        if tag in ("td", "th") and tables:
            lines = out.done()
            out = contexts.pop()
            tables[-1][-1].append((_span(node), lines))
        elif tag == "table":
            lines = lay_out(tables.pop())
            out.block(True)
            for line in lines:
                out.text(line, True)
                out.newline()
        if tag in PREFORMATTED:
            pre -= 1
        if tag in BLOCK:
            out.block(tag in MARGIN and not (tag in LISTS and len(lists) > 1))
        if tag in LISTS:
            lists.pop()
            out.indent = out.indent[:-3 if tag == "ol" else -2]
        elif tag == "li":
            out.marker = ""
        elif tag in ("blockquote", "dd"):
            out.indent = out.indent[:-4]
    return "\n".join(out.done())


def page_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """id_col and the visible text of each page."""
    rows = pages.select(pages[id_col].alias("id"), pages[html_col].cast("string").alias("html"))

    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(rows.schema["id"].dataType)

    def run(batches):
        for ids, bodies in parts(batches, 64):
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array([page_text(b) for b in bodies], pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"{field('id', rows, 'id')}, text string").select(F.col("id").alias(id_col), F.col("text").alias(text_col))
