"""Visible text of raw pages, laid out: a tree builder, then a renderer over the tree.

The builder closes what HTML implies (a ``<li>`` ends the open ``<li>``, a block ends an open
``<p>``, a row ends the open cell, content ends the open head), knows void and raw-text elements, decodes character references
and survives any nesting and stray tags. The renderer leaves out what a browser does not show
(head, scripts, comments, ``hidden``, ``display:none``, ``visibility:hidden``, hidden inputs) and
gives the rest as lines: a blank line around paragraphs and headings, one line per block, markers
and indents for lists, columns padded to equal width for tables, ``pre`` as it stands.

A null or empty page has empty text. Repeated rows each get their text; columns other than
page_id, url and html are ignored. Nothing is cut: very long pages are rendered whole, in time
linear in their length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import text_slices

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas svg math datalist title".split())
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure article section".split())
CLOSES_P = BLOCK - frozenset("body html tbody td tfoot th thead tr caption option optgroup legend li dd dt".split()) | {"li", "dd", "dt"}
#: A start tag ends the nearest open element of the first set, looking no further than the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}), "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"optgroup", "option"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
#: Other start tags, and text, end an open head, whose end tag may be left out.
IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
#: An end tag looks no further than these for its start tag.
SCOPE = frozenset("table td th caption".split())
#: As in browsers, an element at this depth takes the place of the one open there; its text stays.
MAX_DEPTH = 512
#: Cells longer than this are not padded to; they push the rest of their row aside.
WIDEST_PAD = 60

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_CLOSE = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.IGNORECASE) for t in RAW}


class Node:
    """An element: its tag, whether it is shown, and its children (elements and texts)."""

    __slots__ = ("tag", "shown", "children", "start")

    def __init__(self, tag: str, shown: bool = True, start: int = 1) -> None:
        self.tag, self.shown, self.children, self.start = tag, shown, [], start


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return found


def parse(page: str) -> Node:
    """The page's tree. Depth costs no recursion."""
    root = Node("html")
    stack, at, n = [root], 0, len(page)
    while at < n:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else n]
        if text:
            text = html.unescape(text) if "&" in text else text
            if stack[-1].tag == "head" and text.strip(" \t\n\r\f"):
                stack.pop()
            stack[-1].children.append(text)
        if not token:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag or tag == "html":
            continue
        if token[1]:
            _end(stack, tag)
            continue
        node = _start(stack, tag, token[3] or "")
        if tag in RAW and not (token[3] or "").endswith("/"):
            close = _CLOSE[tag].search(page, at)
            raw = page[at : close.start() if close else n]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = close.start() if close else n
    return root


def _start(stack: list[Node], tag: str, text: str) -> Node:
    if stack[-1].tag == "head" and tag not in IN_HEAD:
        stack.pop()
    if tag in IMPLIED:
        ends, until = IMPLIED[tag]
        _pop_to(stack, ends, until)
    if tag in CLOSES_P:
        _pop_to(stack, {"p"}, {"table", "td", "th", "li", "button", "caption"})
    shown, start = tag not in HIDDEN, 1
    if text.strip(" /"):
        of = _attributes(text)
        shown = shown and "hidden" not in of and not ("style" in of and _UNSEEN.search(of["style"]))
        shown = shown and not (tag == "input" and of.get("type", "").lower() == "hidden")
        if tag == "ol" and re.fullmatch(r"[+-]?\d{1,9}", of.get("start", "")):
            start = int(of["start"])
    node = Node(tag, shown, start)
    if len(stack) >= MAX_DEPTH:
        stack.pop()
    stack[-1].children.append(node)
    if tag not in VOID:
        stack.append(node)
    return node


def _pop_to(stack: list[Node], ends: set[str], until: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in ends:
            del stack[k:]
            return
        if stack[k].tag in until:
            return


def _end(stack: list[Node], tag: str) -> None:
    if tag == "br":
        if stack[-1].tag == "head":
            stack.pop()
        stack[-1].children.append(Node("br"))
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption"):
            return
    if tag == "p":
        stack[-1].children.append(Node("p"))


class Lines:
    """Lines under way: inline text joins the open line, blocks begin new ones."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.open: list[str] = []
        self.indent, self.marker, self.gap = "", "", False
        self.space = False

    def text(self, value: str) -> None:
        words = _BLANKS.sub(" ", value)
        if self.space and not words.startswith(" ") and self.open:
            words = " " + words
        if not self.open:
            words = words.lstrip(" ")
        self.space = words.endswith(" ") or (self.space and not words)
        words = words.rstrip(" ")
        if words:
            self.open.append(words)

    def end_line(self, keep_empty: bool = False) -> None:
        self.space = False
        if self.open or keep_empty:
            self.put("".join(self.open))
            self.open = []

    def put(self, line: str) -> None:
        if self.gap and self.done:
            self.done.append("")
        self.gap = False
        lead = self.indent
        if self.marker:
            lead, self.marker = lead[: -len(self.marker)] + self.marker, ""
        self.done.append((lead + line).rstrip(" "))

    def blank(self) -> None:
        self.end_line()
        self.gap = True


def render(root: Node) -> str:
    """Visible text of a tree, by a stack of steps instead of recursion.

    A table writes each cell into lines of its own, then pads and joins them; nested tables are
    laid out first, as one more block inside their cell.
    """
    out = Lines()
    tables: list[tuple[Lines, list[list[str]]]] = []  # outer lines and rows of open tables
    lists: list[list] = []
    steps: list[tuple] = [("in", root, False)]
    while steps:
        do, node, pre = steps.pop()
        if do == "in" and isinstance(node, str):
            if pre:
                first, *more = node.split("\n")
                out.open += [first] if first else []
                for line in more:
                    out.end_line(keep_empty=True)
                    out.open += [line] if line else []
            else:
                out.text(node)
            continue
        tag = node.tag
        if do == "in":
            if not node.shown:
                continue
            if tag == "br":
                out.end_line(keep_empty=True)
                continue
            if tag == "img" or tag == "input":
                continue
            if tag in SPACED and not (tag in ("ul", "ol") and lists):
                out.blank()
            elif tag in BLOCK:
                out.end_line()
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, node.start])
            elif tag == "li":
                marker = "- "
                if lists and lists[-1][0] == "ol":
                    marker = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.indent, out.marker = out.indent + " " * len(marker), marker
                steps.append(("item", node, len(marker)))
            elif tag == "dd" or tag == "blockquote":
                out.indent += "  "
            elif tag == "table":
                tables.append((out, []))
                out = Lines()
            elif tag == "tr" and tables:
                tables[-1][1].append([])
            elif tag in ("td", "th") and tables:
                steps.append(("cell", node, (out, lists)))
                out, lists = Lines(), []
            if tag not in ("li",) and not (tag in ("td", "th") and tables):
                steps.append(("out", node, pre))
            pre = pre or tag in ("pre", "textarea")
            steps += [("in", child, pre) for child in reversed(node.children)]
        elif do == "item":
            out.end_line()
            out.indent, out.marker = out.indent[: len(out.indent) - pre], ""
        elif do == "cell":
            out.end_line()
            cell = " ".join(line.strip() for line in out.done if line.strip())
            out, lists = pre
            rows = tables[-1][1]
            if not rows:
                rows.append([])
            rows[-1].append(cell)
        else:
            if tag in ("ul", "ol", "menu"):
                lists and lists.pop()
                out.end_line()
                if not lists:
                    out.gap = True
            elif tag == "dd" or tag == "blockquote":
                out.end_line()
                out.indent = out.indent[:-2]
            elif tag == "table":
                out.end_line()
                inner = out.done  # captions and stray text, before the rows
                out, rows = tables.pop()
                for line in inner + aligned(rows):
                    out.put(line)
                out.gap = True
            elif tag in SPACED:
                out.blank()
            elif tag in BLOCK:
                out.end_line()
    out.end_line()
    return "\n".join(out.done).strip("\n")


def aligned(rows: list[list[str]]) -> list[str]:
    """Rows as lines: cells of a column start at the same place, two blanks apart."""
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for k, cell in enumerate(row):
            widths[k] = max(widths[k], min(len(cell), WIDEST_PAD))
    lines = ("  ".join(c.ljust(w) for c, w in zip(row, widths)).rstrip(" ") for row in rows)
    return [line for line in lines if line]


def visible_text(page: str | None) -> str:
    return render(parse(page)) if page else ""


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, "html"):
                texts = pa.array(map(visible_text, piece.column("html").to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("page_id"), piece.column("url"), texts], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(extract, "page_id long, url string, text string")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
