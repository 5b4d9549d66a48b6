"""Visible text of HTML pages by layout-aware rendering.

``events`` builds the tree, as a balanced stream of opens, texts and closes: end
tags that HTML implies (paragraphs, list items, cells, rows, options) are put in,
stray ones dropped, and everything still open is closed. ``render`` walks that
stream: nothing invisible is written (script, style, head, templates, ``hidden``,
``display:none``, closed dialogs, a closed ``details`` but for its summary, and
``visibility:hidden`` up to what says ``visible`` again), white space collapses,
blocks start lines and paragraphs, headings, lists and tables stand apart by a
blank line, each ``br`` ends a line, list items carry their bullet or number and
depth, and a table's cells are aligned in columns: spans of columns and rows keep
their place, and a cell's blocks stay lines of their own. Both are loops over one
page, linear in its length; Spark deals the pages.

Columns are as wide as their widest line. Only where padding a column would make the
table more than ``PADDING`` times its text, lines wider than what that allows stick out.

Defined results: a null or empty page has the empty text; broken markup never
fails; repeated rows each give a row; input columns named like a result are
replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame

from stationlake.llm.common import add_columns

# fixed values: elements by the role they have in HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = frozenset("script style head title template noscript iframe object embed audio video canvas datalist "
                      "meta link base param source track colgroup col".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
                  "option p pre search section select summary table caption tbody tfoot thead tr ul".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table pre blockquote figure hr article section".split())
LISTS = frozenset("ul ol menu dir".split())
CLOSES_P = BLOCK - frozenset("body html option optgroup tbody tfoot thead tr caption".split())
#: Opening the key ends the nearest of these, unless one of the second set stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "body": ({"head"}, set()),
}
WALLS = frozenset("table td th caption html template".split())
PARTS = frozenset("td th tr thead tbody tfoot caption".split())

# a quote delimits a value only directly after "="; an unclosed one is part of a name, so the tag ends at the next ">"
MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"""
                    r"""((?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?)*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?""")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")
#: A column's padding is at most so many times the table's text, and so many characters.
PADDING, PADDING_LEAST = 8, 20_000
#: The most columns and rows that a cell may span (fixed by HTML).
SPAN_COLUMNS, SPAN_ROWS = 1000, 65534


def attributes(text: str) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in ATTRIBUTE.findall(text)} if text.strip() else {}


def events(page: str) -> Iterator[tuple[str, str, dict | None]]:
    """("open", tag, attributes), ("text", text, None) and ("close", tag, None), balanced."""
    stack: list[str] = []
    places: dict[str, list[int]] = defaultdict(list)  # where each open tag stands in the stack

    def push(tag: str) -> None:
        places[tag].append(len(stack))
        stack.append(tag)

    def close_to(depth: int):
        while len(stack) > depth:
            places[stack[-1]].pop()
            yield "close", stack.pop(), None

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def nearest(tags, walls) -> int | None:
        i = last(tags)
        return i if i >= 0 and i >= last(walls) else None

    at, n = 0, len(page)
    while at < n:
        m = MARKUP.search(page, at)
        if m is None:
            yield "text", page[at:], None
            break
        if m.start() > at:
            yield "text", page[at:m.start()], None
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in ("br", "p") and not places.get(tag):
                yield "open", tag, {}
                yield "close", tag, None
                continue
            # what a cell holds can't close what stands outside it, but for the parts of its own table
            i = nearest({tag}, {"table", "template"} if tag in PARTS else {"template"} if tag == "table" else WALLS)
            if i is not None:
                yield from close_to(i)
            continue
        if tag in IMPLIED:
            i = nearest(*IMPLIED[tag])
            if i is not None:
                yield from close_to(i)
        if tag in CLOSES_P:
            i = nearest({"p"}, WALLS)
            if i is not None:
                yield from close_to(i)
        if tag in ("td", "th") and nearest({"tr"}, {"table"}) is None and places.get("table"):
            push("tr")
            yield "open", "tr", {}
        rest = m[3]
        yield "open", tag, attributes(rest)
        if tag in VOID:
            yield "close", tag, None
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            yield "text", page[at:end.start() if end else n], None
            yield "close", tag, None
            at = end.end() if end else n
        else:
            push(tag)
    yield from close_to(0)


def unseen(tag: str, attrs: dict[str, str]) -> bool:
    return (tag in INVISIBLE or "hidden" in attrs or ("style" in attrs and UNSEEN.search(attrs["style"]) is not None)
            or (tag == "dialog" and "open" not in attrs) or (tag == "input" and attrs.get("type", "").lower() == "hidden"))


class Flow:
    """Lines of text under construction; ``gap`` is the number of line ends due before the next text."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.space, self.empty = 0, False, True

    def block(self, lines: int) -> None:
        self.gap, self.space = max(self.gap, lines), False

    def put(self, text: str, indent: str) -> None:
        if self.empty:
            self.parts.append(indent)
        elif self.gap:
            self.parts.append("\n" * self.gap + indent)
        elif self.space:
            self.parts.append(" ")
        self.parts.append(text)
        self.gap, self.space, self.empty = 0, False, False

    def inline(self, text: str, indent: str) -> None:
        words = SPACES.sub(" ", text)
        body = words.strip(" ")
        if not body:
            self.space = self.space or (bool(words) and not self.empty)
            return
        if words[0] == " ":
            self.space = True
        self.put(body, indent)
        self.space = words[-1] == " "

    def verbatim(self, text: str) -> None:
        """Text of a <pre>: its line ends stay, those at either end as due before what follows."""
        body = text.strip("\n")
        if not body:
            self.gap += len(text)
            return
        self.gap += len(text) - len(text.lstrip("\n"))
        self.put(body, "")
        self.gap = len(text) - len(text.rstrip("\n"))

    def text(self) -> str:
        return "".join(self.parts)


def _span(attrs: dict[str, str], name: str, most: int) -> int:
    """A cell's span; 0 rows are all that follow."""
    text = attrs.get(name, "").strip()
    n = int(text) if re.fullmatch(r"\d{1,9}", text) else 1
    return min(n or (most if name == "rowspan" else 1), most)


def placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, int, list[str]]]]:
    """(first column, column behind the last, lines) of every cell; a cell that spans rows keeps its columns in them."""
    out, held = [], []  # held: (first, behind, rows left), by column
    for row in rows:
        cells, column, k, mine = [], 0, 0, []
        for text, wide, high in row:
            while k < len(held) and held[k][0] <= column:
                column = max(column, held[k][1])
                k += 1
            cells.append((column, column + wide, text.split("\n")))
            if high > 1:
                mine.append((column, column + wide, high))
            column += wide
        out.append(cells)
        held = sorted((a, b, n - 1) for a, b, n in [*held, *mine] if n > 1)
    return out


def _width(lines: list[int], slots: int, allowed: int) -> int:
    """The widest line, or the widest of which padding ``slots`` lines costs ``allowed`` at most."""
    return next((w for w in sorted(set(lines), reverse=True) if w * slots - sum(min(x, w) for x in lines) <= allowed), 0) if (
        max(lines) * slots - sum(lines) > allowed) else max(lines)


def table_text(rows: list[list[tuple[str, int, int]]]) -> str:
    """Cells (text, columns, rows) as aligned lines."""
    cells = placed(rows)
    starts = sorted({c[0] for row in cells for c in row})
    ranked = [[(bisect_left(starts, a), max(bisect_left(starts, a) + 1, bisect_left(starts, b)), lines) for a, b, lines in row] for row in cells]
    heights = [max((len(lines) for _, _, lines in row), default=0) for row in ranked]
    allowed = PADDING * sum(len(t) for row in rows for t, _, _ in row) + PADDING_LEAST
    single: dict[int, list[int]] = defaultdict(list)
    for row in ranked:
        for a, b, lines in row:
            if b == a + 1:
                single[a].extend(map(len, lines))
    slots = sum(heights)
    width = [_width(single[i], slots, allowed) if i in single else 0 for i in range(len(starts))]
    offset = [0]
    for w in width:
        offset.append(offset[-1] + w + 2)
    out = []
    for row, height in zip(ranked, heights):
        for k in range(height):
            line: list[str] = []
            size = 0
            for a, _, lines in row:
                if k < len(lines) and lines[k]:
                    gap = offset[a] - size
                    pad = " " * (gap if gap > 0 or not size else 2)
                    line += [pad, lines[k]]
                    size += len(pad) + len(lines[k])
            out.append("".join(line).rstrip())
    while out and not out[-1]:
        out.pop()
    return "\n".join(x for i, x in enumerate(out) if x or (i and out[i - 1]))


def render(page: str) -> str:
    """The visible text of one page."""
    flows, tables, lists = [Flow()], [], []
    cells: list[tuple[int, int]] = []  # columns and rows of the open cells
    hidden, pre = 0, 0
    opened: list[tuple[str, bool, bool, bool]] = []  # tag, whether it hides, is a closed <details>, is visible
    marker, fresh = "", False  # fresh: a <pre> has just been opened, and a line end would not count
    for kind, what, attrs in events(page):
        flow = flows[-1]
        fresh = fresh and kind == "text"
        shut, visible = opened[-1][2:] if opened else (False, True)
        if kind == "text":
            if hidden or shut or not visible:
                continue
            text = html.unescape(what).replace("\xa0", " ") if "&" in what or "\xa0" in what else what
            indent = "  " * max(0, len(lists) - 1)
            if marker and text.strip():
                flow.put(f"{indent}{marker}".rstrip(), "")
                flow.space, marker = True, ""
            if pre:
                text = text.replace("\r\n", "\n").replace("\r", "\n")
                flow.verbatim(text.removeprefix("\n") if fresh else text)
                fresh = False
            else:
                flow.inline(text, "  " * len(lists) if lists and flow.gap else "")
        elif kind == "open":
            hides = unseen(what, attrs) or (shut and what != "summary")
            said = VISIBILITY.findall(attrs.get("style", ""))
            opened.append((what, hides, what == "details" and "open" not in attrs, said[-1].lower() == "visible" if said else visible))
            hidden += hides
            if hidden:
                continue
            if what == "br":
                flow.gap, flow.space = flow.gap + 1, False
            elif what in LISTS:
                flow.block(1 if lists else 2)
                start = attrs.get("start", "1")
                lists.append(int(start) if what == "ol" and re.fullmatch(r"-?\d{1,9}", start) else (1 if what == "ol" else None))
            elif what == "li":
                flow.block(1)
                if lists and lists[-1] is not None and re.fullmatch(r"-?\d{1,9}", attrs.get("value", "").strip()):
                    lists[-1] = int(attrs["value"])
                if lists and lists[-1] is not None:
                    marker, lists[-1] = f"{lists[-1]}. ", lists[-1] + 1
                else:
                    marker = "- "
                    lists = lists or []
            elif what == "table":
                flow.block(2)
                tables.append([])
            elif what == "tr" and tables:
                tables[-1].append([])
            elif what in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(Flow())
                cells.append((_span(attrs, "colspan", SPAN_COLUMNS), _span(attrs, "rowspan", SPAN_ROWS)))
            elif what == "pre":
                flow.block(2)
                pre, fresh = pre + 1, True
            elif what == "img":
                if attrs.get("alt", "").strip() and opened[-1][3]:
                    flow.inline(f" {attrs['alt']} ", "")
            elif what in BLOCK:
                flow.block(2 if what in APART else 1)
        else:
            tag, hides, _, _ = opened.pop()
            was = hidden
            hidden -= hides
            if was:
                continue
            if tag in LISTS:
                if lists:
                    lists.pop()
                marker = ""
                flow.block(1 if lists else 2)
            elif tag in ("td", "th") and tables and len(flows) > 1:
                tables[-1][-1].append((flows.pop().text(), *cells.pop()))
            elif tag == "table" and tables:
                text = table_text(tables.pop())
                if text:
                    flow.block(2)
                    flow.put(text, "")
                flow.block(2)
            elif tag == "pre":
                pre -= 1
                flow.gap, flow.space = 2, False
            elif tag == "li":
                marker = ""
                flow.block(1)
            elif tag in BLOCK:
                flow.block(2 if tag in APART else 1)
    return flows[0].text()


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, ``n_text_chars`` and ``n_text_lines``."""

    def texts(batch: list[bytes]) -> list[list]:
        out = [render(b.decode("utf-8", "replace")) for b in batch]
        return [out, [len(t) for t in out], [t.count("\n") + 1 if t else 0 for t in out]]

    return add_columns(pages, html_col, [("text", "string"), ("n_text_chars", "bigint"), ("n_text_lines", "bigint")], texts)
