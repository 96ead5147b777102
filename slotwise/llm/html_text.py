"""Text of web pages as they are laid out: a tree with implied tags, visibility rules, lists and aligned tables."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "area base basefont datalist head link meta noembed noframes noscript param rp script style template title "
    "iframe object video audio canvas svg".split()
)
#: Blocks with a blank line around them, and without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr menu".split())
TIGHT = frozenset(
    "address article aside body center dd details dialog div dt figcaption footer form header hgroup html legend li "
    "main nav optgroup section summary tr caption thead tbody tfoot".split()
)
BLOCKS = SPACED | TIGHT
#: What an opening tag closes if it is open, and what it does not look beyond for it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
CELL_BOUNDS = frozenset({"td", "th", "caption", "table", "html"})
TABLE_PARTS = frozenset({"table", "tr", "td", "th", "tbody", "thead", "tfoot"})
#: Elements that are laid out by themselves; all others are their contents, set off where they are blocks.
OWN_LAYOUT = frozenset("br hr pre ul ol menu table blockquote dd select input".split())

#: Columns that a line is set in by at most, for lists and quotes however deep.
MAX_INDENT = 200
#: Most columns and rows that a cell spans; fixed values of the HTML standard.
MAX_SPAN = {"colspan": 1000, "rowspan": 65534}

_SPACES = re.compile(r"[ \t\n\r\f]+")
_CSS_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SIMPLE = re.compile(r"([a-z][a-z0-9-]*|\*)?(?:([.#])([\w-]+))?$", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "rows")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.rows = False  # whether rows of the table around it are below it


class TreeBuilder(HTMLParser):
    """A tree for any markup: missing end tags are implied, stray ones ignored, head and body need no tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag, but the root
        self.styles: list[str] = []

    def _close(self, at: int) -> None:
        """Closes the open elements from place ``at`` on."""
        for node in reversed(self.open[at:]):
            self.places[node.tag].pop()
        del self.open[at:]

    def _innermost(self, tags) -> int:
        return max((self.places[x][-1] for x in tags if self.places.get(x)), default=0)

    def _pop(self, tags: set[str], bounds) -> None:
        """Closes the outermost open element of ``tags`` that no element of ``bounds`` encloses from within."""
        bound, found = self._innermost(bounds), []
        for places in (self.places[x] for x in tags if self.places.get(x)):
            found += places[(k := bisect_right(places, bound)) : k + 1]
        if found:
            self._close(min(found))

    def handle_starttag(self, tag: str, attrs) -> None:
        found: dict[str, str] = {}
        for name, value in attrs:
            found.setdefault(name, value or "")
        if tag == "html":
            return
        if tag in BLOCKS:
            self._pop({"p"}, CELL_BOUNDS | {"button"})
        if tag not in HIDDEN and self.places.get("head"):
            self._pop({"head"}, ())
        if tag in CLOSES:
            self._pop(*CLOSES[tag])
        node = Node(tag, found)
        if tag == "tr":
            for around in reversed(self.open):
                if around.rows or around.tag == "table":
                    break
                around.rows = True
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.places[tag].append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        places = self.places.get(tag)
        if places and (tag in TABLE_PARTS or places[-1] >= self._innermost(CELL_BOUNDS)):
            self._close(places[-1])

    def handle_data(self, data: str) -> None:
        inner = self.open[-1]
        if inner.tag == "style":
            self.styles.append(data)
        elif inner.tag == "head" and data.strip():
            self._pop({"head"}, ())
            inner = self.open[-1]
        inner.children.append(data)

    def unknown_decl(self, data: str) -> None:
        pass


def _hides(declarations: str) -> bool | None:
    """True for what takes text away, False for what brings it back, None for neither."""
    found: dict[str, bool] = {}
    for part in declarations.lower().split(";"):
        name, _, value = part.partition(":")
        name, value = name.strip(), value.replace("!important", "").strip()
        if name in ("display", "visibility"):  # the last one counts
            found[name] = value == "none" if name == "display" else value in ("hidden", "collapse")
    return any(found.values()) if found else None


def _on_screen(sheet: str) -> str:
    """The rules of a sheet, with those for screens and without those under other conditions."""
    sheet, out, at = re.sub(r"(?s)/\*.*?\*/", "", sheet), [], 0
    for m in re.finditer(r"(?i)@([\w-]+)([^{};]*)([{;])", sheet):
        if m.start() < at:
            continue
        out.append(sheet[at : m.start()])
        at = m.end()
        if m[3] == "{":
            depth = 1
            for brace in re.finditer(r"[{}]", sheet[at:]):
                depth += 1 if brace[0] == "{" else -1
                if not depth:
                    break
            inner = sheet[at : at + brace.start()] if not depth else sheet[at:]
            at += len(inner) + 1
            if m[1].lower() == "media" and re.fullmatch(r"(?i)\s*(only\s+)?(all|screen)\s*", m[2]):
                out.append(inner)
    return "".join(out) + sheet[at:]


def hidden_by_sheets(styles: list[str]) -> set[tuple[str, str, str]]:
    """(tag, '.' or '#', name) of the simple selectors that hide elements; later rules win over earlier ones."""
    out: dict[tuple[str, str, str], bool] = {}
    for sheet in styles:
        for selectors, declarations in _CSS_RULE.findall(_on_screen(sheet)):
            hides = _hides(declarations)
            for selector in selectors.split(",") if hides is not None else ():
                if (m := _SIMPLE.fullmatch(selector.strip())) and selector.strip():
                    out[((m[1] or "*").lower(), m[2] or "", m[3] or "")] = hides
    return {key for key, hides in out.items() if hides}


def flat(entries: list) -> list[str]:
    """Lines of text out of lines and (mark, entries): the mark stands before the
    first line of its entries, and they are set in by its width.

    Marks are written once whatever encloses them, and lines are set in by
    ``MAX_INDENT`` at most. So the text stays in proportion to the page.
    """
    out: list[str] = []
    marks: list[str] = []
    waiting, start = [(iter(entries), 0)], 0
    while waiting:
        rest, indent = waiting[-1]
        for entry in rest:
            if isinstance(entry, str):
                before = " " * start + "".join(marks) if marks else " " * indent
                out.append(before + entry if entry or before.strip() else "")
                marks = []
            else:
                if not marks:
                    start = indent
                marks.append(entry[0])
                waiting.append((iter(entry[1]), min(indent + len(entry[0]), MAX_INDENT)))
                break
        else:
            waiting.pop()
    return out


class Lines:
    """Lines of text in the making, as ``flat`` takes them: inline text is gathered until a block begins or ends."""

    def __init__(self):
        self.lines: list[str | tuple[str, list]] = []
        self.inline: list[str] = []
        self.gap = 0

    def _add(self, lines: list) -> None:
        if lines:
            if self.lines:
                self.lines += [""] * self.gap
            self.lines += lines
            self.gap = 0

    def flush(self) -> None:
        if self.inline:
            text = _SPACES.sub(" ", "".join(self.inline)).strip(" ").replace("\xa0", " ")
            self.inline = []
            if text.strip():
                self._add([text])

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)

    def whole(self, lines: list, gap: int) -> None:
        self.block(gap)
        self._add(lines)
        self.gap = max(self.gap, gap)


def _run(step: Generator):
    """The value that ``step`` returns; what it yields are steps whose values it is sent. So calls may nest at any depth."""
    steps, value = [step], None
    while steps:
        try:
            inner = steps[-1].send(value)
        except StopIteration as done:
            steps.pop()
            value = done.value
        else:
            steps.append(inner)
            value = None
    return value


class Renderer:
    """Lays out a tree. Generators are steps for ``_run``, but for ``inside``."""

    def __init__(self, hidden: set[tuple[str, str, str]]):
        self.hidden = hidden

    def _unseen(self, node: Node) -> bool:
        a = node.attrs
        if node.tag in HIDDEN or "hidden" in a or node.tag == "input" and a.get("type", "").lower() == "hidden":
            return True
        if node.tag == "dialog" and "open" not in a:
            return True
        if "style" in a and (own := _hides(a["style"])) is not None:
            return own
        if self.hidden:
            names = [("", ""), *((".", c) for c in a.get("class", "").split())]
            if "id" in a:
                names.append(("#", a["id"]))
            return any((tag, kind, name) in self.hidden for tag in (node.tag, "*") for kind, name in names)
        return False

    def lines(self, node: Node) -> Generator:
        out = Lines()
        yield self.children(node.children, out)
        out.flush()
        return out.lines

    def children(self, nodes: list, out: Lines) -> Generator:
        waiting: list[tuple[Iterator, int | str | None]] = [(iter(nodes), None)]
        while waiting:
            rest, after = waiting[-1]
            for child in rest:
                if isinstance(child, str):
                    out.inline.append(child)
                elif self._unseen(child):
                    continue
                elif child.tag in OWN_LAYOUT or child.tag == "details" and "open" not in child.attrs:
                    yield self.element(child, out)
                else:
                    after = None
                    if child.tag in BLOCKS:
                        after = 1 if child.tag in SPACED else 0
                        out.block(after)
                    elif child.tag in ("td", "th"):  # outside of a table
                        after = " "
                        out.inline.append(after)
                    waiting.append((iter(child.children), after))
                    break
            else:
                waiting.pop()
                if isinstance(after, str):
                    out.inline.append(after)
                elif after is not None:
                    out.block(after)

    def element(self, node: Node, out: Lines) -> Generator:
        tag = node.tag
        if tag == "br":
            out.flush()
        elif tag == "hr":
            out.whole([], 1)
        elif tag == "pre":
            text = self.raw(node).removeprefix("\n").rstrip()
            out.whole([line.rstrip("\r") for line in text.split("\n")] if text else [], 1)
        elif tag in ("ul", "ol", "menu"):
            out.whole((yield self.list_lines(node)), 1)
        elif tag == "table":
            out.whole((yield self.table_lines(node)), 1)
        elif tag == "blockquote":
            lines = yield self.lines(node)
            out.whole([("  ", lines)] if lines else [], 1)
        elif tag == "dd":
            lines = yield self.lines(node)
            out.whole([("  ", lines)] if lines else [], 0)
        elif tag == "select":
            options = [x for x in self.inside(node, {"option"}, {"select"}) if not self._unseen(x)]
            chosen = [x for x in options if "selected" in x.attrs] or options[:1]
            texts = []
            for x in chosen:
                texts += flat((yield self.lines(x)))
            out.inline.append(" ".join(texts))
        elif tag == "input":
            if node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                out.inline.append(node.attrs.get("value", ""))
        else:  # details that are not open
            shown = Node("details", {"open": ""})
            shown.children = [x for x in node.children if isinstance(x, Node) and x.tag == "summary"][:1]
            yield self.children([shown], out)

    def raw(self, node: Node) -> str:
        out, waiting = [], [iter(node.children)]
        while waiting:
            for child in waiting[-1]:
                if isinstance(child, str):
                    out.append(child)
                elif child.tag == "br":
                    out.append("\n")
                elif not self._unseen(child):
                    waiting.append(iter(child.children))
                    break
            else:
                waiting.pop()
        return "".join(out)

    def inside(self, node: Node, tags: set[str], bounds: set[str]) -> Iterator[Node]:
        """The outermost elements of ``tags``, not looking into others of ``bounds`` or unseen ones."""
        waiting = [iter(node.children)]
        while waiting:
            for child in waiting[-1]:
                if isinstance(child, Node):
                    if child.tag in tags:
                        yield child
                    elif child.tag not in bounds and not self._unseen(child):
                        waiting.append(iter(child.children))
                        break
            else:
                waiting.pop()

    def list_lines(self, node: Node) -> Generator:
        start = node.attrs.get("start", "")
        number = int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1
        out = Lines()
        for child in node.children:
            if isinstance(child, str):
                out.inline.append(child)
            elif self._unseen(child):
                continue
            elif child.tag == "li":
                mark = f"{number}. " if node.tag == "ol" else "- "
                number += 1
                lines = yield self.lines(child)
                if lines:
                    out.whole([(mark, lines)], 0)
            else:
                yield self.children([child], out)
        out.flush()
        return out.lines

    def table_lines(self, table: Node) -> Generator:
        """Captions, then rows with their cells in columns of equal width; text outside of cells comes first."""
        out = Lines()
        for part in (yield self.stray(table)):
            out.whole(part, 0)
        grid: list[dict[int, list[str]]] = []
        ends: list[int] = []
        below: dict[int, float] = {}  # the last row that a cell above covers, by column
        for n, row in enumerate(x for x in self.inside(table, {"tr"}, {"table"}) if not self._unseen(x)):
            cells: dict[int, list[str]] = {}
            column = 0
            for cell in row.children:
                if isinstance(cell, Node) and cell.tag in ("td", "th") and not self._unseen(cell):
                    while below.get(column, -1) >= n:
                        column += 1
                    width, height = self.span(cell, "colspan") or 1, self.span(cell, "rowspan")
                    if height != 1:
                        below |= dict.fromkeys(range(column, column + width), n + height - 1 if height else math.inf)
                    cells[column] = flat((yield self.lines(cell)))
                    column += width
            grid.append(cells)
            ends.append(column)
        widths: dict[int, int] = {}
        for cells, end in zip(grid, ends, strict=True):
            for c, lines in cells.items():
                if c + 1 >= end or cells.get(c + 1):  # a cell over several columns does not widen its first
                    widths[c] = max([widths.get(c, 0), *map(len, lines)])
        starts, at = {}, 0
        for c in sorted({c for cells in grid for c in cells}):
            starts[c] = at
            at += widths[c] + 2 if widths.get(c) else 0
        for cells in grid:
            left, i = sorted(cells.items()), 0
            while left := [(c, lines) for c, lines in left if i < len(lines)]:
                line = ""
                for c, lines in left:
                    if lines[i]:
                        at = starts[c]
                        line = (line.ljust(at) if not line or len(line) + 2 <= at else line + "  ") + lines[i]
                out.whole([line.rstrip()], 0)
                i += 1
        return out.lines

    @staticmethod
    def span(cell: Node, name: str) -> int:
        """0 is up to the end of the table."""
        value = cell.attrs.get(name, "").strip()
        return min(int(value[:9]), MAX_SPAN[name]) if re.fullmatch(r"[0-9]+", value) else 1

    def stray(self, node: Node) -> Generator:
        """The lines of captions and of what stands between rows and cells."""
        rest, parts = Node("div", {}), []
        for child in node.children:
            if isinstance(child, str):
                rest.children.append(child)
            elif self._unseen(child):
                continue
            elif child.tag == "tr":
                inner = Node("div", {})
                inner.children = [x for x in child.children if isinstance(x, str) or x.tag not in ("td", "th")]
                parts += yield self.stray(inner)
            elif child.tag in ("thead", "tbody", "tfoot"):
                parts += yield self.stray(child)
            elif child.rows and child.tag != "table":  # its rows are laid out with the others
                if lines := (yield self.lines(rest)):
                    parts.append(lines)
                rest = Node("div", {})
                parts += yield self.stray(child)
            elif child.tag not in ("colgroup", "col"):
                rest.children.append(child)
        if lines := (yield self.lines(rest)):
            parts.append(lines)
        return parts


def _without_open_tags(html: str) -> str:
    """``html`` with tags that never end as text: the parser would look for the end of each through all that follows."""
    last = html.rfind(">") + 1
    return html[:last] + re.sub(r"<(?=[A-Za-z/])", "&lt;", html[last:]) if html.count("<", last) > 1 else html


def page_text(html: str | None) -> str:
    """All visible text, its blocks, lists and table cells laid out in lines. Empty for null."""
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(_without_open_tags(html))
    builder.close()
    return "\n".join(flat(_run(Renderer(hidden_by_sheets(builder.styles)).lines(builder.root))))


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the visible text of html; a column of that name is replaced.

    Null and empty html give an empty text; every row is taken on its own, so
    repeated rows, null ids and other columns do not matter.
    """

    @F.pandas_udf("string")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(page_text, na_action=None).astype(object)

    return pages.drop("text").withColumn("text", render("html"))
