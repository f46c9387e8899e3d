"""Text of HTML pages as a reader sees it.

A tree builder opens and closes what the source leaves out. Elements that are not rendered
are passed over with all they hold: by their kind, the ``hidden`` attribute, an inline style,
a plain rule of the page's own style sheets (one tag, class or id), a ``dialog`` or ``details``
that is not open. What remains flows into lines: blocks start and end lines, paragraphs and
headings keep a blank line, list items get a marker and an indent, and cells of a table stand
in columns, also below cells that span rows.

Nesting has no limit; lines are indented for the first ``LEVELS`` levels only. A table is
padded with at most ``PADDING`` characters for each of its own (and a page line): where one
giant cell would take more, wider cells push the rest of their row to the right.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residuum.llm.common import free_name, map_batches, quoted

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("head script style template noscript title meta link base datalist iframe object audio video canvas".split())
#: Not rendered within drawings and formulas.
FOREIGN, FOREIGN_UNSEEN = frozenset(("svg", "math")), frozenset("desc metadata defs symbol annotation annotation-xml".split())
IN_HEAD = frozenset("title meta link script style base noscript template".split())
#: Blocks, and the blank lines that they keep around them.
BLOCKS = dict.fromkeys("address article aside body center dd details dialog div dt fieldset figcaption figure footer form header hgroup html legend li main menu nav optgroup option search section summary table caption tbody thead tfoot tr".split(), 0) | dict.fromkeys("blockquote dl h1 h2 h3 h4 h5 h6 hr ol p pre ul".split(), 1)
#: A start tag of the key closes the nearest open element of the values, if nothing of BOUNDS stands between.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")} | dict.fromkeys(("tbody", "thead", "tfoot"), ("tbody", "thead", "tfoot"))
BOUNDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "optgroup": ("select",)} | dict.fromkeys(("tr", "td", "th", "tbody", "thead", "tfoot"), ("table",))
HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.IGNORECASE)
SHOWN = re.compile(r"(?:display|visibility)\s*:", re.IGNORECASE)
SPACE = re.compile(r"[ \t\n\r\f]+")
RULE = re.compile(r"(?:([a-z][a-z0-9]*)|([.#])([A-Za-z_][\w-]*))\Z")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
#: Levels of indent that show; characters of padding for each character of a table; columns and rows of a cell at most, as browsers have it.
LEVELS, PADDING, COLUMNS, ROWS = 32, 16, 1000, 65534


class Flow:
    """Lines under construction, with collapsed white space, gaps and indents."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = True  # a further space would collapse
        self.gap = 0
        self.indents: list[str] = []
        self.marker = ""

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.split("\n")
            self._add(first)
            for line in rest:
                self.end(True)
                self._add(line)
            return
        data = SPACE.sub(" ", data)
        if self.space and data[:1] == " ":
            data = data[1:]
        self._add(data)

    def _add(self, data: str) -> None:
        if data:
            self.parts.append(data)
            self.space = data[-1] == " "

    def end(self, forced: bool = False) -> None:
        line = "".join(self.parts).rstrip(" \t")
        if line or forced:
            self.write([line])
        self.parts, self.space = [], True

    def write(self, lines: list[str]) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        indent = "".join(self.indents[:LEVELS])
        for line in lines:
            if self.marker and line:
                lead, self.marker = "".join(self.indents[:-1][:LEVELS]) + self.marker, ""
            else:
                lead = indent
            self.lines.append((lead + line).rstrip())

    def block(self, gap: int) -> None:
        self.end()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Cell:
    def __init__(self, columns: int, rows: int):
        self.columns, self.rows, self.at, self.lines = columns, rows, 0, []

    def width(self) -> int:
        return max(map(len, self.lines), default=0)


class Table:
    def __init__(self):
        self.rows: list[list[Cell]] = []

    def _placed(self) -> None:
        """Give each cell its first column; columns that a cell from above holds are passed over."""
        held: list[tuple[int, int, int]] = []  # first column, column after the last, rows left
        room = 100 * sum(map(len, self.rows)) + 100_000
        for row in self.rows:
            room -= len(held)
            at, own, above = 0, [], iter(held)
            next_held = next(above, None)
            for cell in row:
                while next_held and next_held[0] < at + 1:
                    at = max(at, next_held[1])
                    next_held = next(above, None)
                cell.at = at
                at += cell.columns
                if cell.rows > 1:
                    own.append((cell.at, at, cell.rows))
            held = sorted((first, last, left - 1) for first, last, left in [*held, *own] if left > 1) if room > 0 else []

    def _widths(self) -> dict[int, int]:
        """The width of each column that a cell of its own has, gap included."""
        cells = [(c.at, c.width()) for row in self.rows for c in row if c.columns == 1]
        own = sum(len(x) for row in self.rows for c in row for x in c.lines)
        height = sum(max((len(c.lines) for c in row), default=0) for row in self.rows)
        most = max((w for _, w in cells), default=0)
        while True:
            widths: dict[int, int] = {}
            for at, w in cells:
                widths[at] = max(widths.get(at, 0), w + 2 if w <= most else 2)
            if height * sum(widths.values()) <= PADDING * (own + 80 * len(widths)):
                return widths
            if not most:
                return {}
            most //= 2

    def lines(self) -> list[str]:
        self._placed()
        widths = self._widths()
        starts = sorted(widths)
        ends = [0, *accumulate(widths[at] for at in starts)]
        left_of = lambda at: ends[bisect_left(starts, at)]
        out = []
        for row in self.rows:
            for i in range(max((len(c.lines) for c in row), default=0)):
                line, over = "", 0  # over: how far a wide cell has pushed what follows
                for cell in row:
                    if i < len(cell.lines) and cell.lines[i]:
                        place = max(left_of(cell.at) + over, len(line) + 2 if line else 0)
                        over = place - left_of(cell.at)
                        line = line.ljust(place) + cell.lines[i]
                out.append(line.rstrip())
        return out


class Node:
    __slots__ = ("children", "given", "tag")

    def __init__(self, tag: str, given: dict):
        self.tag, self.given, self.children = tag, given, []


class Builder(HTMLParser):
    """Builds the tree of a page; ``at`` has the places of each tag in the open path."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open, self.at, self.styles = [self.root], {}, []

    def _to_end(self, place: int) -> int:
        """What is not closed by the end of the page goes with all that follows, as in browsers."""
        return place if place >= 0 else len(self.rawdata)

    def parse_starttag(self, i):
        return self._to_end(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._to_end(super().parse_endtag(i))

    def parse_comment(self, i, report=1):
        return self._to_end(super().parse_comment(i, report))

    def parse_pi(self, i):
        return self._to_end(super().parse_pi(i))

    def parse_html_declaration(self, i):
        return self._to_end(super().parse_html_declaration(i))

    def parse_marked_section(self, i, report=1):
        """Not of HTML: passed over to its end, like a comment."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def _last(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and any(map(self._last, FOREIGN)) and self.open[-1].tag == tag:
            self._pop()

    def handle_starttag(self, tag, attrs):
        if self._last("head") and tag not in IN_HEAD and tag not in ("head", "html"):
            self._close("head")
        if tag in CLOSES:
            self._close_near(CLOSES[tag], BOUNDS[tag])
        if tag in ("td", "th") and self._last("table") and self._last("tr") < self._last("table"):
            self.handle_starttag("tr", [])
        if tag in BLOCKS and self._last("p"):
            self._close_near(("p",), ("td", "th", "table", "caption", "button", "li", "dd") if tag != "p" else ("td", "th", "table", "caption", "button"))
        node = Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_endtag(self, tag):
        place, table = self._last(tag), self._last("table")
        if not place:
            if tag == "p":
                self.open[-1].children.append(Node("p", {}))
        elif place > table or tag in ("table", "html", "body"):  # else: an end tag does not reach out of its table
            self._close(tag)

    def _close_near(self, tags: tuple[str, ...], bounds: tuple[str, ...]) -> None:
        """Close the nearest open element of ``tags`` if none of ``bounds`` is within it."""
        place = max(map(self._last, tags))
        if place > max(map(self._last, bounds)):
            self._close(self.open[place].tag)

    def _close(self, tag: str) -> None:
        """Close the nearest open ``tag`` and all within."""
        place = self._last(tag)
        while len(self.open) > place:
            self._pop()

    def _pop(self) -> None:
        self.at[self.open.pop().tag].pop()

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._close("head")
        if self.open[-1].tag == "style":
            self.styles.append(data)
        self.open[-1].children.append(data)


class Unseen:
    """What the page's own style sheets hide, by tag, class and id."""

    def __init__(self, sheets: list[str]):
        self.tags, self.classes, self.ids = set(), set(), set()
        kinds = {"": self.tags, ".": self.classes, "#": self.ids}
        for sheet in sheets:
            depth, selector = 0, ""
            for part in re.split(r"([{}])", COMMENT.sub(" ", sheet)):
                if part == "{":
                    depth += 1
                elif part == "}":
                    depth = max(0, depth - 1)
                elif not depth:
                    selector = part.rpartition(";")[2]
                elif depth == 1 and not selector.lstrip().startswith("@"):
                    hides, says = HIDDEN.search(part), SHOWN.search(part)
                    for one in selector.split(",") if hides or says else ():
                        if m := RULE.match(one.strip()):
                            own = kinds[m[2] or ""]
                            (own.add if hides else own.discard)(m[3] or m[1])

    def has(self, node: Node) -> bool:
        given = node.given
        if node.tag in UNSEEN or "hidden" in given or (node.tag == "dialog" and "open" not in given) or HIDDEN.search(given.get("style") or ""):
            return True
        return node.tag in self.tags or (given.get("id") in self.ids) or bool(self.classes and not self.classes.isdisjoint((given.get("class") or "").split()))


def _number(given: dict, name: str, most: int, least: int = 1) -> int:
    text = (given.get(name) or "1").strip()
    return min(most, max(least, int(text))) if text.isascii() and text.isdigit() and len(text) < 9 else 1


class Writer:
    """Walks the tree and writes what is visible."""

    def __init__(self, unseen: Unseen):
        self.unseen = unseen
        self.flows, self.tables, self.lists = [Flow()], [], []
        self.kept = self.foreign = 0  # open elements that keep white space, and drawings or formulas

    def walk(self, root: Node) -> str:
        path = [(root, iter(root.children))]
        summaries: set[int] = set()  # closed ``details`` whose summary has been written
        while path:
            node, rest = path[-1]
            folded = node.tag == "details" and "open" not in node.given
            for child in rest:
                if isinstance(child, str):
                    if not folded:
                        self.flows[-1].text(child, self.kept > 0)
                elif folded and (child.tag != "summary" or id(node) in summaries):
                    continue
                elif not (self.unseen.has(child) or (self.foreign and child.tag in FOREIGN_UNSEEN)):
                    if folded:
                        summaries.add(id(node))
                    if child.tag in VOID:
                        self._void(child.tag)
                    else:
                        self._enter(child)
                        path.append((child, iter(child.children)))
                        break
            else:
                path.pop()
                if path:
                    self._leave(node)
        return "\n".join(self.flows[0].done()).strip("\n")

    def _void(self, tag: str) -> None:
        flow = self.flows[-1]
        if tag == "br":
            flow.end(bool(flow.lines or flow.parts))
        elif tag == "hr":
            flow.block(1)

    def _enter(self, node: Node) -> None:
        tag, flow = node.tag, self.flows[-1]
        self.kept += tag in ("pre", "textarea")
        self.foreign += tag in FOREIGN
        if tag in BLOCKS:
            flow.block(BLOCKS[tag] if not (tag in ("ul", "ol") and self.lists) else 0)
        if tag == "table":
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            rows = _number(node.given, "rowspan", ROWS, 0)
            self.tables[-1].rows[-1].append(Cell(_number(node.given, "colspan", COLUMNS), rows or ROWS))
            self.flows.append(Flow())
        elif tag in ("ul", "ol", "menu"):
            self.lists.append([tag == "ol", _number(node.given, "start", 1 << 30)])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else [False, 1]
            flow.marker = f"{kind[1]}. " if kind[0] else "- "
            kind[1] += 1
            flow.indents.append(" " * len(flow.marker))
        elif tag in ("blockquote", "dd"):
            flow.indents.append("  ")

    def _leave(self, node: Node) -> None:
        tag = node.tag
        self.kept -= tag in ("pre", "textarea")
        self.foreign -= tag in FOREIGN
        if tag in ("td", "th") and self.tables:
            self.tables[-1].rows[-1][-1].lines = self.flows.pop().done()
            return
        flow = self.flows[-1]
        if tag in BLOCKS:
            flow.block(BLOCKS[tag] if not (tag in ("ul", "ol") and len(self.lists) > 1) else 0)
        if tag == "table":
            flow.write(self.tables.pop().lines())
            flow.block(0)
        elif tag in ("ul", "ol", "menu"):
            self.lists.pop()
        elif tag in ("li", "blockquote", "dd"):
            flow.indents.pop()
            if tag == "li":
                flow.marker = ""


def render(html: str | None) -> str:
    """Visible text of a page; null and empty give an empty text."""
    builder = Builder()
    builder.feed(html or "")
    builder.close()
    return Writer(Unseen(builder.styles)).walk(builder.root)


def extract(pages: DataFrame, *, html_col: str = "html", out: str = "text") -> tuple[DataFrame, str]:
    """Every row of ``pages`` without its source and with its visible text, and that column's name.

    Null and empty sources give an empty text; repeated rows each get theirs; an empty table
    gives no rows. Should ``pages`` have a column named ``out``, the new one gets underscores.
    """
    keep = [c for c in pages.columns if c != html_col]
    name = free_name(keep, out)
    rows = pages.select(F.col(quoted(html_col)).alias("__html"), *(F.col(quoted(c)) for c in keep))

    def run(batches):
        for batch in batches:
            texts = [render(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], [*keep, name])

    return map_batches(rows, run, T.StructType([*rows.schema.fields[1:], T.StructField(name, T.StringType())])), name


def digest(found: DataFrame, name: str, id_col: str = "page_id") -> DataFrame:
    lines = F.split(name, "\n", -1)
    blocks = F.size(F.filter(F.split(name, "\n\n+", -1), lambda x: x != ""))
    return found.select(F.col(quoted(id_col)).alias("page_id"), F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"), F.size(F.filter(lines, lambda x: x != "")).cast("long").alias("n_lines"), blocks.cast("long").alias("n_blocks"))
