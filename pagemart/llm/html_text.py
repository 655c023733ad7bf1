"""Layout-aware text of HTML pages.

A page is read once into a tree, with the end tags and elements that HTML lets authors leave out. The tree is
walked without recursion: hidden parts give nothing, blocks start lines, paragraphs and headings stand
apart, lists get their marks and depth, and the cells of a table are aligned in columns.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagemart.llm.base import query, table, text_kept

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
UNSEEN = frozenset("head script style template noscript noembed noframes iframe title datalist object audio video canvas".split())
#: Parts of drawings and formulas that are not shown where they stand.
UNDRAWN = frozenset("title desc defs metadata symbol clippath mask pattern marker annotation annotation-xml".split())
DRAWN = ("svg", "math")
BLOCKS = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table ul caption".split()
)
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl menu figure".split())
CLOSES_P = (BLOCKS - {"body", "html", "option", "legend", "caption"}) | {"table"}
#: An opening tag ends these open elements, up to the nearest of the walls.
ENDS = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist"),
    "optgroup": ("option optgroup", "select"), "tr": ("td th tr caption colgroup", "table"), "td": ("td th caption colgroup", "tr table"),
    "th": ("td th caption colgroup", "tr table"), "thead": ("td th tr tbody thead tfoot caption colgroup", "table"),
    "tbody": ("td th tr tbody thead tfoot caption colgroup", "table"), "tfoot": ("td th tr tbody thead tfoot caption colgroup", "table"),
    "body": ("head", "html"),
}
ENDS = {name: (frozenset(a.split()), frozenset(b.split())) for name, (a, b) in ENDS.items()}
WALLS = frozenset("table td th caption template html button object".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
GAP = re.compile(r"[ \t\n\r\f]+")
#: Spaces that only lay out a column or a page, for each sign of its text or markup.
ROOM = 16
#: What a line costs each time a table composes it.
LINE = 8
#: The most columns and rows a cell may span, by the HTML standard.
SPANS = {"colspan": 1000, "rowspan": 65534}


class Node:
    __slots__ = ("name", "marks", "children")

    def __init__(self, name: str, marks: dict[str, str] | None = None):
        self.name, self.marks, self.children = name, marks or {}, []


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', text, ''), ('open', name, attributes) and ('close', name, ''), in one pass."""
    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        mark = page.find("<", at)
        if mark == -1:
            yield "text", page[at:], ""
            return
        if mark > at:
            yield "text", page[at:mark], ""
        sign = page[mark + 1 : mark + 2]
        if sign == "!" or sign == "?":
            stop = page.find("-->", mark + 4) if page.startswith("<!--", mark) else page.find(">", mark)
            if page.startswith("<!-->", mark):
                stop = mark + 2
            if stop == -1:
                return
            at = stop + (3 if page.startswith("<!--", mark) else 1)
            continue
        if not (sign.isascii() and sign.isalpha()) and not (sign == "/" and page[mark + 2 : mark + 3].isalpha()):
            yield "text", "<", ""
            at = mark + 1
            continue
        if mark > last:  # a tag that never ends
            return
        found = TAG.match(page, mark) or LOOSE.match(page, mark)
        if not found:
            yield "text", "<", ""
            at = mark + 1
            continue
        at, name = found.end(), found[2].lower()
        if found[1]:
            yield "close", name, ""
            continue
        yield "open", name, found[3]
        if name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            yield "text", page[at : stop.start() if stop else end], ""
            at = stop.start() if stop else end


class Builder:
    """The open elements as a stack; for each name the places where it is open, so no close walks the stack."""

    def __init__(self):
        self.root = Node("html")
        self.stack, self.places = [self.root], {"html": [0]}

    def top(self, names) -> int:
        return max((p[-1] for n in names if (p := self.places.get(n))), default=-1)

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.places.setdefault(node.name, []).append(len(self.stack))
        self.stack.append(node)

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop().name].pop()

    def open(self, name: str, raw: str) -> None:
        if name in ("html", "body") and self.places.get(name):
            return
        marks = {}
        if raw and not raw.isspace():
            for key, a, b, c in ATTRIBUTE.findall(raw):
                marks.setdefault(key.lower(), a or b or c)
        if name in ENDS:
            ended, walls = ENDS[name]
            wall = self.top(walls)
            inner = [p[k] for n in ended if (p := self.places.get(n)) and (k := bisect_right(p, wall)) < len(p)]
            if inner:
                self.pop_to(min(inner))
        if name in CLOSES_P and self.places.get("p") and self.places["p"][-1] > self.top(WALLS):
            self.pop_to(self.places["p"][-1])
        if name in ("td", "th") and self.top(("tr",)) < self.top(("table",)):
            self.push(Node("tr"))
        node = Node(name, marks)
        drawn = self.top(DRAWN) >= 0
        if name in VOID or (drawn and raw.endswith("/")):
            self.stack[-1].children.append(node)
        else:
            self.push(node)

    def close(self, name: str) -> None:
        own = self.places.get(name)
        if name == "br":
            self.stack[-1].children.append(Node("br"))
        elif own and own[-1] and (name in WALLS or own[-1] > self.top(WALLS)):
            self.pop_to(own[-1])
        elif own and own[-1] and name in ("tr", "thead", "tbody", "tfoot") and own[-1] > self.top(("table",)):
            self.pop_to(own[-1])

    def text(self, text: str) -> None:
        self.stack[-1].children.append(text)


def tree(page: str) -> Node:
    made = Builder()
    for kind, value, raw in tokens(page):
        if kind == "text":
            made.text(html.unescape(value) if "&" in value and made.stack[-1].name not in ("script", "style") else value)
        elif kind == "open":
            made.open(value, raw)
        else:
            made.close(value)
    return made.root


DRAWING = ("display", "visibility")


def styled(node: Node, drawn: bool) -> dict[str, str]:
    """``display`` and ``visibility`` as the element itself states them, in drawings by attributes, too; the last one holds."""
    marks = node.marks
    found = {k: marks[k].lower() for k in DRAWING if k in marks} if drawn else {}
    if "style" in marks:
        found.update((k.lower(), v.lower()) for k, v in STYLE.findall(html.unescape(marks["style"])))
    return found


def hidden(node: Node, style: dict[str, str], drawn: bool) -> bool:
    """Whether the element and all in it give nothing, whatever its parts say."""
    return (
        node.name in UNSEEN or "hidden" in node.marks or node.name == "input" or (drawn and node.name in UNDRAWN)
        or style.get("display") == "none"
    )


def seen(style: dict[str, str], inherited: bool) -> bool:
    """Visibility is handed down, and an element may turn it on again."""
    own = style.get("visibility", "inherit")
    return inherited if own in ("inherit", "unset") else own not in ("hidden", "collapse")


class Room:
    """What a page may still spend on layout: its spaces, its lines each time a table composes them, its spans in each row."""

    def __init__(self, left: int):
        self.left = left

    def take(self, most: int) -> bool:
        self.left = self.left - most if most <= self.left else 0
        return self.left > 0


class Box:
    """Lines of a page or of one cell. ``gap`` counts the empty lines owed before the next one."""

    def __init__(self, room: Room):
        self.room = room
        #: Texts, and lists of lines that stand as they are.
        self.lines: list = []
        self.words: list[str] = []
        self.indent, self.mark, self.gap, self.kept = 0, "", 0, 0

    def add(self, text: str) -> None:
        if self.kept:
            first, *more = text.split("\n")
            self.words.append(first)
            for line in more:
                self.end_line(True)
                self.words.append(line)
        else:
            self.words.append(text)

    def space(self) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0

    def end_line(self, always: bool = False) -> None:
        text = "".join(self.words)
        self.words = []
        text = text.rstrip() if self.kept else GAP.sub(" ", text).strip(" ")
        if text or always:
            self.space()
            if text and (self.indent or self.mark):
                before = 2 * self.indent + len(self.mark)
                text = (" " * (2 * self.indent) + self.mark if self.room.take(before) else self.mark.lstrip(" ")) + text
            self.lines.append(text)
            if self.mark:
                self.mark = " " * len(self.mark)

    def put(self, lines: list[str]) -> None:
        self.end_line()
        kept, self.kept = self.kept, 1
        for line in lines:
            self.words.append(line)
            self.end_line(True)
        self.kept = kept

    def put_plain(self, lines: list) -> None:
        """Lines under the last one, not indented and not looked at."""
        self.end_line()
        if lines:
            self.space()
            if self.mark.strip():
                self.lines.append(self.mark.rstrip())
                self.mark = " " * len(self.mark)
            self.lines.append(lines)

    def text(self) -> str:
        out, open_lists = [], [iter(self.lines)]
        while open_lists:
            line = next(open_lists[-1], None)
            if line is None:
                open_lists.pop()
            elif isinstance(line, str):
                out.append(line)
            else:
                open_lists.append(iter(line))
        return "\n".join(out)


class Grid:
    """Rows of cells as (column, lines). Spans are kept as ranges of columns with the last row they reach into."""

    def __init__(self, room: Room):
        self.room, self.rows = room, []
        self.spans, self.new = np.empty((0, 3), np.int64), []
        self.column = self.next = 0

    def row(self) -> None:
        if self.new:
            spans = np.concatenate([self.spans, np.array(self.new, np.int64)])
            self.spans, self.new = spans[np.argsort(spans[:, 0], kind="stable")], []
        self.spans = self.spans[self.spans[:, 2] >= len(self.rows)] if len(self.spans) else self.spans
        if len(self.spans) and self.room.take(1 + len(self.spans) // 4):
            # Ranges that touch are one, so a cell steps over them at once.
            reach = np.maximum.accumulate(self.spans[:, 1])
            first = np.append(True, self.spans[1:, 0] > reach[:-1])[: len(reach)]
            self.taken = self.spans[first, 0], reach[np.append(first[1:], True)[: len(reach)]]
        else:
            self.spans, self.taken = self.spans[:0], ((), ())
        self.rows.append([])
        self.column = self.next = 0

    def cell(self, lines: list, marks: dict[str, str]) -> None:
        if not self.rows:
            self.row()
        starts, stops = self.taken
        while self.next < len(starts) and starts[self.next] <= self.column:
            self.column = max(self.column, int(stops[self.next]))
            self.next += 1
        across, down = (span_of(marks, key) for key in SPANS)
        self.rows[-1].append((self.column, lines))
        if down > 1 and self.room.left > 0:
            self.new.append((self.column, self.column + across, len(self.rows) + down - 2))
        self.column += across

    def lines(self) -> list[str] | None:
        """The rows with their cells in columns; nothing once the page has no room for that."""
        room = self.room
        if room.left <= 0:
            return None
        lengths: dict[int, list[int]] = {}
        for row in self.rows:
            for column, cell in row:
                lengths.setdefault(column, []).extend(map(len, cell))
        # A column in which no cell begins takes no place.
        place, at = {}, 0
        for column in sorted(lengths):
            width = width_of(lengths[column])
            place[column] = at, width
            at += width + 2
        out = []
        for row in self.rows:
            held, n = [(*place[column], cell) for column, cell in row if cell], 0
            while held:
                parts, end, shift, spent = [], 0, 0, LINE
                for start, width, cell in held:
                    if cell[n]:
                        gap = start + shift - end
                        spent += gap
                        if spent > room.left:
                            room.left = 0
                            return None
                        parts += [" " * gap, cell[n]]
                        shift += max(len(cell[n]) - width, 0)
                        end += gap + len(cell[n])
                room.left -= spent
                out.append("".join(parts).rstrip(" "))
                n += 1
                held = [h for h in held if len(h[2]) > n]
        return out


def span_of(marks: dict[str, str], key: str) -> int:
    digits = marks.get(key, "").strip().lstrip("0")
    return min(int(digits[:6]), SPANS[key]) if digits.isascii() and digits.isdecimal() else 1


def width_of(lengths: list[int]) -> int:
    """The longest line that all shorter ones can be padded to for ``ROOM`` spaces a sign of the column and of its gaps."""
    most, kept = ROOM * (sum(lengths) + 2 * len(lengths)), 0
    best = before = 0
    for n, length in enumerate(sorted(lengths)):
        kept += n * (length - before)
        if kept > most:
            break
        best = before = length
    return best


def number_of(marks: dict[str, str], key: str, other: int) -> int:
    value = marks.get(key, "")
    return int(value) if re.fullmatch(r"-?\d{1,9}", value) else other


def rendered(root: Node, room: int) -> str:
    """The visible text of a tree, line by line, with ``room`` spaces for its layout."""
    boxes, grids, lists = [Box(Room(room))], [], []
    walk = [(root, iter(root.children), True, False)]
    while walk:
        node, rest, shown, drawn = walk[-1]
        child = next(rest, None)
        box = boxes[-1]
        if child is None:
            walk.pop()
            if drawn and node.name == "text":
                box.add(" ")
            _leave(node, boxes, grids, lists)
        elif isinstance(child, str):
            if shown and not (node.name in ("table", "tr", "tbody", "thead", "tfoot", "ul", "ol", "select") and child.isspace()):
                box.add(child)
        else:
            drawing = drawn or child.name in DRAWN
            style = styled(child, drawing) if child.marks else {}
            if hidden(child, style, drawn):
                continue
            inside = seen(style, shown)
            if drawing and child.name == "text":  # labels stand apart
                box.add(" ")
            _enter(child, boxes, grids, lists, inside)
            walk.append((child, iter(child.children), inside, drawing))
    boxes[0].end_line()
    return boxes[0].text()


def _enter(node: Node, boxes: list[Box], grids: list[Grid], lists: list[list[int]], shown: bool) -> None:
    box, name = boxes[-1], node.name
    if name == "br":
        box.end_line(shown)
    elif name == "img":
        if shown and node.marks.get("alt"):
            box.add(html.unescape(node.marks["alt"]))
    elif name == "table":
        box.end_line()
        box.gap = 1
        grids.append(Grid(box.room))
    elif name == "tr" and grids:
        grids[-1].row()
    elif name in ("td", "th", "caption") and grids:
        boxes.append(Box(box.room))
    elif name in BLOCKS:
        box.end_line()
        if name in APART and not (name in ("ul", "ol", "menu") and lists):
            box.gap = 1
        if name == "hr":
            box.put(["---"] if shown else [])
        elif name in ("ul", "ol", "menu"):
            lists.append([number_of(node.marks, "start", 1) if name == "ol" else 0, int(name == "ol")])
            box.indent += len(lists) > 1
        elif name == "li":
            if lists and lists[-1][1]:
                number = number_of(node.marks, "value", lists[-1][0])
                lists[-1][0] = number + 1
                box.mark = f"{number}. " if shown else ""
            else:
                box.mark = "- " if shown else ""
        elif name in ("dd", "blockquote"):
            box.indent += 1
        elif name == "pre":
            box.kept += 1


def _leave(node: Node, boxes: list[Box], grids: list[Grid], lists: list[list[int]]) -> None:
    box, name = boxes[-1], node.name
    if name in ("td", "th", "caption") and grids and len(boxes) > 1:
        box.end_line()
        lines = boxes.pop().lines
        if name == "caption":
            (boxes[-1].put if box.room.take(LINE * len(lines) + 1) else boxes[-1].put_plain)(lines)
        else:
            grids[-1].cell(lines, node.marks)
    elif name == "table":
        grid = grids.pop()
        lines = grid.lines()
        if lines is None:
            for row in grid.rows:
                for _, cell in row:
                    box.put_plain(cell)
        else:
            box.put(lines)
        box.gap = 1
    elif name in BLOCKS and name != "hr":
        box.end_line()
        if name in APART and not (name in ("ul", "ol", "menu") and len(lists) > 1):
            box.gap = 1
        if name in ("ul", "ol", "menu"):
            lists.pop()
            box.indent -= len(lists) > 0
        elif name == "li":
            box.mark = ""
        elif name in ("dd", "blockquote"):
            box.indent -= 1
        elif name == "pre":
            box.kept -= 1


def page_text(page: str | None) -> str:
    return rendered(tree(page or ""), ROOM * len(page or ""))


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row: id and ``text``, all the visible text of the page.

    A null or empty page, and one without visible text, gives an empty text. Broken markup never fails: a tag
    that does not end hides what follows, as in a browser. Repeated rows are each returned; an empty table
    gives no rows; other columns are not read. A column of a table is as wide as its longest line, if padding the others to
    that takes at most ``ROOM`` spaces a sign of its text; else as the longest for which it does, and longer lines run over.
    Tables in tables and lists in lists are laid out at any depth, until the layout has taken ``ROOM`` spaces a sign of the
    page: what follows is not indented, and its tables are read cell by cell. Text in drawings and formulas is shown where it stands, their titles and
    notes are not. ``visibility`` is handed down to the parts of an element, which may turn it on again.
    """
    kind = dict(pages.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(p) for p in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=[id_col, "text"])

    return text_kept(pages.select(id_col, html_col), html_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible_text(table(spark, sf_dir, "pages"))
