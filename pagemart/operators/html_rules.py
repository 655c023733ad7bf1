"""Rule lists applied to pages of markup.

``extract_rules`` parses each page once, for all rules, inside an Arrow batch, and gives one row per
page (or per scope node of a page) with one array of values per rule. Nothing is shuffled; typing,
cleaning and joining are left to the caller's column expressions.

Selectors: ``tag``, ``.class``, ``#id``, ``[attr=value]``, ``:nth-of-type(n)``, ``:first-of-type``,
``:last-child``, ``:contains("text")`` (own text), descendant and child (``>``) steps, then
``::text`` (own text nodes), ``::attr(name)`` or nothing (the element's markup). A bare ``::text`` or
``::attr(name)`` reads the scope node and all below it, a bare ``::self(name)`` the node's own
attribute. Any other form is refused.
"""

from __future__ import annotations

import bisect
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parser goes to the workers with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and elements that end an open one of the given kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body div dl fieldset footer form h1 h2 h3 h4 h5 h6 header html "
    "li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    **dict.fromkeys(BLOCKS - {"li", "td", "th", "tr", "tbody", "body", "html"}, {"p"}),
}
P_FENCE = BLOCKS - {"p"}
FENCES = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}}
RAW_TEXT = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style", "title", "textarea")
}

# A comment's start, a start or end tag with its attributes, or a declaration. The parts are possessive, and
# the search ends at the last '>' of the page, so no try reads to the end in vain.
_TOKEN = re.compile(
    r"""<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+"""
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)>|[!?][^>]*+>)"""
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+"""
)
_STEP = re.compile(
    r'\s*(>?)\s*([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[\w-]+(?:=(?:"[^"]*"|[^\]"]*))?\]'
    r'|:nth-of-type\(\d+\)|:first-of-type|:last-child|:contains\("[^"]*"\))*)'
)
_PART = re.compile(r'([.#])([\w-]+)|\[([\w-]+)(?:="?([^"\]]*)"?)?\]|:([\w-]+)(?:\("?([^")]*)"?\))?')

# Pages turned into Python texts at a time.
SLICE = 256


class Step(NamedTuple):
    child: bool
    tag: str | None
    ids: tuple
    classes: tuple
    attrs: tuple
    tests: tuple


class Rule(NamedTuple):
    """A named selector.

    ``each`` gives one value per node it selects: the selector's first match there, or NULL, so that
    rules with the same ``each`` have arrays of equal length. ``at`` is where the selector starts:
    the scope node, its parent, or the whole page.
    """

    name: str
    selector: str
    each: str | None = None
    at: str = "scope"


def _parse_selector(selector: str) -> tuple[list[Step], str, str]:
    """(steps, what to read, attribute name) of a selector text."""
    path, _, reading = selector.partition("::")
    what, name = "markup", ""
    if reading == "text":
        what = "text"
    elif reading.startswith("attr(") and reading.endswith(")"):
        what, name = "attr", reading[5:-1]
    elif reading.startswith("self(") and reading.endswith(")") and not path:
        what, name = "self", reading[5:-1]
    elif reading:
        raise ValueError(f"selector not supported: {selector}")
    steps, at, path = [], 0, path.strip()
    while at < len(path):
        found = _STEP.match(path, at)
        if found.end() == at or not (found[2] or found[3]):
            raise ValueError(f"selector not supported: {selector}")
        ids, classes, attrs, tests = [], [], [], []
        for kind, word, attr, value, test, argument in _PART.findall(found[3]):
            if kind:
                (ids if kind == "#" else classes).append(word)
            elif attr:
                attrs.append((attr.lower(), value if "=" in found[3] else None))
            else:
                tests.append((test, argument))
        tag = None if found[2] in (None, "", "*") else found[2].lower()
        steps.append(Step(bool(found[1]), tag, tuple(ids), tuple(classes), tuple(attrs), tuple(tests)))
        at = found.end()
        if at < len(path) and not (path[at].isspace() or path[at] == ">"):
            raise ValueError(f"selector not supported: {selector}")
    return steps, what, name


class _Tree:
    """Elements of a page in document order, as parallel lists.

    Attributes stay raw text until a rule asks for them, except on elements with a class or an id.
    """

    def __init__(self, source: str):
        self.source = source
        self.tag: list[str] = []
        self.raw: list[str] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.start_at: list[int] = []
        self.end_at: list[int] = []
        self.classes: dict[int, list[str]] = {}
        self.index: dict[str, list[int]] = defaultdict(list)
        self.texts: list[tuple[int, str]] = []
        self.own: dict[int, list[str]] = defaultdict(list)
        self._attributes: dict[int, dict[str, str]] = {}
        self._places: tuple[list[int], dict[int, int]] | None = None
        self.open: list[int] = []
        # Depths in ``open``, ascending: per tag, of blocks, and of blocks that end a search for an open p.
        self.depths: dict[str, list[int]] = defaultdict(list)
        self.walls: list[int] = []
        self.fences: list[int] = []
        self._read()
        while self.open:
            self._pop(len(source))

    def _read(self) -> None:
        source, at, size = self.source, 0, len(self.source)
        last = source.rfind(">") + 1
        while at < size:
            found = _TOKEN.search(source, at, last)
            stop = found.start() if found else size
            if not found and (comment := source.find("<!--", max(at, last))) >= 0:
                stop = comment
            if stop > at:
                self._text(source[at:stop])
            if not found:
                return
            at = found.end()
            closing, name = found[2], found[3]
            if found[1]:
                after = source.find("-->", at)
                at = size if after < 0 else after + 3
            elif name and closing:
                self._end(name.lower(), stop, at)
            elif name:
                tag = name.lower()
                self._start(tag, found[4], stop, at)
                if tag in RAW_TEXT:
                    after = RAW_TEXT[tag].search(source, at)
                    stop = after.start() if after else size
                    if stop > at:
                        self._text(source[at:stop], plain=tag in ("script", "style"))
                    at = stop

    def _pop(self, at: int) -> None:
        node = self.open.pop()
        self.end[node], self.end_at[node] = len(self.tag), at
        tag = self.tag[node]
        self.depths[tag].pop()
        if tag in BLOCKS:
            self.walls.pop()
            if tag in P_FENCE:
                self.fences.pop()

    def _push(self, node: int, tag: str) -> None:
        depth = len(self.open)
        self.open.append(node)
        self.depths[tag].append(depth)
        if tag in BLOCKS:
            self.walls.append(depth)
            if tag in P_FENCE:
                self.fences.append(depth)

    def _start(self, tag: str, raw: str, at: int, after: int) -> None:
        ends = CLOSES.get(tag)
        if ends:
            fences = [self.depths[t] for t in FENCES[tag]] if tag in FENCES else [self.fences]
            fence = max((f[-1] for f in fences if f), default=-1)
            depth = min(
                (d[k] for t in ends if (d := self.depths[t]) and (k := bisect.bisect_right(d, fence)) < len(d)), default=len(self.open)
            )
            while len(self.open) > depth:
                self._pop(at)
        node = len(self.tag)
        self.tag.append(tag)
        self.raw.append(raw)
        self.parent.append(self.open[-1] if self.open else -1)
        self.end.append(node + 1)
        self.start_at.append(at)
        self.end_at.append(after)
        self.index[tag].append(node)
        if raw:
            if "class" in raw:
                words = self.attributes(node).get("class", "").split()
                self.classes[node] = words
                for word in words if len(words) < 2 else dict.fromkeys(words):
                    self.index["." + word].append(node)
            if "id" in raw and "id" in self.attributes(node):
                self.index["#" + self.attributes(node)["id"]].append(node)
        if tag not in VOID:
            self._push(node, tag)

    def _end(self, tag: str, at: int, after: int) -> None:
        own = self.depths[tag]
        if not own or (tag not in BLOCKS and self.walls and self.walls[-1] > own[-1]):
            return
        depth = own[-1]
        while len(self.open) > depth:
            self._pop(after if len(self.open) == depth + 1 else at)

    def _text(self, data: str, plain: bool = False) -> None:
        if "&" in data and not plain:
            data = unescape(data)
        node = self.open[-1] if self.open else -1
        self.texts.append((node, data))
        self.own[node].append(data)

    def attributes(self, node: int) -> dict[str, str]:
        """Attributes of an element; of equal names the first counts."""
        values = self._attributes.get(node)
        if values is None:
            values = {}
            for name, double, single, bare in _ATTRIBUTE.findall(self.raw[node]):
                value = double or single or bare
                values.setdefault(name.lower(), unescape(value) if "&" in value else value)
            self._attributes[node] = values
        return values

    def _siblings(self) -> tuple[list[int], dict[int, int]]:
        """(number of each element among its siblings of the same tag, last child of each element)."""
        if self._places is None:
            count: dict = defaultdict(int)
            nth, last = [], {}
            for node, place in enumerate(zip(self.parent, self.tag, strict=True)):
                count[place] += 1
                nth.append(count[place])
                last[place[0]] = node
            self._places = nth, last
        return self._places

    def _is(self, node: int, step: Step) -> bool:
        if step.tag and self.tag[node] != step.tag:
            return False
        if step.classes:
            words = self.classes.get(node, ())
            for word in step.classes:
                if word not in words:
                    return False
        for word in step.ids:
            if self.attributes(node).get("id") != word:
                return False
        for name, wanted in step.attrs:
            value = self.attributes(node).get(name)
            if value is None or (wanted is not None and value != wanted):
                return False
        for test, argument in step.tests:
            if test == "nth-of-type" and self._siblings()[0][node] != int(argument):
                return False
            if test == "first-of-type" and self._siblings()[0][node] != 1:
                return False
            if test == "last-child" and self._siblings()[1][self.parent[node]] != node:
                return False
            if test == "contains" and argument not in "".join(self.own[node]):
                return False
        return True

    def _leads(self, node: int, steps: list[Step], top: int) -> bool:
        """Whether the ancestors of ``node``, up to ``top``, meet all steps but the last."""
        if len(steps) == 1:
            return not steps[0].child or self.parent[node] == top
        above = self.parent[node]
        while above >= 0 and above >= top:
            if self._is(above, steps[-2]) and self._leads(above, steps[:-1], top):
                return True
            if steps[-1].child:
                return False
            above = self.parent[above]
        return False

    def select(self, steps: list[Step], scope: int = -1) -> list[int]:
        first, last = (0, len(self.tag)) if scope < 0 else (scope, self.end[scope])
        if not steps:
            return list(range(first, last))
        goal = steps[-1]
        key = (
            "#" + goal.ids[0] if goal.ids else "." + goal.classes[0] if goal.classes else goal.tag
        )
        pool = self.index.get(key, []) if key else range(len(self.tag))
        inside = pool[bisect.bisect_left(pool, first) : bisect.bisect_left(pool, last)]
        return [n for n in inside if self._is(n, goal) and self._leads(n, steps, scope)]

    def read(self, steps: list[Step], what: str, name: str, scope: int) -> list[str]:
        if what == "text" and not steps:
            first, last = (-1, len(self.tag)) if scope < 0 else (scope, self.end[scope])
            return [text for node, text in self.texts if first <= node < last]
        if what == "self":
            return [self.attributes(scope)[name]] if scope >= 0 and name in self.attributes(scope) else []
        nodes = self.select(steps, scope)
        if what == "text":
            return [text for node in nodes for text in self.own.get(node, ())]
        if what == "attr":
            return [self.attributes(node)[name] for node in nodes if name in self.attributes(node)]
        return [self.source[self.start_at[node] : self.end_at[node]] for node in nodes]


def extract_rules(
    pages: DataFrame, rules: list[Rule], scope: str | None = None, keep: tuple[str, ...] = (), body: str = "body"
) -> DataFrame:
    """One row per scope node (per page without a scope): kept columns, ``scope_no`` from 1 and one
    array of texts per rule. Only the kept columns and the body reach the Python worker."""
    parsed = [
        (rule.name, _parse_selector(rule.selector), rule.each and _parse_selector(rule.each)[0], rule.at)
        for rule in rules
    ]
    scope_steps = _parse_selector(scope)[0] if scope else None
    source = pages.select(*keep, body)
    fields = [source.schema[name] for name in keep]
    schema = T.StructType(
        [*fields, T.StructField("scope_no", T.IntegerType())]
        + [T.StructField(rule.name, T.ArrayType(T.StringType())) for rule in rules]
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            rows, numbers, columns = [], [], {name: [] for name, *_ in parsed}
            for row, text in enumerate(batch.column(len(keep)).to_pylist()):
                tree = _Tree(text or "")
                nodes = [-1] if scope_steps is None else tree.select(scope_steps)
                for number, node in enumerate(nodes, 1):
                    rows.append(row)
                    numbers.append(number)
                    for name, selector, each, at in parsed:
                        start = {"scope": node, "page": -1, "parent": tree.parent[node] if node >= 0 else -1}[at]
                        if each is None:
                            columns[name].append(tree.read(*selector, start))
                        else:
                            found = [tree.read(*selector, n) for n in tree.select(each, start)]
                            columns[name].append([values[0] if values else None for values in found])
            kept = batch.select(list(range(len(keep)))).take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(numbers, pa.int32())]
                + [pa.array(values, pa.list_(pa.string())) for values in columns.values()],
                names=schema.fieldNames(),
            )

    return source.mapInArrow(apply, schema)


def rule_values(extracted: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ()) -> DataFrame:
    """The long form: (kept columns, scope_no, rule, ord, value), ``ord`` from 1."""
    entries = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("vals")) for r in rules])
    return (
        extracted.select(*keep, "scope_no", F.explode(entries).alias("e"))
        .select(*keep, "scope_no", "e.rule", F.posexplode("e.vals").alias("ord", "value"))
        .withColumn("ord", F.col("ord") + 1)
    )


def first_of(rule: str) -> Column:
    """First match of a rule, or NULL."""
    return F.get(F.col(rule), 0)
