"""Page outlines: one Arrow-batched parse per page, everything else native.

An outline is flat. `segments` holds the trimmed text pieces in page order, `nodes` the elements
that links and selectors need, each with the half-open interval `[first, last)` of segments below
it (and the interval of its parent). Text of an element is therefore an array slice.
"""

import json
import sys
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from postmill.schemas import LEAF, OUTLINE

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
_HIDDEN = frozenset(("script", "style", "template", "rt", "rp"))
_NOISE = frozenset(("nav", "header", "footer", "script", "style"))
_LISTED = frozenset(("a", "article", "main", "body"))
_LISTED_ATTRS = frozenset(("id", "class", "itemprop", "data-careersite-propertyid"))


class _Reader(HTMLParser):
    """Collects the outline of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=False)

    def read(self, html: str) -> "_Reader":
        self.reset()
        self.words, self.quiet = [], []
        self.opened = []  # [tag, first segment, last segment, parent, noisy, attributes]
        self.path, self.text = [], []
        self.hidden = self.noise = 0
        self.app_json, self.in_app_json, self.seen_app_json = None, False, False
        self.feed(html)
        self.close()
        self._cut()
        while self.path:
            self._leave()
        return self

    def _cut(self):
        if self.text:
            piece = "".join(self.text)
            self.text.clear()
            if self.in_app_json and self.app_json is None:
                self.app_json = piece
            if not self.hidden:
                piece = piece.strip()
                if piece:
                    self.words.append(piece)
                    self.quiet.append(self.noise > 0)

    def _leave(self):
        row = self.opened[self.path.pop()]
        row[2] = len(self.words)
        tag = row[0]
        if tag in _HIDDEN:
            self.hidden -= 1
            if tag == "script":
                self.in_app_json = False
        if tag in _NOISE:
            self.noise -= 1

    def handle_starttag(self, tag, attrs):
        self._cut()
        attrs = dict(attrs)
        at = len(self.words)
        if tag in _NOISE:
            self.noise += 1
        parent = self.path[-1] if self.path else -1
        self.opened.append([tag, at, at, parent, self.noise > 0, attrs])
        if tag in _VOID:
            if tag in _NOISE:
                self.noise -= 1
            return
        self.path.append(len(self.opened) - 1)
        if tag in _HIDDEN:
            self.hidden += 1
            if tag == "script" and attrs.get("id") == "__NEXT_DATA__" and not self.seen_app_json:
                self.in_app_json = self.seen_app_json = True

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._cut()
        if tag not in _VOID and any(self.opened[i][0] == tag for i in reversed(self.path)):
            while self.opened[self.path[-1]][0] != tag:
                self._leave()
            self._leave()

    def handle_data(self, data):
        self.text.append(data)

    def handle_entityref(self, name):
        self.text.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            raw = bytes((code,)).decode("windows-1252") if 127 < code < 160 else chr(code)
        except (ValueError, OverflowError):
            raw = "\N{REPLACEMENT CHARACTER}"
        self.text.append(raw)

    def handle_comment(self, data):
        self._cut()

    def handle_decl(self, decl):
        self._cut()

    def handle_pi(self, data):
        self._cut()

    def unknown_decl(self, data):
        self._cut()
        if data.upper().startswith("CDATA["):
            self.text.append(data[6:])
            self._cut()


_NODE_TYPE = to_arrow_type(OUTLINE["nodes"].dataType.elementType)
_SEGMENT_TYPE = to_arrow_type(OUTLINE["segments"].dataType.elementType)


def _lists(offsets: list[int], columns: list[list], struct: pa.StructType) -> pa.ListArray:
    fields = [struct.field(i) for i in range(struct.num_fields)]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, fields)]
    items = pa.StructArray.from_arrays(arrays, fields=fields)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)


@F.arrow_udf(OUTLINE)
def html_outline(pages: pa.Array) -> pa.Array:
    """Outline of each page; null gives an empty one."""
    reader = _Reader()
    nodes = [[] for _ in range(_NODE_TYPE.num_fields)]
    segments, app_json = [[], []], []
    node_at, segment_at = [0], [0]
    for html in pages.to_pylist():
        page = reader.read(html or "")
        opened = page.opened
        for pos, (tag, first, last, parent, noisy, attrs) in enumerate(opened):
            if tag not in _LISTED and _LISTED_ATTRS.isdisjoint(attrs):
                continue
            outer = opened[parent] if parent >= 0 else (None, 0, len(page.words))
            css = attrs.get("class")
            row = (
                pos, tag, first, last, outer[1], outer[2], noisy, attrs.get("id"),
                None if css is None else " ".join(css.split()),
                (attrs["href"] or "") if "href" in attrs else None,
                attrs.get("itemprop"), attrs.get("data-careersite-propertyid"),
            )
            for column, value in zip(nodes, row):
                column.append(value)
        node_at.append(len(nodes[0]))
        segments[0].extend(page.words)
        segments[1].extend(page.quiet)
        segment_at.append(len(segments[0]))
        app_json.append(page.app_json)
    return pa.StructArray.from_arrays(
        [
            _lists(node_at, nodes, _NODE_TYPE),
            _lists(segment_at, segments, _SEGMENT_TYPE),
            pa.array(app_json, pa.string()),
        ],
        names=OUTLINE.fieldNames(),
    )


def _plain(reader: _Reader, html: str | None) -> str | None:
    return None if html is None else "\n".join(reader.read(html).words)


@F.arrow_udf(T.StringType())
def html_text(html: pa.Array) -> pa.Array:
    """Text pieces of a fragment, one per line."""
    reader = _Reader()
    return pa.array([_plain(reader, x) for x in html.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def html_texts(html: pa.Array) -> pa.Array:
    """`html_text` for every item of an array."""
    reader = _Reader()
    rows = [None if row is None else [_plain(reader, x) for x in row] for row in html.to_pylist()]
    return pa.array(rows, pa.list_(pa.string()))


def _leaves(node, path: str = ""):
    if isinstance(node, str):
        yield path, node
    elif isinstance(node, list):
        for item in node:
            yield from _leaves(item, path)
    elif isinstance(node, dict):
        for key, value in node.items():
            yield from _leaves(value, (f"{path}.{key}" if path else str(key)).lower())


@F.arrow_udf(T.ArrayType(LEAF))
def json_leaves(bodies: pa.Array) -> pa.Array:
    """String leaves of a JSON text with their dotted path and plain text; bad JSON has none."""
    reader = _Reader()
    rows = []
    for body in bodies.to_pylist():
        try:
            found = list(_leaves(json.loads(body))) if body else []
        except (ValueError, RecursionError):
            found = []
        rows.append([{"path": path, "text": _plain(reader, text)} for path, text in found])
    kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
    return pa.array(rows, kind)


# Parsing is costly and the optimizer does not know it: a filter on a parsed value would be pushed below
# the parse as a second copy of it. Declared nondeterministic, each of these runs once per row.
html_outline = html_outline.asNondeterministic()
html_text = html_text.asNondeterministic()
html_texts = html_texts.asNondeterministic()
json_leaves = json_leaves.asNondeterministic()


def pieces(outline: Column, node: Column, keep_noise: bool = True) -> Column:
    """Text pieces below a node, in page order."""
    part = F.slice(outline["segments"], node["first"] + 1, node["last"] - node["first"])
    if not keep_noise:
        part = F.filter(part, lambda s: ~s["noise"])
    return F.transform(part, lambda s: s["text"])


def node_text(outline: Column, node: Column, sep: str) -> Column:
    return F.array_join(pieces(outline, node), sep)


def outer_text(outline: Column, node: Column, sep: str) -> Column:
    """Text of the element around a node."""
    part = F.slice(
        outline["segments"], node["outer_first"] + 1, node["outer_last"] - node["outer_first"]
    )
    return F.array_join(F.transform(part, lambda s: s["text"]), sep)


def anchors(outline: Column) -> Column:
    """Anchor nodes that carry an href."""
    return F.filter(outline["nodes"], lambda n: (n["tag"] == "a") & n["href"].isNotNull())


def css_token(node: Column, name: str) -> Column:
    padded = F.concat(F.lit(" "), node["css"], F.lit(" "))
    return F.coalesce(F.contains(padded, F.lit(f" {name} ")), F.lit(False))
