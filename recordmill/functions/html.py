"""Text, links and blocks of a raw web page, as expressions over its HTML.

A page is cut at the opening tags of interest and each piece is read up to its
closing tag, so the work is linear in the page and no group is repeated over
the whole text. Comments, scripts and styles are removed first; entities are
decoded after the tags are gone.
"""

from __future__ import annotations

import itertools
import re
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from recordmill.functions.staging import let, literal_map
from recordmill.functions.text import norm_ws, text_or_empty

_HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script(?=[\s>/]).*?(?:</script\s*>|\z)"
    r"|<style(?=[\s>/]).*?(?:</style\s*>|\z)"
)
# The rest of an opening tag; a quote only counts after an equals sign.
_TAG_REST = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+>"""
_TAG = rf"(?s)</?[A-Za-z]{_TAG_REST}|<![A-Za-z][^>]*>|<\?[^>]*>"
_QUOTED = r"""(?:"[^"]*"|'[^']*')"""
# Quoted attributes of a tag; group 1 is the one that is an href.
_ATTRIBUTE = rf"""(?is)(?<![\w-])(?:(href\s*=\s*{_QUOTED})|[\w:.-]+\s*=\s*{_QUOTED})"""
_HREF = r"""(?is)(?:^|\s)href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CLASS = r"""(?is)<([a-z][a-z0-9]*)(?=\s)[^>]*?\sclass\s*=\s*(?:"[^"]*|'[^']*|)(?<![\w-])(?:%s)(?![\w-])"""

# Names first looked up come first: element access walks the map from the start.
_COMMON = ("amp", "nbsp", "lt", "gt", "quot", "copy", "middot")
_ENTITIES = {n: chr(name2codepoint[n]) for n in (*_COMMON, *name2codepoint)} | {"apos": "'"}


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(text_or_empty(html), _HIDDEN, " ")


def _code_point(name: Column) -> Column:
    """Character of ``#233`` or ``#xE9``; null where the number is no character."""
    hexadecimal = F.regexp_extract(name, r"^#[xX]0*+([0-9A-Fa-f]{1,6})$", 1)
    decimal = F.regexp_extract(name, r"^#0*+([0-9]{1,7})$", 1)
    number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).try_cast("int")
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    utf32 = F.unhex(F.lpad(F.hex(number), 8, "0"))
    return F.when(valid, F.decode(utf32, "UTF-32"))


def decode_entities(c: Column) -> Column:
    """Replace each ``&name;`` and ``&#n;`` once; unknown names stay as written."""
    table = literal_map(_ENTITIES)

    def after_mark(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        char = F.coalesce(
            F.try_element_at(table, name),
            F.when(F.startswith(name, F.lit("#")), _code_point(name)),
            F.concat(F.lit("&"), name, F.lit(";")),
        )
        return F.concat(char, F.substring(piece, F.length(name) + 2, F.length(piece)))

    pieces = F.split(c, r"&(?=#?[A-Za-z0-9]++;)")
    decoded = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(after_mark(piece)))
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def text_of(html: Column) -> Column:
    """Text of a fragment that is already ``visible``: tags out, entities in, spaces tidy."""
    return norm_ws(decode_entities(F.regexp_replace(html, _TAG, " ")))


def pieces_from(html: Column, names: str) -> Column:
    """One piece per opening tag in ``names`` (``a`` or ``h[1-4]``), from behind its name."""
    pieces = F.split(html, rf"(?i)<(?:{names})(?=[\s>/])")
    return let(pieces, lambda all_: F.slice(all_, F.lit(2), F.size(all_)))


def _until_close(piece: Column, names: str) -> Column:
    return F.element_at(F.split(piece, rf"(?i)</(?:{names})\s*>", 2), 1)


def tag_attributes(piece: Column) -> Column:
    return F.regexp_extract(piece, rf"(?s)^({_TAG_REST})", 1)


def inner_html(piece: Column, names: str) -> Column:
    """Content of a piece up to its closing tag, without the opening tag itself."""
    return F.regexp_replace(_until_close(piece, names), rf"(?s)^{_TAG_REST}", "")


def _unquoted(value: Column) -> Column:
    quoted = F.startswith(value, F.lit('"')) | F.startswith(value, F.lit("'"))
    return F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def _href(attributes: Column) -> Column:
    """The ``href`` as written; other quoted values are dropped first, since they may hold the word."""
    return F.regexp_extract(F.regexp_replace(attributes, _ATTRIBUTE, " $1"), _HREF, 1)


def _linked(html: Column) -> Column:
    """Anchors with an ``href``, in order, as written: array of (href, inner)."""
    raw = F.transform(
        pieces_from(html, "a"),
        lambda piece: F.struct(
            _href(tag_attributes(piece)).alias("href"),
            inner_html(piece, "a").alias("inner"),
        ),
    )
    return F.filter(raw, lambda a: a["href"] != "")


def _read_link(a: Column) -> Column:
    return F.struct(decode_entities(_unquoted(a["href"])).alias("href"), text_of(a["inner"]).alias("text"))


def anchors(html: Column) -> Column:
    """Links of a ``visible`` fragment, in order: array of (href, text).

    Anchors without an ``href`` are left out; an empty ``href`` is a link.
    """
    return F.transform(_linked(html), _read_link)


def hrefs(html: Column) -> Column:
    """Targets of the links of a ``visible`` fragment, in order, without reading their texts."""
    return F.transform(_linked(html), lambda a: decode_entities(_unquoted(a["href"])))


def first_anchor(html: Column) -> Column:
    """The first link of a fragment as (href, text); null where it has none."""
    return F.get(F.transform(F.slice(_linked(html), 1, 1), _read_link), F.lit(0))


def first_block(html: Column, names: str) -> Column:
    """Content of the first element in ``names``; null where there is none."""
    return inner_html(F.get(pieces_from(html, names), F.lit(0)), names)


# Elements that have no content and no closing tag.
_VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
)
_NODES = ArrayType(
    StructType([StructField("heading", BooleanType()), *(StructField(n, IntegerType()) for n in ("at", "node", "own_end", "node_end"))])
)
_FIELDS = [("heading", pa.bool_()), *((name, pa.int32()) for name in ("at", "node", "own_end", "node_end"))]
_OPENING = re.compile("</?([A-Za-z][A-Za-z0-9]*)")
_ALONE = re.compile(r"""<[A-Za-z](?:[^>=]++|=[ \t\n\x0b\f\r]*+"[^"]*+"|=[ \t\n\x0b\f\r]*+'[^']*+'|=)*+(?<=/)>""")
_HEADINGS = ("h2", "h3", "h4")


def _segments(html: Column) -> Column:
    """The page cut before every opening and closing tag."""
    return F.split(html, "(?=</?[A-Za-z])")


def _matched(page: str) -> list[tuple]:
    """The rows of ``nodes`` for one page.

    Open elements are on a stack, and by name the places they have there, so that
    every element is put and taken once: time is linear in the page.
    """
    found, ends, stack, places = [], {}, [], {}
    segment, tags = 0, list(_OPENING.finditer(page))
    for tag, behind in zip(tags, [*(t.start() for t in tags[1:]), len(page)], strict=False):
        segment += tag.start() > 0
        name = tag[1].lower()
        if name in _VOID:
            continue
        if page.startswith("</", tag.start()):
            if places.get(name):
                keep = places[name][-1]
                for gone, at in stack[keep:]:
                    places[gone].pop()
                    ends[at] = segment
                del stack[keep:]
        elif not _ALONE.match(page, tag.start(), behind):
            if name in _HEADINGS:
                found.append((True, segment, stack[-1][1] if stack else -1))
            elif name == "article":
                found.append((False, segment, segment))
            places.setdefault(name, []).append(len(stack))
            stack.append((name, segment))
    return [(heading, at, node, ends.get(at), ends.get(node)) for heading, at, node in found]


@F.arrow_udf(_NODES)
def _nodes(pages: pa.Array) -> pa.Array:
    found = [_matched(page or "") for page in pages.to_pylist()]
    every = [node for own in found for node in own]
    arrays = [pa.array([node[k] for node in every], kind) for k, (_, kind) in enumerate(_FIELDS)]
    items = pa.StructArray.from_arrays(arrays, fields=[pa.field(*f) for f in _FIELDS])
    ends = list(itertools.accumulate(map(len, found), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)


def nodes(html: Column) -> Column:
    """Every ``article``, and every ``h2``-``h4`` with the element around it, by segment of a ``visible`` page.

    ``node`` is the article, or what encloses the heading (-1: the page);
    ``node_end`` and ``own_end`` are the segments behind the two, null where they
    are never closed. A closing tag ends what was opened since its own opening
    tag, and nothing if it has none. A stack is the one thing here that column
    expressions can't hold without copying it at each tag, so this is a function
    over Arrow batches; it may not be used inside a lambda. Pages without such an
    element are not sent.
    """
    return F.coalesce(_nodes(F.when(F.rlike(html, F.lit("(?i)<(?:article|h[2-4])")), html)), F.array().cast(_NODES))


def _joined(segments: Column, begin: Column, end: Column) -> Column:
    """Segments ``begin`` to ``end``, without the latter; to the page's end where it is null."""
    first = F.greatest(begin, F.lit(0))
    return F.array_join(F.slice(segments, first + 1, F.coalesce(end, F.size(segments)) - first), "")


def _with_segments(html: Column, found: Column | None, use) -> Column:
    """``use(segments, nodes)``; the nodes are matched here unless a column holds them."""
    parts = F.struct(_segments(html).alias("segments"), (nodes(html) if found is None else found).alias("nodes"))
    return let(parts, lambda page: use(page["segments"], page["nodes"]))


def articles(html: Column, found: Column | None = None) -> Column:
    """Every ``article`` element, nested ones inside the outer one and again by themselves. ``found``: its ``nodes``."""
    return _with_segments(
        html,
        found,
        lambda segments, every: F.transform(
            F.filter(every, lambda n: ~n["heading"]), lambda n: _joined(segments, n["node"], n["node_end"])
        ),
    )


def around_linked_headings(html: Column, found: Column | None = None) -> Column:
    """The elements around ``h2``-``h4`` headings that hold a link, each once. ``found``: the page's ``nodes``."""

    def use(segments: Column, every: Column) -> Column:
        linked = F.filter(
            every, lambda n: n["heading"] & first_anchor(_joined(segments, n["at"], n["own_end"])).isNotNull()
        )
        around = F.array_distinct(F.transform(linked, lambda n: F.struct(n["node"], n["node_end"])))
        return F.transform(around, lambda n: _joined(segments, n["node"], n["node_end"]))

    return _with_segments(html, found, use)


def _balanced(piece: Column, name: Column) -> Column:
    """Content of an element whose tag name is ``name``, nested ones of that name included.

    ``piece`` starts behind the opening tag. Cutting before every tag of that
    name, the content ends where one more was closed than opened.
    """
    segments = F.split(piece, F.concat(F.lit("(?i)(?=</?"), name, F.lit(r"[\s>/])")))
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("taken"))

    def change(segment: Column) -> Column:
        opens = F.lower(F.substring(segment, F.lit(2), F.length(name))) == name
        closes = F.lower(F.substring(segment, F.lit(3), F.length(name))) == name
        return (
            F.when(F.startswith(segment, F.lit("</")) & closes, -1)
            .when(F.startswith(segment, F.lit("<")) & opens, 1)
            .otherwise(0)
        )

    end = F.aggregate(
        segments,
        start,
        lambda at, s: let(
            at["depth"] + change(s),
            lambda depth: F.when(
                (at["depth"] > 0) & ((depth > 0) | (at["taken"] == 0)),
                F.struct(depth.alias("depth"), (at["taken"] + 1).alias("taken")),
            ).otherwise(F.struct(F.lit(0).alias("depth"), at["taken"].alias("taken"))),
        ),
    )
    return F.array_join(F.slice(segments, F.lit(1), end["taken"]), "")


def main_content(html: Column, classes: tuple[str, ...] = ("entry-content", "post-content")) -> Column:
    """The article body of a ``visible`` page.

    That is the first element with one of ``classes``, else the first
    ``article``, else the whole page.
    """
    opening = _CLASS % "|".join(classes)

    def marked(page: Column) -> Column:
        name = F.lower(F.regexp_extract(page, opening, 1))
        rest = F.regexp_replace(F.get(F.split(page, opening, 2), F.lit(1)), r"^[^>]*>", "")
        content = let(F.struct(name.alias("name"), rest.alias("rest")), lambda at: _balanced(at["rest"], at["name"]))
        opened = F.get(F.split(page, r"(?i)<article(?=[\s>/])", 2), F.lit(1))
        article = _balanced(F.regexp_replace(opened, rf"(?s)^{_TAG_REST}", ""), F.lit("article"))
        named = F.lit(False)
        for word in classes:
            named = named | F.contains(page, F.lit(word))
        return F.coalesce(F.when(named, content), article, page)

    return let(html, marked)
