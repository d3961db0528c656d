"""Fields of stored result pages.

Titles and ids come from regular expressions inside the JVM. Three things need Python: the bounds of rows,
which are those of a tree, resolving character entities, and the tree relations around an expanded abstract; all get
only the texts concerned.
"""

from __future__ import annotations

import html as html_module
import re
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from citeweave.functions.text import clean_affixes, id_after_dash, strip
from citeweave.schemas import NO_ABSTRACT, NO_ID, NO_TITLE

# Workers get the parser with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Selector:
    """An element by tag name and, if given, one of its class names."""

    tag: str
    css_class: str | None = None


# Markup of the result pages.
ROW = Selector("div", "cl-paper-row")
TITLE = Selector("h2", "cl-paper-title")
EXPANDED_LABEL = Selector("span", "cl-button__label")
EXPANDED_TEXT = "Collapse"
ABSTRACT_HEADING = "Abstract"

_INERT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def _class_test(css_class: str) -> str:
    name = re.escape(css_class)
    double = rf'"(?:[^"]*\s)?{name}(?:\s[^"]*)?"'
    single = rf"'(?:[^']*\s)?{name}(?:\s[^']*)?'"
    bare = rf"{name}(?=[\s>])"
    return rf"(?=[^>]*?\s(?i:class)\s*=\s*(?:{double}|{single}|{bare}))"


def start_tag(selector: Selector) -> str:
    """Pattern of the start tag of the selected element."""
    test = _class_test(selector.css_class) if selector.css_class else ""
    return rf"<(?i:{selector.tag})(?=[\s>/]){test}[^>]*>"


def drop_inert(page: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(page, _INERT, "")


#: So many characters are held as Python texts at a time, and one text more.
PORTION = 1 << 20


def _mapped(texts: pa.Array, work: Callable, kind: pa.DataType) -> pa.Array:
    """What ``work`` makes of every text that is there.

    Python takes up to four bytes for a character, and a batch may hold thousands of pages: only a portion of them is
    held as Python texts, and what comes of it goes back to Arrow before the next one.
    """
    done, held, size = [], [], 0
    for text in texts:
        value = text.as_py()
        held.append(None if value is None else work(value))
        size += 0 if value is None else len(value)
        if size >= PORTION:
            done.append(pa.array(held, kind))
            held, size = [], 0
    done.append(pa.array(held, kind))
    return pa.concat_arrays(done)


def _cut_rows(pages: pa.Array, row_tag: str, tag: str) -> pa.Array:
    start, tags = re.compile(row_tag), re.compile(r"<(/?)([a-zA-Z][^\s/>]*)[^>]*>")

    def cut(page: str) -> list[str]:
        found: list[list[int]] = []
        # Open elements as (name, place among the rows or -1), and the places of rows still open.
        open_: list[tuple[str, int]] = []
        for match in tags.finditer(page):
            name = match[2].lower()
            if not match[1]:
                is_row = name == tag and start.match(page, match.start()) is not None
                if is_row:
                    found.append([match.start(), len(page)])
                if name not in _Tree.VOID:
                    open_.append((name, len(found) - 1 if is_row else -1))
                continue
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if depth is not None:
                # An end tag also ends what stands open inside its element, just before it.
                for k in range(len(open_) - 1, depth - 1, -1):
                    if open_[k][1] >= 0:
                        found[open_[k][1]][1] = match.end() if k == depth else match.start()
                del open_[depth:]
        return [page[begin:end] for begin, end in found]

    return _mapped(pages, cut, pa.list_(pa.string()))


def row_chunks(page: Column, row: Selector = ROW) -> Column:
    """Array of the page's rows, each from its start tag to its own end tag, as a tree has them.

    A row inside another one is a row too, and part of the outer one. A row that is not ended goes as far as what
    holds it. Only pages with a row reach Python.
    """
    tag = start_tag(row)
    bare = drop_inert(page)
    cut = F.arrow_udf(lambda pages: _cut_rows(pages, tag, row.tag.lower()), "array<string>")
    return F.coalesce(cut(F.when(bare.rlike(tag), bare)), F.when(page.isNotNull(), F.array().cast("array<string>")))


def page_rows(pages: DataFrame, row: Selector = ROW, carry: Sequence[str] = ()) -> DataFrame:
    """One row per selected element of every page, with its 0-based position."""
    return pages.select(*carry, F.posexplode(row_chunks(F.col("html"), row)).alias("item", "row_html"))


def _unescape(texts: pa.Array) -> pa.Array:
    return _mapped(texts, html_module.unescape, pa.string())


def unescape(text: Column) -> Column:
    """Resolve character entities; only texts with an ``&`` go to Python."""
    resolved = F.arrow_udf(_unescape, StringType())(F.when(F.contains(text, F.lit("&")), text))
    return F.coalesce(resolved, text)


def _first(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def element_text(page: Column, element: Selector) -> Column:
    """Stripped text of the first selected element; null if there is none or it holds no text."""
    inner = _first(page, rf"(?s){start_tag(element)}(.*?)</(?i:{element.tag})\s*>", 1)
    return strip(unescape(F.nullif(F.regexp_replace(inner, r"(?s)<[^>]*>", ""), F.lit(""))))


def element_attribute(page: Column, element: Selector, name: str) -> Column:
    """An attribute of the first selected element; null if it has none."""
    quoted = _first(
        _first(page, start_tag(element), 0), rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1
    )
    return unescape(F.regexp_replace(quoted, r"""\A["']|["']\z""", ""))


def row_title(row: Column, title: Selector = TITLE) -> Column:
    return F.coalesce(element_text(row, title), F.lit(NO_TITLE))


def row_ident(row: Column, title: Selector = TITLE) -> Column:
    """Id behind the first dash of the title's ``id``; null if that has no dash."""
    attribute = element_attribute(row, title, "id")
    return F.when(attribute.isNull(), F.lit(NO_ID)).otherwise(id_after_dash(attribute))


class _Tree(HTMLParser):
    """Tags and texts of a fragment as flat lists that point to their parents."""

    # Elements without an end tag, and elements whose text is no prose.
    VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
    SILENT = frozenset(("script", "style", "template"))

    def __init__(self, fragment: str):
        super().__init__(convert_charrefs=True)
        self.tags: list[tuple[str, list, int]] = [("", [], -1)]
        self.texts: list[tuple[int, str]] = []
        self._open = [0]
        self.feed(fragment)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, attrs, self._open[-1]))
        if tag not in self.VOID:
            self._open.append(len(self.tags) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, 0, -1):
            if self.tags[self._open[depth]][0] == tag:
                del self._open[depth:]
                break

    def handle_data(self, data):
        self.texts.append((self._open[-1], data))

    def parent(self, node: int) -> int:
        return self.tags[node][2]

    def inside(self, node: int, ancestor: int) -> bool:
        while node > ancestor:
            node = self.parent(node)
        return node == ancestor


def expanded_text(fragment: str | None) -> str | None:
    """Text opened by the last expanded label of a fragment; None if nothing is expanded.

    The text stands in the ``div`` just before the label's button, or else around the button.
    """
    if fragment is None:
        return None
    tree = _Tree(fragment)
    own_texts: dict[int, list[str]] = {}
    for node, text in tree.texts:
        own_texts.setdefault(node, []).append(text)
    parents = {parent for _tag, _attrs, parent in tree.tags}
    labels = [
        node
        for node, (tag, attrs, _parent) in enumerate(tree.tags)
        if tag == EXPANDED_LABEL.tag
        and EXPANDED_LABEL.css_class in (dict(attrs).get("class") or "").split()
        and "".join(own_texts.get(node, [])) == EXPANDED_TEXT
        and node not in parents
    ]
    if not labels:
        return None
    button = tree.parent(labels[-1])
    siblings = [node for node in range(1, button) if tree.parent(node) == tree.parent(button)]
    if siblings and tree.tags[siblings[-1]][0] == "div":
        around = siblings[-1]
    else:
        around = max(tree.parent(button), 0)
    return "".join(
        text.strip()
        for node, text in tree.texts
        if tree.tags[node][0] not in tree.SILENT and tree.inside(node, around)
    )


def _expanded(fragments: pa.Array) -> pa.Array:
    return _mapped(fragments, expanded_text, pa.string())


def row_expanded_text(row: Column) -> Column:
    """Expanded text of a row; only rows that show the label reach Python."""
    return F.arrow_udf(_expanded, StringType())(F.when(F.contains(row, F.lit(EXPANDED_TEXT)), row))


def row_abstract(row: Column) -> Column:
    """Cleaned abstract of a row, or the default where nothing is expanded."""
    return F.coalesce(clean_affixes(row_expanded_text(row), ABSTRACT_HEADING, EXPANDED_TEXT), F.lit(NO_ABSTRACT))
