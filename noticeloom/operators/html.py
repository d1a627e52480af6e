"""HTML as arrays: one Arrow function turns a page into a flat list of nodes, all else is array expressions.

A node is ``struct(pos, parent, end, tag, id, cls, href, name, value, text)``: position in
document order, position of its parent (-1: none), position of its last descendant, and its
whole text, pieces stripped and joined by one space. A node x lies inside y if
``y.pos < x.pos <= y.end``. Unclosed tags end with their parent.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

NODE = StructType([StructField(n, IntegerType()) for n in ("pos", "parent", "end")] + [StructField(n, StringType()) for n in ("tag", "id", "cls", "href", "name", "value", "text")])
# --- fixed values: elements without content; elements that end an open one of the same kind
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# ------------------------------------------------------------------------------------


class _Flat(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.texts: list[list[str]] = []
        self.open: list[int] = []
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        for other in _CLOSES.get(tag, ()):
            if self.open and self.nodes[self.open[-1]]["tag"] == other:
                self._close()
        a = {k: v or "" for k, v in attrs}
        self.nodes.append({"pos": len(self.nodes), "parent": self.open[-1] if self.open else -1, "end": len(self.nodes), "tag": tag, "id": a.get("id"), "cls": a.get("class"), "href": a.get("href"), "name": a.get("name"), "value": a.get("value")})
        self.texts.append([])
        if tag not in _VOID:
            self.open.append(len(self.nodes) - 1)
            self.silent += tag in ("script", "style")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close()

    def _close(self):
        i = self.open.pop()
        self.nodes[i]["end"] = len(self.nodes) - 1
        self.silent -= self.nodes[i]["tag"] in ("script", "style")

    def handle_endtag(self, tag):
        if any(self.nodes[i]["tag"] == tag for i in self.open):
            while self.nodes[self.open[-1]]["tag"] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        piece = data.strip()
        if piece and not self.silent:
            for i in self.open:
                self.texts[i].append(piece)

    def result(self) -> list[tuple]:
        self.close()
        while self.open:
            self._close()
        return [(n["pos"], n["parent"], n["end"], n["tag"], n["id"], n["cls"], n["href"], n["name"], n["value"], " ".join(t)) for n, t in zip(self.nodes, self.texts)]


def parse(html: str | None) -> list[tuple] | None:
    if html is None:
        return None
    parser = _Flat()
    parser.feed(html)
    return parser.result()


@F.pandas_udf(ArrayType(NODE))
def nodes(html: pd.Series) -> pd.Series:
    names = NODE.fieldNames()
    return pd.Series([None if h is None else [dict(zip(names, n)) for n in parse(h)] for h in html], dtype=object)


def tagged(ns: Column, *tags: str) -> Column:
    return F.filter(ns, lambda n: n["tag"].isin(*tags))


def with_class(ns: Column, cls: str) -> Column:
    return F.filter(ns, lambda n: F.array_contains(F.split(F.coalesce(n["cls"], F.lit("")), r"\s+"), cls))


def inside(ns: Column, outer: Column) -> Column:
    """The nodes below ``outer``; none if it is null."""
    return F.filter(ns, lambda n: F.coalesce((n["pos"] > outer["pos"]) & (n["pos"] <= outer["end"]), F.lit(False)))


def children(ns: Column, outer: Column) -> Column:
    return F.filter(ns, lambda n: n["parent"].eqNullSafe(outer["pos"]) & outer.isNotNull())


def first(ns: Column) -> Column:
    return F.get(ns, F.lit(0))


def anchors(ns: Column) -> Column:
    """``array<struct<pos, href, text>>`` of the links of a page."""
    return F.transform(F.filter(ns, lambda n: (n["tag"] == "a") & (F.coalesce(n["href"], F.lit("")) != "")), lambda n: F.struct(n["pos"].alias("pos"), n["href"].alias("href"), n["text"].alias("text")))


def hidden_fields(ns: Column) -> Column:
    """Names and values of the form's hidden state fields."""
    found = F.filter(ns, lambda n: (n["tag"] == "input") & F.coalesce(n["name"].isin("__VIEWSTATE", "__VIEWSTATEGENERATOR", "__EVENTVALIDATION"), F.lit(False)))
    return F.map_from_arrays(F.transform(found, lambda n: n["name"]), F.transform(found, lambda n: F.coalesce(n["value"], F.lit(""))))


def table_by_heading(ns: Column, heading: str, cls: str = "gvwTable") -> Column:
    """The first table of the class with a first header cell that contains ``heading``."""
    tables = F.filter(with_class(ns, cls), lambda t: t["tag"] == "table")
    return first(F.filter(tables, lambda t: F.coalesce(F.lower(first(tagged(inside(ns, t), "th"))["text"]).contains(heading.lower()), F.lit(False))))


def rows(ns: Column, table: Column) -> Column:
    """Cell nodes of each row of a table: ``array<array<node>>``, header rows (no ``td``) left out."""
    each = F.transform(F.filter(inside(ns, table), lambda n: n["tag"] == "tr"), lambda r: F.filter(ns, lambda n: (n["parent"] == r["pos"]) & (n["tag"] == "td")))
    return F.filter(each, lambda cells: F.size(cells) > 0)
