"""Rendered HTML tables: cells, markers, links and images of each row, and the links of a page."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def all(self, tag: str):
        return (n for n in self.walk() if n.tag == tag and n is not self)

    def first(self, tag: str) -> Node | None:
        return next(self.all(tag), None)

    def text(self, without: str | None = None) -> str:
        parts, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                parts.append(n)
            elif n.tag != without or n is self:
                stack += reversed(n.children)
        return "".join(parts).strip()

    def inside(self, tag: str) -> bool:
        n = self.parent
        while n and n.tag != tag:
            n = n.parent
        return n is not None


class Tree(HTMLParser):
    """A tree of any HTML; an end tag without a start is passed over."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n.parent and n.tag != tag:
            n = n.parent
        if n.tag == tag and n.parent:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def table_rows(html: str):
    """(row_position, headings, cells, markers, link, image) of the rows with direct cells outside a table head."""
    root = Tree(html).root
    headings = [h.text() for h in root.all("th")]
    k = 0
    for tr in root.all("tr"):
        cells = [c for c in tr.children if isinstance(c, Node) and c.tag == "td"]
        if not cells or tr.inside("thead"):
            continue
        k += 1
        link, image = tr.first("a"), tr.first("img")
        marks = [" ".join(s.text() for s in c.all("sup")) for c in cells]
        yield k, headings, [c.text("sup") for c in cells], marks, link.attrs.get("href") if link else None, image.attrs.get("src") if image else None


@F.udtf(returnType="row_position int, headings array<string>, cells array<string>, markers array<string>, link string, image string")
class TableRows:
    def eval(self, html: str):
        yield from table_rows(html or "")


def snapshot(html: str):
    """(headings, rows) of saved HTML: a row for each table row outside a head that has direct cells; one with a single cell has nothing but its text."""
    root = Tree(html).root
    headings = [h.text() for h in root.all("th")]
    rows = []
    for tr in root.all("tr"):
        cells = [c for c in tr.children if isinstance(c, Node) and c.tag == "td"]
        if not cells or tr.inside("thead"):
            continue
        row = {"display_text": "", "url": None, "logo_url": "", "rank_text": cells[0].text(), "description": None, "cells": []}
        if len(cells) > 1:
            link, image = cells[1].first("a"), cells[1].first("img")
            mark = [c.first("sup") for c in cells]
            row |= {"display_text": (link or cells[1]).text(), "url": link.attrs.get("href") if link else None, "logo_url": image.attrs.get("src", "") if image else "", "description": tr.attrs.get("data-description", tr.attrs.get("aria-description"))}
            row["cells"] = [{"heading": h, "salary_text": c.text("sup"), "marker_text": m.text() if m else ""} for h, c, m in zip(headings[2:], cells[2:], mark[2:], strict=False)]
        rows.append(row)
    return headings, rows


@F.udtf(returnType="headings array<string>, rows array<struct<display_text:string,url:string,logo_url:string,rank_text:string,description:string,cells:array<struct<heading:string,salary_text:string,marker_text:string>>>>")
class Snapshot:
    def eval(self, html: str):
        yield snapshot(html or "")


@F.udtf(returnType="link_position int, href string, label string")
class Links:
    def eval(self, html: str):
        for k, a in enumerate(Tree(html or "").root.all("a"), start=1):
            yield k, a.attrs.get("href"), a.text()


def lateral(spark: SparkSession, docs: DataFrame, udtf, html: str, keep: tuple[str, ...]) -> DataFrame:
    """The UDTF's rows for each document, in parallel over documents."""
    return docs.select(*keep, html).lateralJoin(udtf(F.col(html).outer())).drop(html)
