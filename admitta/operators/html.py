"""Programmes and links out of HTML pages (F6 to F8, F11, F17, E18 to E20, E22, O8, ST6).

One pass of the standard parser turns each page into a table of nodes; all extractors are DataFrame
expressions over it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitta.functions.identity import content_hash, faculty_uid, program_uid, resolve_link
from admitta.functions.parse import count_of, course_names, domain_label, item_name, list_spots, name_language, url_duration, url_level
from admitta.functions.vocab import BUDGET_PATTERN, CONTAINERS, LIST_NOISE_MORE, LIST_WHITELIST, NAVIGATION, NAVIGATION_CLASSES, TAX_PATTERN
from admitta.operators.boilerplate import fill_forward
from admitta.operators.fuse import extraction_confidence
from admitta.operators.rank import contains_any, grade_link_score
from admitta.session import materialize

NODES = (
    "page_id string, url string, faculty_slug string, pos int, tag string, text string, raw_text string, bare string, direct_link_chars int, link_chars int, direct_links boolean,"
    " ancestors array<string>, div_classes array<string>, in_container boolean, in_list boolean, href string, table_no int, row_no int, cell_no int, cells int"
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Tags that end an open one of the same kind.
_CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
_KEPT = {"li", "a", "td", "th", "tr", "h1", "h2", "h3"}


class _Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def texts(self) -> Iterator[str]:
        left = self.children[::-1]
        while left:
            c = left.pop()
            if isinstance(c, str):
                yield c
            elif c.tag not in ("script", "style"):
                left.extend(reversed(c.children))

    def walk(self) -> Iterator[_Node]:
        left = [self]
        while left:
            n = left.pop()
            yield n
            left.extend(c for c in reversed(n.children) if not isinstance(c, str))

    def up(self) -> Iterator[_Node]:
        n = self.parent
        while n is not None:
            yield n
            n = n.parent


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("#", {}, None)

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag, ())
        if self.at.tag in closes or (tag == "tr" and self.at.parent and self.at.tag in closes):
            while self.at.tag in closes and self.at.parent is not None:
                self.at = self.at.parent
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _selects(node: _Node, selector: str) -> bool:
    tag, _, ident = selector.partition("#")
    if ident:
        return node.tag == tag and node.attrs.get("id") == ident
    if selector.startswith("."):
        return selector[1:] in node.attrs.get("class", "").split()
    return node.tag == selector


def page_nodes(html: str, containers: Iterable[str] = CONTAINERS) -> list[dict]:
    """The kept nodes of a page in document order; the first container that matches bounds the content."""
    parser = _Tree()
    parser.feed(html or "")
    parser.close()
    every = list(parser.root.walk())
    content = next((n for s in containers for n in every if _selects(n, s)), parser.root)
    inside = {id(n) for n in content.walk()}
    tables = {id(n): i for i, n in enumerate(x for x in every if x.tag == "table")}
    out, rows = [], {}
    # the place of each cell in its row, and the data cells of each row
    places: dict[int, int] = {}
    widths: dict[int, int] = {}
    for n in every:
        if n.tag == "tr":
            cells = [c for c in n.children if not isinstance(c, str) and c.tag in ("td", "th")]
            places.update((id(c), i) for i, c in enumerate(cells))
            widths[id(n)] = sum(c.tag == "td" for c in cells)
    for pos, n in enumerate(every):
        if n.tag not in _KEPT:
            continue
        parts = [t.strip() for t in n.texts()]
        up = list(n.up())
        direct = [c for c in n.children if not isinstance(c, str) and c.tag == "a"]
        links = [x for x in n.walk() if x.tag == "a" and x is not n]
        chars = lambda nodes: sum(len("".join(t.strip() for t in x.texts())) for x in nodes)
        table = next((x for x in up if x.tag == "table"), None)
        row = n if n.tag == "tr" else next((x for x in up if x.tag == "tr"), None)
        cell_no = None
        if table is not None and row is not None:
            rows.setdefault(id(table), {}).setdefault(id(row), len(rows.get(id(table), {})))
            if n.tag in ("td", "th"):
                cell_no = places.get(id(n))
        out.append({
            "pos": pos, "tag": n.tag, "text": " ".join(" ".join(p for p in parts if p).split()), "raw_text": " ".join(p for p in parts if p), "bare": "".join(parts), "direct_link_chars": chars(direct), "link_chars": chars(links), "direct_links": bool(direct),
            "ancestors": [x.tag for x in up if x.tag != "#"], "div_classes": [x.attrs["class"].lower() for x in up if x.tag == "div" and x.attrs.get("class")], "in_container": id(n) in inside,
            "in_list": any(x.tag == "ul" and id(x) in inside for x in up), "href": n.attrs.get("href") if n.tag == "a" else None, "table_no": tables.get(id(table)) if table is not None else None,
            "row_no": rows[id(table)][id(row)] if table is not None and row is not None else None, "cell_no": cell_no,
            "cells": widths[id(row)] if row is not None else None,
        })
    return out


def dom_nodes(pages: DataFrame) -> DataFrame:
    """Nodes of pages (page_id, url, faculty_slug, html). A null or empty page has none."""

    def explode(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in NODES.split(", ")]
        for batch in batches:
            found = [{"page_id": p, "url": u, "faculty_slug": s} | n for p, u, s, h in batch.itertuples(index=False) for n in page_nodes(h)]
            yield pd.DataFrame(found, columns=names).astype(object).where(lambda d: d.notna(), None) if found else pd.DataFrame(columns=names)

    return pages.select(F.col("page_id").cast("string"), "url", "faculty_slug", "html").mapInPandas(explode, NODES)


def structural_garbage(text: Column, direct_links: Column, direct_chars: Column, link_chars: Column, tag: Column, ancestors: Column, div_classes: Column, density: float = 0.8, short: int = 50, nav_short: int = 30) -> Column:
    """F6 over ``bare`` text: empty, nearly all links and short, inside navigation, or a short navigation word."""
    chars = F.when(direct_links, direct_chars).when(tag == "li", link_chars).otherwise(0)
    dense = (chars > 0) & (chars / F.length(text) > density) & (F.length(text) < short)
    placed = F.arrays_overlap(ancestors, F.array(*map(F.lit, ("nav", "footer", "header"))))
    classed = F.exists(div_classes, lambda c: contains_any(c, NAVIGATION_CLASSES))
    word = contains_any(F.lower(text), NAVIGATION) & (F.length(text) < nav_short)
    return (text == "") | F.coalesce(dense, F.lit(False)) | placed | classed | word


def accepts_item(text: Column) -> Column:
    """counts and no noise, or a programme word, no noise and ten letters; never a contact line."""
    low = F.lower(text)
    spots, noise, listed = text.rlike(BUDGET_PATTERN) | text.rlike(TAX_PATTERN), contains_any(low, LIST_NOISE_MORE), contains_any(low, LIST_WHITELIST)
    return ((spots & ~noise) | (~spots & listed & ~noise & (F.length(text) >= 10))) & ~text.rlike(r"(?i)^(tel|fax|str|bd|nr)\.?\s*:")


def _entity(df: DataFrame, **more: Column) -> DataFrame:
    base = {
        "uid": program_uid(F.col("url"), F.col("name")), "source_url": F.col("url"), "name": F.col("name"), "faculty_uid": faculty_uid(F.col("faculty_slug")), "faculty_slug": F.col("faculty_slug"),
        "level": url_level(F.col("url")), "duration_years": url_duration(F.col("url")),
    }
    return df.select(*(c.alias(k) for k, c in (base | more).items()), "seq")


def list_programmes(nodes: DataFrame) -> DataFrame:
    """E20 with the running domain (W1): programmes from list items."""
    items = nodes.where("tag = 'li' AND in_container AND in_list AND text <> ''")
    heading = F.lower("text").startswith("domeniul")
    items = items.withColumn("domain", fill_forward(F.when(heading, domain_label(F.col("text"))), ["page_id"], ["pos"]))
    kept = items.where(~heading & ~structural_garbage(*(F.col(c) for c in ("bare", "direct_links", "direct_link_chars", "link_chars", "tag", "ancestors", "div_classes"))) & accepts_item(F.col("text")))
    spots = list_spots(F.col("raw_text"))
    kept = kept.withColumn("name", item_name(F.col("text"))).withColumn("spots", spots).withColumn("seq", F.col("pos"))
    counted = F.col("text").rlike(BUDGET_PATTERN) | F.col("text").rlike(TAX_PATTERN)
    raw = F.when(counted, F.col("name"))
    budget = F.col("spots.budget")
    return _entity(
        kept, language=name_language(F.col("name")), content_hash=content_hash(F.col("name")), spots_budget=budget, spots_tax=F.col("spots.tax"),
        spots_raw=F.when(F.coalesce("domain", F.lit("")) != "", F.concat(F.coalesce(raw, F.col("name")), F.lit(" [Domain: "), F.col("domain"), F.lit("]"))).otherwise(raw),
        source_type=F.when(F.coalesce(budget, F.lit(0)) != 0, "html_text_parsed").otherwise("html_list_mixed"), accuracy_confidence=extraction_confidence(F.lit("list"), budget),
    )


def table_programmes(nodes: DataFrame) -> DataFrame:
    """Programmes from tables; columns by the words of the first row, else the second and fourth."""
    cells = nodes.where("tag IN ('td', 'th') AND in_container AND table_no IS NOT NULL AND cell_no IS NOT NULL")
    key = ["page_id", "url", "faculty_slug", "table_no"]
    low = F.lower("bare")
    columns = cells.where("row_no = 0").groupBy(*key).agg(F.max(F.when(F.contains(low, F.lit("buget")), F.col("cell_no"))).alias("b"), F.max(F.when(F.contains(low, F.lit("tax")), F.col("cell_no"))).alias("t"))
    # td cells only are counted in data rows
    rows = cells.where("row_no > 0 AND tag = 'td' AND cells >= 2").groupBy(*key, "row_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell_no", "bare", "pos"))), lambda c: c["bare"]).alias("c"), F.min("pos").alias("seq"))
    wide = rows.join(columns, key, "left").withColumn("clean", F.trim(F.regexp_replace(F.get("c", F.lit(0)), r"\s+", " ")))
    heading = F.lower("clean").startswith("domeniul")
    wide = wide.withColumn("domain", fill_forward(F.when(heading, domain_label(F.col("clean"))), ["page_id"], ["seq"]))
    number = lambda i: F.coalesce(F.when(F.replace(F.get("c", i), F.lit("*"), F.lit("")).rlike(r"^\d+$"), count_of(F.replace(F.get("c", i), F.lit("*"), F.lit("")))), F.lit(0))
    head = F.trim(F.get(F.split("clean", ":"), F.lit(0)))
    wide = wide.withColumn("budget", number(F.coalesce("b", F.lit(1)))).withColumn("tax", number(F.coalesce("t", F.lit(3)))).withColumn("name", F.when(head == "", F.col("clean")).otherwise(head))
    kept = wide.where(~heading & (F.length("clean") >= 5) & ~F.contains(F.lower("clean"), F.lit("din care")) & ((F.col("budget") > 0) | (F.col("tax") > 0) | contains_any(F.lower("name"), LIST_WHITELIST)))
    tail = F.when(F.coalesce("domain", F.lit("")) != "", F.concat(F.lit(" [Domain: "), F.col("domain"), F.lit("]"))).otherwise("")
    return _entity(
        kept, language=F.lit("Romanian"), content_hash=content_hash(F.col("name")), spots_budget=F.col("budget"), spots_tax=F.col("tax"),
        spots_raw=F.concat(F.lit("Table: "), F.get("c", F.lit(0)), F.lit(" | B:"), F.col("budget").cast("string"), F.lit(" T:"), F.col("tax").cast("string"), tail),
        source_type=F.lit("html_table_parsed"), accuracy_confidence=F.lit(0.85),
    )


def course_programmes(pages: DataFrame) -> DataFrame:
    """P18 as programmes."""
    named = pages.select("url", "faculty_slug", F.posexplode(course_names(F.col("html"))).alias("seq", "name"))
    none = F.lit(None)
    return _entity(named, language=F.lit("Romanian"), content_hash=content_hash(F.col("name")), spots_budget=none.cast("int"), spots_tax=none.cast("int"), spots_raw=none.cast("string"), source_type=F.lit("jsonld"), accuracy_confidence=F.lit(0.6))


def programmes(pages: DataFrame) -> DataFrame:
    """All three ways together; of one uid the last extracted record stays (JSON-LD, lists, tables)."""
    nodes = materialize(dom_nodes(pages))  # each page is parsed once
    return _programmes(pages, nodes)


def _programmes(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    parts = [course_programmes(pages), list_programmes(nodes), table_programmes(nodes)]
    every = None
    for stage, part in enumerate(parts):
        part = part.withColumn("stage", F.lit(stage))
        every = part if every is None else every.unionByName(part)
    cols = [c for c in every.columns if c not in ("uid", "seq", "stage")]
    return every.groupBy("uid").agg(F.max_by(F.struct(*cols), F.struct("stage", "seq")).alias("p")).select("uid", "p.*")


def links(nodes: DataFrame) -> DataFrame:
    """(page_id, url, pos, href, text, target) of all links with an address."""
    return nodes.where("tag = 'a' AND href IS NOT NULL").select("page_id", "url", "faculty_slug", "pos", F.trim("href").alias("href"), "text", "in_container", resolve_link(F.col("url"), F.trim("href")).alias("target"))


def pdf_links(nodes: DataFrame) -> DataFrame:
    """links to PDF files inside the content, as queue entries."""
    return links(nodes).where("in_container AND lower(href) LIKE '%.pdf'").select("faculty_slug", F.col("target").alias("pdf_url"), F.col("text").alias("link_text"), F.col("url").alias("source_url"), F.lit("queued").alias("status"), F.col("pos").alias("input_pos"))


def grade_links(nodes: DataFrame) -> DataFrame:
    """Links to result lists, best first."""
    scored = links(nodes).where("in_container AND lower(href) LIKE '%.pdf'").withColumn("score", grade_link_score(F.col("text"), F.col("href")))
    return scored.where("score > 0").orderBy(F.desc("score"), "page_id", "pos")


def with_fallback(pages: DataFrame, rendered: DataFrame) -> DataFrame:
    """ST6: pages that give neither programmes nor papers are taken from the rendered copies instead."""
    nodes = materialize(dom_nodes(pages))
    useful = list_programmes(nodes).select(F.col("source_url").alias("url")).unionByName(table_programmes(nodes).select(F.col("source_url").alias("url"))).unionByName(pdf_links(nodes).select(F.col("source_url").alias("url"))).dropDuplicates()
    again = pages.select("url").join(useful, "url", "left_anti").dropDuplicates()
    return _programmes(pages, nodes).unionByName(programmes(rendered.join(again, "url", "left_semi")))
