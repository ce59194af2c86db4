"""Adapters of universities: what differs from one to the next, as DataFrames, found by name.

An adapter lists the faculties and reads pages, papers and grades; the pipeline only knows the
protocol. ``PageAdapter`` has the engine's own readers, so an adapter of its own overrides what its
pages need otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from admitta.operators import boilerplate, grades, html, rank


@runtime_checkable
class Adapter(Protocol):
    """slug and name of the university; faculties (pos, slug, name, urls); programmes, papers and grade papers of pages (page_id, url, faculty_slug, html); grades of table cells; ranking of papers; lines without boilerplate."""

    slug: str
    name: str

    def faculties(self, spark: SparkSession) -> DataFrame: ...

    def programmes(self, pages: DataFrame) -> DataFrame: ...

    def papers(self, pages: DataFrame) -> DataFrame: ...

    def grade_papers(self, pages: DataFrame) -> DataFrame: ...

    def grades(self, cells: DataFrame) -> DataFrame: ...

    def ranked(self, queue: DataFrame, year: int, target: str = "SPOTS") -> DataFrame: ...

    def without_boilerplate(self, lines: DataFrame) -> DataFrame: ...


class PageAdapter:
    """The engine's readers as an adapter; subclasses say which faculties there are."""

    slug = name = ""

    def faculties(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError

    def programmes(self, pages: DataFrame) -> DataFrame:
        return html.programmes(pages)

    def papers(self, pages: DataFrame) -> DataFrame:
        return html.pdf_links(html.dom_nodes(pages))

    def grade_papers(self, pages: DataFrame) -> DataFrame:
        return html.grade_links(html.dom_nodes(pages))

    def grades(self, cells: DataFrame) -> DataFrame:
        return grades.lowest_grades(grades.table_grades(cells), ["program_name"])

    def ranked(self, queue: DataFrame, year: int, target: str = "SPOTS") -> DataFrame:
        return rank.ranked_queue(queue, year, target)

    def without_boilerplate(self, lines: DataFrame) -> DataFrame:
        return boilerplate.without_repeated(lines, boilerplate.repeated_lines(lines))


_REGISTRY: dict[str, Callable[[], Adapter]] = {}


def register(slug: str):
    """Makes an adapter class findable by the university's slug; a slug is taken once."""

    def keep(make: Callable[[], Adapter]):
        if slug in _REGISTRY:
            raise ValueError(f"{slug} is already registered")
        make.slug = slug
        _REGISTRY[slug] = make
        return make

    return keep


def registered() -> list[str]:
    return sorted(_REGISTRY)


def adapter(slug: str) -> Adapter:
    if slug not in _REGISTRY:
        raise KeyError(f"no adapter for {slug}; there are {registered()}")
    return _REGISTRY[slug]()
