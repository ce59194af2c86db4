"""Pages and papers from the web, and texts of papers (SC10 to SC16): data sources with exchangeable fetchers.

Fetching needs a network and reading papers a library; both are parameters, so the logic of retries,
breakers and content checks runs and is tested without them.
"""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FETCHED = "url string, status string, code int, content binary, content_type string, tries int"
#: Seconds between two requests of a fetcher, drawn at random.
POLITE = (1.0, 3.0)
PAGES = "pdf_url string, page_no int, text string, tables array<array<array<string>>>"
RETRIED = frozenset({429, 500, 502, 503, 504})


@dataclass(frozen=True)
class Answer:
    code: int
    content: bytes = b""
    content_type: str = ""


@dataclass
class PoliteFetcher:
    """SC10 to SC13: waits 1 to 3 s before each request with one of several headers, tries again after 1, 2, 4 seconds on busy servers; stops asking a host after ``breaker`` failures in a row.

    ``get`` takes an address, or with ``headers`` an address and one of them, in turn by chance.
    """

    get: Callable[..., Answer]
    tries: int = 3
    breaker: int = 3
    wait: Callable[[float], None] = time.sleep
    wanted: str | None = None
    failures: dict[str, int] = field(default_factory=dict)
    polite: tuple[float, float] | None = POLITE
    headers: Sequence[Mapping[str, str]] = ()
    chance: random.Random = field(default_factory=random.Random)

    def _ask(self, url: str) -> Answer:
        if self.polite:
            self.wait(self.chance.uniform(*self.polite))
        try:
            return self.get(url, self.chance.choice(self.headers)) if self.headers else self.get(url)
        except OSError:
            return Answer(0)

    def __call__(self, url: str) -> dict:
        host = re.sub(r"^[a-z]+://([^/]*).*$", r"\1", url)
        if self.failures.get(host, 0) >= self.breaker:
            return {"url": url, "status": "circuit_open", "code": None, "content": None, "content_type": None, "tries": 0}
        answer, n = Answer(0), 0
        for n in range(1, self.tries + 1):
            answer = self._ask(url)
            if answer.code and answer.code not in RETRIED:
                break
            if n < self.tries:
                self.wait(2.0 ** (n - 1))
        ok = answer.code == 200 and (self.wanted is None or self.wanted in answer.content_type)
        self.failures[host] = 0 if ok else self.failures.get(host, 0) + 1
        return {"url": url, "status": "downloaded" if ok else "failed", "code": answer.code or None, "content": answer.content if ok else None, "content_type": answer.content_type, "tries": n}


class Browser(Protocol):
    """What SC12 needs of a browser: the page's HTML after its scripts ran."""

    def html(self, url: str) -> str: ...

    def close(self) -> None: ...


@dataclass
class RenderedFetcher:
    """SC12: pages as a browser shows them, as (url, status, content). One browser per lane, started at the first page."""

    start: Callable[[], Browser]
    browser: Browser | None = None

    def __call__(self, url: str) -> dict:
        try:
            if self.browser is None:
                self.browser = self.start()
            text = self.browser.html(url)
        except OSError:
            text = None
        status = "rendered" if text else "failed"
        return {"url": url, "status": status, "code": 200 if text else None, "content": text.encode("utf-8") if text else None, "content_type": "text/html", "tries": 1}

    def close(self) -> None:
        if self.browser is not None:
            self.browser.close()
            self.browser = None


def fetch(urls: DataFrame, make: Callable[[], Callable[[str], dict]], lanes: int = 8) -> DataFrame:
    """ST3: fetch (url) with at most ``lanes`` requests at a time, all of a host in one lane. ``make`` builds a fetcher per lane."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = make()
        try:
            for batch in batches:
                yield pd.DataFrame([one(u) for u in batch["url"]], columns=[f.split()[0] for f in FETCHED.split(", ")])
        finally:
            getattr(one, "close", lambda: None)()

    hosted = urls.select("url", F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1).alias("_h")).repartition(lanes, "_h").sortWithinPartitions("_h", "url")
    return hosted.select("url").mapInPandas(run, FETCHED)


class WebSource(DataSource):
    """``spark.read.format("web").option("urls", "a,b")``: a reader over a registered fetcher."""

    get: Callable[[str], Answer] | None = None

    @classmethod
    def name(cls) -> str:
        return "web"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema) -> DataSourceReader:
        return _WebReader(self.options, type(self).get)


def web_source(get: Callable[[str], Answer]) -> type[WebSource]:
    """The web reader over a fetcher: ``spark.dataSource.register(web_source(get))``. It travels to the workers with the fetcher in it."""

    class Fetched(WebSource):
        pass

    Fetched.get = staticmethod(get)
    return Fetched


class _WebReader(DataSourceReader):
    def __init__(self, options, get):
        self.urls, self.get = [u for u in options.get("urls", "").split(",") if u], get

    def partitions(self):
        return [InputPartition(u) for u in self.urls] or [InputPartition(None)]

    def read(self, partition):
        if partition.value is None:
            return
        if self.get is None:
            raise RuntimeError("no fetcher is registered; set WebSource.get")
        r = PoliteFetcher(self.get, polite=None)(partition.value)
        yield tuple(r[f.split()[0]] for f in FETCHED.split(", "))


def paper_pages(files: DataFrame, extract: Callable[[bytes], list[tuple[str, list]]], unreadable: tuple[type[Exception], ...] = (ValueError, OSError, EOFError, KeyError)) -> DataFrame:
    """SC15, SC16: (pdf_url, page_no, text, tables, error) from (pdf_url, content) by an extractor of page texts and tables.

    A paper whose extractor raises one of ``unreadable`` has one row without page, with the error; any
    other exception ends the job.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, content in batch[["pdf_url", "content"]].itertuples(index=False):
                try:
                    pages = extract(bytes(content)) if content is not None else []
                except unreadable as e:
                    out.append((url, None, None, None, f"{type(e).__name__}: {e}"))
                    continue
                out += [(url, i + 1, text, tables, None) for i, (text, tables) in enumerate(pages)]
            found = pd.DataFrame(out, columns=["pdf_url", "page_no", "text", "tables", "error"])
            yield found.astype({"page_no": "Int32"})

    return files.select("pdf_url", "content").mapInPandas(run, PAGES + ", error string")


def due(queue: DataFrame, waiting: Sequence[str] = ("queued", "pending")) -> DataFrame:
    """(url) of the entries that wait for their download, each address once; entries without an address are left out."""
    return queue.where(F.col("status").isin(*waiting)).select(F.coalesce("pdf_url", "url").alias("url")).where("url IS NOT NULL").dropDuplicates()


def not_stored(wanted: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """SC14: what is not there yet; only this is downloaded."""
    return wanted.join(stored.select(key).where(F.col(key).isNotNull()).dropDuplicates(), key, "left_anti")


def stored_name(content: Column) -> Column:
    """Content-addressed name of a stored paper."""
    return F.concat(F.left(F.sha2(content, 256), F.lit(16)), F.lit(".pdf"))


def stored_name_of(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()[:16] + ".pdf"


def safe_file_name(c: Column) -> Column:
    """SC14: letters, digits, point, underscore and hyphen only."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}._-]", "")
