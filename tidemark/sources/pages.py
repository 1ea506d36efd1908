"""A data source of raw pages from a list of fetched files, and link scans of listings and sitemaps.

Fetching itself isn't part of the engine: whatever can fetch drops files here.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.functions.text import text_of
from tidemark.functions.urls import url_date
from tidemark.operators.html import hrefs


class PageReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in sorted(Path(self.folder).glob("*.html"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        p = Path(partition.value)
        yield p.stem, p.read_bytes().decode("utf-8", "replace")


class PageSource(DataSource):
    """``spark.read.format("pages").load(folder)``: ``name, html`` of every ``*.html`` of a shared folder."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "name string, html string"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"])


def listing(pages: DataFrame, html: str, page: str, good: Column | None = None) -> DataFrame:
    """Addresses that listing pages link to, with position and the date in them."""
    found = pages.select(page, F.posexplode(hrefs(html)).alias("position", "url")).withColumn("date", url_date("url"))
    return found.where(good) if good is not None else found


def sitemap(xml: Column | str) -> Column:
    """``loc`` and ``day`` of each entry of a sitemap."""
    entry = F.regexp_extract_all(text_of(xml), F.lit(r"(?is)<url>(.*?)</url>"), 1)
    loc = lambda e: F.trim(F.regexp_extract(e, r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>", 1))
    day = lambda e: F.regexp_extract(e, r"(?is)<(?:news:publication_date|lastmod)>\s*(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    return F.transform(entry, lambda e: F.struct(loc(e).alias("loc"), day(e).alias("day")))


def attributes(html: Column | str) -> Column:
    """Quoted attributes ``:name='value'`` of components as a map; of repeated names the last counts."""
    names = F.regexp_extract_all(text_of(html), F.lit(r""":([\w-]+)=["']([^"']*)["']"""), 1)
    values = F.regexp_extract_all(text_of(html), F.lit(r""":([\w-]+)=["']([^"']*)["']"""), 2)
    entries = F.arrays_zip(names.alias("n"), values.alias("v"))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries) + 1), lambda x: x["n"] == e["n"]))
    return F.map_from_entries(last)
