"""The Python functions under SQL names, for sessions that are used through SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.links import join_url, quote_url
from ledgerloom.sources.html import content_links, index_entries, snapshot_page


@F.udtf(returnType="pos int, label string, href string, heading string")
class PageLinks:
    """page_links(body, url): the links of a page's main content with the heading before each."""

    def eval(self, body: str, url: str):  # noqa: ANN201
        if body is not None:
            yield from content_links(body, url or "")


@F.udtf(returnType="heading string, label string, url string")
class IndexEntries:
    """index_entries(body, url, wanted): the entries an index page lists by section."""

    def eval(self, body: str, url: str, wanted: str):  # noqa: ANN201
        if body is not None:
            yield from index_entries(body, url or "", wanted)


@F.udtf(returnType="table_no int, caption string, row_no int, col_no int, header string, value string")
class PageTables:
    """page_tables(body, url): the cells of a page's tables."""

    def eval(self, body: str, url: str):  # noqa: ANN201
        for t, table in enumerate(snapshot_page(body, url or "")["tables"] if body is not None else []):
            for r, row in enumerate(table["rows"]):
                for c, value in enumerate(row):
                    yield t, table["caption"], r, c, table["header"][c] if c < len(table["header"]) else f"col {c + 1}", value


def register(spark: SparkSession) -> None:
    """Makes join_url, quote_url, page_links, index_entries and page_tables known to SQL."""
    for name, function in (("join_url", join_url), ("quote_url", quote_url)):
        spark.udf.register(name, function)
    for name, function in (("page_links", PageLinks), ("index_entries", IndexEntries), ("page_tables", PageTables)):
        spark.udtf.register(name, function)
