"""From raw pages to the tables of one scan: the documentation site, the main site and snapshot pages.

Raw pages are rows of url, status and body (NULL or '' where the fetch failed). Each function parses every page once, writes
what it found to the checkpoint folder and builds all its tables from there, ready to be merged and published together.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_iso
from ledgerloom.functions.links import format_via, join_url, link_kind, portal_revision, refresh_target
from ledgerloom.functions.urls import area_of, canonical, host
from ledgerloom.operators import catalog
from ledgerloom.operators.ledger import first_wins
from ledgerloom.session import cut_lineage
from ledgerloom.sources.html import read_archive, read_docs_pages, read_index, read_links, read_tables


def scan_archive(raw: DataFrame, menu_url: str, wanted: str, docs_url: str, hosts: dict[str, list[str]]) -> dict[str, DataFrame]:
    """release-notes: the links of every archive page the menu leads to, without those back to the docs host; archive_pages: their status.

    A page the menu names but that was not fetched has status 0.
    """
    at, last = canonical(F.col("url")), F.regexp_extract(F.regexp_replace("page", "/+$", ""), "([^/]*)$", 1)
    menu = read_archive(raw.where((at == canonical(F.lit(menu_url))) & (F.col("status") == 200)), wanted).select(canonical(F.col("url")).alias("page")).distinct()
    pages = menu.join(raw.withColumn("page", at), "page", "left").select("page", F.coalesce("url", "page").alias("url"), F.coalesce("status", F.lit(0)).alias("status"), "body")
    found = cut_lineage(read_links(pages.where("status = 200"))).withColumn("fv", format_via(link_kind(F.col("href"), F.col("label"), **hosts)))
    found = found.where(F.regexp_replace(host(F.col("href")), ":[0-9]*$", "") != F.regexp_replace(host(F.lit(docs_url)), ":[0-9]*$", ""))
    rows = found.select(last.alias("archive_page"), F.col("label").alias("title"), F.col("fv.format").alias("format"), F.col("fv.via").alias("via"), F.col("href").alias("url"), "page", F.col("pos").alias("ord"))
    return {"release-notes": first_wins(rows, ["archive_page", "url"], [F.col("page"), F.col("ord")]).drop("page"), "archive_pages": pages.select("page", "status")}


def scan_docs(
    raw: DataFrame, index_url: str, wanted: str, hosts: dict[str, list[str]], site_suffix: str = "", archive_url: str = "/support/release-notes/", archive_wanted: str = "/release-notes/product/"
) -> dict[str, DataFrame]:
    """pages, listings and health of the documentation site, and release-notes and archive_pages of its archive.

    An index entry owns its own page and, through that page's menu, the pages of its releases; index links win over menu
    links, earlier entries over later ones. A page no entry owns is an orphan. Listings are the items of every page. The
    archive's menu and the pages it leads to are no documentation pages.
    """
    at = canonical(F.col("url"))
    menu_url = urljoin(index_url, archive_url)
    archive = scan_archive(raw, menu_url, archive_wanted, index_url, hosts)
    index = cut_lineage(read_index(raw.where(at == canonical(F.lit(index_url))), wanted))
    entries = index.select(canonical(F.col("url")).alias("url"), "heading", F.col("label").alias("entry"), F.col("pos").alias("ord"))
    entries = first_wins(entries, ["url"], [F.col("ord")])
    pages = raw.where(~at.isin(canonical(F.lit(index_url)), canonical(F.lit(menu_url)))).select(F.col("url"), "status", "body")
    pages = pages.withColumn("page", at).join(archive["archive_pages"], "page", "left_anti").drop("page")
    parsed = cut_lineage(read_docs_pages(pages, wanted, site_suffix)).join(pages.select("url", "status"), "url").withColumn("page", canonical(F.col("url")))
    options = parsed.select("page", F.posexplode("doc.options").alias("pos", "o")).select("page", "pos", F.col("o.label").alias("label"), canonical(F.col("o.url")).alias("target"))
    menu = options.join(entries.withColumnRenamed("url", "page"), "page").select(F.col("target").alias("url"), "heading", "entry", "ord")
    owners = catalog.page_owners(entries, menu).withColumnRenamed("url", "page")
    homes = entries.groupBy("entry").agg(F.min_by("url", "ord").alias("entry_page"))
    owned = parsed.join(owners, "page", "left").join(homes, "entry", "left")
    menus = options.join(entries.withColumnRenamed("url", "page"), "page").select("entry", "label", F.col("target").alias("page"), "pos")
    marked = catalog.latest_mark(menus, owned.select("page", "entry", "entry_page", F.col("doc.selected").alias("label")))
    full = owned.join(marked.select("page", "is_latest"), "page")
    latest = F.when(F.col("is_latest"), "yes").otherwise("")
    role = catalog.role_of(F.col("entry"), F.col("page"), F.col("entry_page"))
    page_rows = full.select(
        F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("entry", F.lit("")).alias("entry"), role.alias("role"), latest.alias("latest"), F.col("doc.selected").alias("release"),
        F.col("doc.title").alias("page_title"), "status", F.size("doc.items").alias("items"), F.size("doc.options").alias("releases"), "page",
    )
    items = full.select("heading", "entry", F.col("doc.selected").alias("release"), latest.alias("latest"), "page", F.posexplode("doc.items").alias("ord", "i"))
    kind = link_kind(F.col("i.url"), F.col("i.title"), **hosts)
    listings = items.withColumn("fv", format_via(kind)).select(
        F.coalesce("heading", F.lit("")).alias("heading"), F.coalesce("entry", F.lit("")).alias("entry"), "release", "latest", F.col("i.title").alias("title"), F.col("i.date").alias("date"),
        month_iso(F.col("i.date")).alias("month"), F.col("fv.format").alias("format"), F.col("fv.via").alias("via"), host(F.col("i.url")).alias("host"), F.col("i.url").alias("url"), "page", "ord",
    )
    health = catalog.page_health(full.select("page", "status", F.size("doc.items").alias("items"), F.col("doc.missed").alias("missed"), F.col("doc.selects").alias("selects"), F.col("doc.signals").alias("signals"), "entry"))
    return {"pages": page_rows, "listings": listings, "health": health, **archive}


def guide_redirects(raw: DataFrame) -> DataFrame:
    """url, redirect, revision of HTML guides' root pages; pages that lead nowhere are left out."""
    base = F.when(F.col("url").endswith("/"), F.col("url")).otherwise(F.concat("url", F.lit("/")))
    moved = raw.select("url", base.alias("base"), refresh_target(F.col("body")).alias("to")).where("to <> ''")
    return moved.select("url", join_url("base", "to").alias("redirect")).withColumn("revision", portal_revision(F.col("redirect")))


def scan_main(raw: DataFrame, datasheet_areas: Sequence[str], hosts: dict[str, list[str]]) -> dict[str, DataFrame]:
    """pages, listings and datasheets of the main site, without the links that are furniture of the site or an area."""
    pages = raw.select("url", "status", F.coalesce("body", F.lit("")).alias("body")).withColumn("area", area_of(F.col("url")))
    n = pages.count()
    found = cut_lineage(read_links(pages)).withColumn("area", area_of(F.col("page"))).withColumn("kind", link_kind(F.col("href"), F.col("label"), **hosts))
    found = found.withColumn("is_hub", F.col("kind") == "hub")
    wide = catalog.furniture(found, n)
    narrow = catalog.area_furniture(found, pages.select("area", F.col("url").alias("page")))
    kept = catalog.content_links(found, wide, narrow).withColumn("fv", format_via(F.col("kind")))
    listings = first_wins(
        kept.select("area", "page", "heading", "label", F.col("fv.format").alias("format"), F.col("fv.via").alias("via"), host(F.col("href")).alias("host"), F.col("href").alias("url"), F.col("pos").alias("ord")),
        ["page", "url"], [F.col("ord")],
    )
    listings = listings.where(catalog.bearing(F.col("via"), F.col("format")))
    title = F.trim(F.regexp_extract("body", r"(?is)<title[^>]*>(.*?)</title>", 1))
    counts = kept.groupBy("page").agg(F.count("*").alias("links"), F.count_if("is_hub").alias("hub_files"))
    page_rows = pages.join(counts.withColumnRenamed("page", "url"), "url", "left").select(
        "area", title.alias("title"), "status", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("hub_files", F.lit(0)).alias("hub_files"), "url"
    )
    sheet = kept.where(catalog.datasheet_link(F.split_part("area", F.lit("/"), F.lit(1)), F.col("is_hub"), F.col("label"), datasheet_areas))
    product = F.trim(F.split_part(F.coalesce("title", F.lit("")), F.lit("|"), F.lit(1)))
    sheets = sheet.join(page_rows.select(F.col("url").alias("page"), "title"), "page").select(product.alias("product"), "label", "page", F.col("href").alias("url"), F.col("pos").alias("ord"))
    return {"pages": page_rows, "listings": listings, "datasheets": first_wins(sheets, ["page", "url"], [F.col("ord")])}


def main_summary(pages: DataFrame) -> DataFrame:
    """metric, n: pages in scope, failed, hub files and links of the main site."""
    sums = pages.agg(F.count("*").alias("pages"), F.count_if(F.col("status") != 200).alias("failed"), F.sum("hub_files").alias("hub_files"), F.sum("links").alias("links"))
    return sums.unpivot([], ["pages", "failed", "hub_files", "links"], "metric", "n")


def scan_snapshots(raw: DataFrame, site: str) -> dict[str, DataFrame]:
    """The index (site, name, title, status, tables, rows, url) and the table cells of snapshot pages; a failed page has name ''."""
    cells = cut_lineage(read_tables(raw.select("url", "body"))).withColumn("site", F.lit(site))
    sizes = cells.groupBy("page").agg(F.count_distinct("table_no").alias("tables"), F.count_distinct("table_no", "row_no").alias("rows"))
    last = F.regexp_extract(F.regexp_replace("url", "/+$", ""), "([^/]*)$", 1)
    title = F.trim(F.split_part(F.regexp_extract(F.coalesce("body", F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit(" | "), F.lit(1)))
    index = raw.join(sizes.withColumnRenamed("page", "url"), "url", "left").select(
        F.lit(site).alias("site"), F.when(F.col("status") == 200, F.concat(F.lit(f"{site}/"), last)).otherwise("").alias("name"), title.alias("title"), "status",
        F.coalesce("tables", F.lit(0)).cast("int").alias("tables"), F.coalesce("rows", F.lit(0)).cast("int").alias("rows"), "url",
    )
    return {"index": index, "cells": cells.withColumnRenamed("page", "url")}


def snapshot_totals(index: DataFrame) -> DataFrame:
    """Pages, tables and rows of each site's snapshots."""
    return index.groupBy("site").agg(F.count("*").alias("pages"), F.sum("tables").alias("tables"), F.sum("rows").alias("rows"))


def write_snapshots(cells: DataFrame, path: str) -> None:
    """Cells by site and page; what was written of a page before is replaced, other pages stay."""
    cells.withColumn("page", F.regexp_extract(F.regexp_replace("url", "/+$", ""), "([^/]*)$", 1)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("site", "page").parquet(path)
