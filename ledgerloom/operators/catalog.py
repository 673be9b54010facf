"""From parsed pages to catalog tables: targets, owners, roles, latest marks, page furniture, documents, the document tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.rules import TypeRules
from ledgerloom.functions.text import text_or_empty
from ledgerloom.functions.urls import canonical, path
from ledgerloom.functions.versions import line_label, listed, version_key
from ledgerloom.operators.ledger import first_wins, fold_best

#: A link on at least so many pages, or on this share of them, is furniture of the site.
FURNITURE_PAGES, FURNITURE_SHARE = 8, 0.2
#: In an area of at least so many pages, a link on this share of them is furniture of the area.
AREA_PAGES, AREA_SHARE = 5, 0.6
NUMBERED = r"^v?[0-9]"
# What labels begin with that says nothing of the document, and labels that stand for a MIB archive.
EMPTY_LABEL = r"(?i)^(Download( PDF| Matrix| Excel| Zip)?|Learn More)\s*"
MIB_LABEL = "^(TAR|ZIP) Download$"


def page_targets(urls: DataFrame, areas: Sequence[str], resource_types: Sequence[str], url: str = "url") -> DataFrame:
    """Distinct addresses in scope: a top-level area, or resources/<type>/ and something below it."""
    bare = F.regexp_replace(F.col(url), "/+$", "")
    parts = F.filter(F.split(path(bare), "/"), lambda s: s != "")
    first = F.get(parts, F.lit(0))
    inside = first.isin(*areas) | ((first == "resources") & (F.size(parts) > 2) & F.get(parts, F.lit(1)).isin(*resource_types))
    return urls.where(inside).select(bare.alias(url)).distinct()


def snapshot_page(url: Column, rules: Sequence[str]) -> Column:
    """Whether a path is one of the rules, or lies below one that ends in /*; the parent itself doesn't."""
    bare = F.regexp_replace(path(url), "/+$", "")
    hit = F.lit(False)
    for rule in rules:
        stem = rule.rstrip("/")
        hit = hit | (bare.startswith(stem[:-1]) & (F.length(bare) > len(stem) - 1) if stem.endswith("/*") else bare == stem)
    return hit


def keep_link(href: Column) -> Column:
    """Whether a link leads to a page or file at all."""
    lowered = F.lower(F.trim(text_or_empty(href)))
    return ~(lowered.startswith("#") | lowered.startswith("javascript:") | lowered.startswith("mailto:") | lowered.startswith("tel:") | (lowered == ""))


def page_owners(index_links: DataFrame, menu_links: DataFrame) -> DataFrame:
    """url -> heading, entry: index links before menu links, earlier ones first. Both: url, heading, entry, ord."""
    edges = index_links.withColumn("_p", F.lit(0)).unionByName(menu_links.withColumn("_p", F.lit(1)))
    return first_wins(edges, ["url"], [F.col("_p"), F.col("ord")]).select("url", "heading", "entry")


def unread_options(options: DataFrame, parsed: DataFrame, url: str = "url") -> DataFrame:
    """Option pages that were not parsed yet."""
    return options.select(url).distinct().join(parsed.select(url), url, "left_anti")


def role_of(entry: Column, page: Column, entry_page: Column) -> Column:
    return F.when(entry.isNull(), "orphan").when(page == entry_page, "entry").otherwise("release")


def latest_mark(options: DataFrame, pages: DataFrame) -> DataFrame:
    """pages(page, entry, entry_page, label) with is_latest: on the entry's newest line, or the entry page itself where
    the menu has no numbered line or its label says latest. options: entry, label, page, pos.
    """
    lines = options.withColumn("_line", line_label(F.col("label"))).where(F.col("_line").isNotNull())
    newest = lines.groupBy("entry").agg(F.min(F.struct(F.col("pos").alias("p"), F.col("_line").alias("l"))).alias("f")).select("entry", F.col("f.l").alias("newest"))
    on_line = lines.join(newest, "entry").where(F.col("_line") == F.col("newest")).select("entry", "page").distinct().withColumn("_on", F.lit(True))
    marked = pages.join(newest, "entry", "left").join(on_line, ["entry", "page"], "left")
    own = (F.col("page") == F.col("entry_page")) & (F.col("newest").isNull() | F.lower(text_or_empty(F.col("label"))).contains("latest"))
    return marked.select(*pages.columns, (F.coalesce(F.col("_on"), F.lit(False)) | F.coalesce(own, F.lit(False))).alias("is_latest"))


def furniture(links: DataFrame, n_pages: int, least: int = FURNITURE_PAGES, share: float = FURNITURE_SHARE) -> DataFrame:
    """href, pages: links on at least max(least, share of all pages); failed pages count as pages. links: page, href."""
    return links.select("page", "href").distinct().groupBy("href").agg(F.count("*").alias("pages")).where(F.col("pages") >= max(float(least), share * n_pages))


def area_furniture(links: DataFrame, pages: DataFrame, least: int = AREA_PAGES, share: float = AREA_SHARE) -> DataFrame:
    """area, href, pages: links on a share of the pages of an area that has enough of them. links: area, page, href, is_hub."""
    sizes = pages.groupBy("area").agg(F.count_distinct("page").alias("size")).where(F.col("size") >= least)
    seen = links.where(~F.col("is_hub")).select("area", "page", "href").distinct().groupBy("area", "href").agg(F.count("*").alias("pages"))
    return seen.join(sizes, "area").where(F.col("pages") >= share * F.col("size")).select("area", "href", "pages")


def content_links(links: DataFrame, site_wide: DataFrame, by_area: DataFrame) -> DataFrame:
    """Links that are neither furniture nor lead to their own page."""
    kept = links.join(site_wide.select("href"), "href", "left_anti").join(by_area.select("area", "href"), ["area", "href"], "left_anti")
    return kept.where(canonical(F.col("href")) != canonical(F.col("page"))).select(*links.columns)


def datasheet_link(area: Column, is_hub: Column, label: Column, areas: Sequence[str]) -> Column:
    lowered = F.lower(text_or_empty(label))
    return area.isin(*areas) & is_hub & (lowered.rlike("data ?sheet") | lowered.startswith("view") | lowered.startswith("download"))


def bearing(via: Column, fmt: Column) -> Column:
    """Whether a main-site link bears a document."""
    return (via == "content_hub") | fmt.isin("pdf", "zip", "xlsx")


def page_health(pages: DataFrame) -> DataFrame:
    """check, detail, url, page: what a parsed page may hide. pages: page, status, items, missed (array), selects, signals (array), entry."""
    row = lambda check, detail, url=F.lit(""): F.struct(F.lit(check).alias("check"), detail.cast("string").alias("detail"), url.alias("url"))
    one = lambda holds, r: F.when(holds, F.array(r)).otherwise(F.array().cast("array<struct<check:string,detail:string,url:string>>"))
    found = F.concat(
        one(F.col("status") != 200, row("fetch-failed", F.col("status"))),
        F.transform(F.coalesce("missed", F.array().cast("array<string>")), lambda u: row("missed-link", F.lit(""), u)),
        one(F.col("selects") > 1, row("extra-dropdown", F.col("selects"))),
        F.transform(F.coalesce("signals", F.array().cast("array<string>")), lambda s: row("structure", s)),
        one((F.col("status") == 200) & (F.col("items") == 0), row("empty-page", F.lit(""))),
        one(F.col("entry").isNull(), row("orphan-page", F.lit(""))),
    )
    return pages.select("page", F.explode(found).alias("h")).select("h.check", "h.detail", "h.url", "page")


def lost_datasheets(had: DataFrame, has: DataFrame, fetched: DataFrame, page: str = "page") -> DataFrame:
    """Pages that had a datasheet and have none now, among those fetched this time."""
    return had.select(page).distinct().join(has.select(page), page, "left_anti").join(fetched.select(page), page, "left_semi")


def unread_labels(pages: DataFrame, categories: str) -> DataFrame:
    """Release labels that are neither numbered nor a known category."""
    label = text_or_empty(F.col("label"))
    return pages.where(F.col("role").isin("entry", "release") & (label != "") & ~label.rlike(NUMBERED) & ~label.rlike(f"(?i){categories}"))


def documents(listed: Sequence[DataFrame], before: DataFrame, redirects: DataFrame) -> DataFrame:
    """One row per address over several current views (url, title, format, via, host, ord), the first view and row winning.

    redirect is this scan's if there is one, else the last known; revision likewise. before: url, redirect, revision;
    redirects: url, redirect, revision.
    """
    union = None
    for n, view in enumerate(listed):
        rows = view.select("url", "title", "format", "via", "host", "ord").withColumn("_v", F.lit(n))
        union = rows if union is None else union.unionByName(rows)
    once = first_wins(union, ["url"], [F.col("_v"), F.col("ord")]).select("url", "title", "format", "via", "host")
    new = redirects.select("url", F.col("redirect").alias("_r1"), F.col("revision").alias("_v1"))
    old = before.select("url", F.col("redirect").alias("_r0"), F.col("revision").alias("_v0"))
    known = once.join(new, "url", "left").join(old, "url", "left")
    blank = F.lit("")
    fresh = F.nullif(F.col("_r1"), blank).isNotNull()
    return known.select(
        *once.columns, F.when(fresh, F.col("_r1")).otherwise(F.coalesce("_r0", blank)).alias("redirect"), F.when(fresh, F.coalesce("_v1", blank)).otherwise(F.coalesce("_v0", blank)).alias("revision")
    )


def entry_documents(listings: DataFrame, rules: TypeRules, order: str = "ord") -> DataFrame:
    """Each entry's documents, one row per address: the one kept by the ordered fold over the entry's listings."""
    rows = listings.withColumn("_latest", F.col("latest") == "yes").withColumn("_key", listed(version_key(F.col("release"))))
    rows = rows.withColumn("_payload", F.struct("heading", "title", "release", "latest", "month", "format", "via"))
    kept = fold_best(rows, ["entry", "url"], order, "_latest", "_key", "_payload").select("entry", "url", F.col(order).alias("ord"), "_payload.*")
    return kept.select(
        F.lit("docs").alias("site"), "heading", "entry", "title", F.coalesce("release", F.lit("")).alias("release"), (F.col("latest") == "yes").alias("is_latest"), "month", "format", "via",
        rules.document_type(F.col("title"), F.col("format")).alias("type"), rules.is_translation(F.col("title")).alias("is_translation"), "url", F.array().cast("array<string>").alias("ents"), "ord",
    )


def datasheet_documents(datasheets: DataFrame, entries: DataFrame, pairs: Mapping[str, Sequence[str]], order: str = "ord") -> DataFrame:
    """Datasheets as documents, one per address without its query; entries by exact name, else by the pairs that exist.

    datasheets: product, url, ord; entries: entry.
    """
    bare = F.split_part(F.col("url"), F.lit("?"), F.lit(1))
    once = first_wins(datasheets.select("product", "url", bare.alias("_bare"), F.col(order).alias("ord")), ["_bare"], [F.col("ord")])
    listed_pairs = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.array(*[F.lit(e) for e in v]).cast("array<string>"))]) if pairs else None
    paired = F.try_element_at(listed_pairs, F.col("product")) if listed_pairs is not None else F.lit(None).cast("array<string>")
    wanted = once.select("*", F.explode_outer(F.concat(F.array("product"), F.coalesce(paired, F.array().cast("array<string>")))).alias("_e"))
    exists = entries.select(F.col("entry").alias("_e")).distinct().withColumn("_is", F.lit(True))
    met = wanted.join(exists, "_e", "left").groupBy("_bare", "product", "url", "ord").agg(
        F.array_sort(F.collect_set(F.when(F.col("_is"), F.col("_e")))).alias("_all")
    )
    ents = F.when(F.array_contains("_all", F.col("product")), F.array("product")).otherwise(F.col("_all"))
    return met.select(
        F.lit("main").alias("site"), F.lit("").alias("heading"), F.col("product").alias("entry"), F.concat("product", F.lit(" Data Sheet")).alias("title"), F.lit("").alias("release"),
        F.lit(True).alias("is_latest"), F.lit("").alias("month"), F.lit("file").alias("format"), F.lit("content_hub").alias("via"), F.lit("Datasheet").alias("type"),
        F.lit(False).alias("is_translation"), "url", ents.alias("ents"), "ord",
    )


def main_documents(links: DataFrame, titles: DataFrame, by_path: Sequence[tuple[str, str, str]], order: str = "ord", site_suffix: str = "") -> DataFrame:
    """Other content-hub links as documents, one per address: typed by path, then training tracks, then resources.

    links: url, page, area, heading, label, via, ord; titles: url, title; by_path: (type, group path, group name) by the
    page path's ending, first wins. A link that none of these takes is dropped and doesn't use up its address.
    """
    hub = links.where(F.col("via") == "content_hub").join(titles.select(F.col("url").alias("page"), F.col("title").alias("page_title")), "page", "left")
    bare = F.regexp_replace(path(F.col("page")), "/+$", "")
    kind = "struct<type:string,entry:string,title:string>"
    label = F.coalesce(F.nullif(F.regexp_replace(F.col("label"), EMPTY_LABEL, ""), F.lit("")), F.col("heading"))
    label = F.when(F.col("label").rlike(MIB_LABEL), F.concat(F.lit("MIBs ("), F.split_part(F.col("label"), F.lit(" "), F.lit(1)), F.lit(")"))).otherwise(label)
    chain = None
    for doc_type, ending, name in by_path:
        made = F.struct(F.lit(doc_type).alias("type"), F.lit(name).alias("entry"), label.alias("title"))
        chain = F.when(bare.endswith(ending), made) if chain is None else chain.when(bare.endswith(ending), made)
    track = F.initcap(F.replace(F.regexp_extract(bare, "([^/]*)$", 1), F.lit("-"), F.lit(" ")))
    course = F.when(text_or_empty(F.col("heading")) != "", F.concat("heading", F.lit(" ("), "label", F.lit(")"))).otherwise(F.col("label"))
    training = F.struct(F.lit("Course Outline").alias("type"), track.alias("entry"), course.alias("title"))
    resource = F.replace(F.split_part(F.col("area"), F.lit("/"), F.lit(2)), F.lit("-"), F.lit(" "))
    group = F.concat(F.upper(F.substring(resource, 1, 1)), F.lower(F.substring(resource, F.lit(2), F.length(resource))), F.lit("s"))
    page_title = F.coalesce("page_title", "label")
    brief = F.struct(F.lit("Brief").alias("type"), group.alias("entry"), (F.replace(page_title, F.lit(site_suffix), F.lit("")) if site_suffix else page_title).alias("title"))
    rest = F.when(F.col("area") == "support/training", training).when(F.col("area").startswith("resources/"), brief).otherwise(F.lit(None).cast(kind))
    typed = hub.withColumn("_d", F.coalesce(chain, rest) if chain is not None else rest).where(F.col("_d").isNotNull())
    once = first_wins(typed.select("url", "_d", F.col(order).alias("ord")), ["url"], [F.col("ord")])
    return once.select(
        F.lit("main").alias("site"), F.lit("").alias("heading"), "_d.entry", "_d.title", F.lit("").alias("release"), F.lit(True).alias("is_latest"), F.lit("").alias("month"),
        F.lit("file").alias("format"), F.lit("content_hub").alias("via"), "_d.type", F.lit(False).alias("is_translation"), "url", F.array().cast("array<string>").alias("ents"), "ord",
    )


def scan_summary(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """metric, n: pages, failed, listings, documents and latest_documents of one scan."""
    p = pages.agg(F.count("*").alias("pages"), F.count_if(F.col("status") != 200).alias("failed"))
    d = listings.agg(F.count("*").alias("listings"), F.count_distinct("url").alias("documents"), F.count_distinct(F.when(F.col("latest") == "yes", F.col("url"))).alias("latest_documents"))
    return p.unpivot([], ["pages", "failed"], "metric", "n").unionByName(d.unpivot([], ["listings", "documents", "latest_documents"], "metric", "n"))
