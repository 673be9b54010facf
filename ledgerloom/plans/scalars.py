"""Queries of the scalar functions and rule chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import cards, dates, hashing, links, rules, text, urls, versions
from ledgerloom.plans.common import KEY_SQL, PRODUCTS, RULES, TYPE_SQL
from ledgerloom.session import table

QUERIES, SQL = {}, {}
HOSTS = {"own_hosts": ["nordquill.example"], "portal_hosts": ["docs.nordquill.example"], "hub_hosts": ["hub.nordquill"]}
PREFIXES = {"Fabric NOS": "Fabric NOS", "NQ-OS": "NQ-OS", "Fabric": "Fabric"}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_BARE = "regexp_replace(coalesce(title, ''), '[\\x{200B}-\\x{200D}\\x{FEFF}\\x{2122}\\x{00AE}]', '', 'g')"
_CLEAN = f"trim(regexp_replace({_BARE}, '[\\s\\p{{Z}}\\x{{85}}]+', ' ', 'g'), ' ')"
_DASHED = "regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', '-', 'g')"
_SAFE = "regexp_replace(regexp_replace(regexp_replace(coalesce(title, ''), '[\\\\/:*?\"<>|\\x00-\\x1f]', ' ', 'g'), '[\\s\\p{Z}\\x{85}]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g')"


@query(
    f"""SELECT row_id, {_CLEAN} AS cleaned,
  coalesce(nullif(regexp_replace(left(regexp_replace({_DASHED}, '^-+|-+$', '', 'g'), 80), '^-+|-+$', '', 'g'), ''), 'untitled') AS slug,
  coalesce(nullif(regexp_replace(left({_SAFE}, 120), '^[ .]+|[ .]+$', '', 'g'), ''), 'untitled') AS safe,
  replace(coalesce(title, ''), '|', '\\|') AS barred
FROM listings"""
)
def q_text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("title")
    return table(spark, sf_dir, "listings").select("row_id", text.clean(c).alias("cleaned"), text.slug(c).alias("slug"), text.safe_name(c).alias("safe"), text.escape_bars(c).alias("barred"))


@query(
    """WITH b AS (SELECT row_id, page, coalesce(url, '') AS u, rtrim(regexp_replace(coalesce(url, ''), '#.*$', '', 's'), '/') AS bare FROM listings),
p AS (SELECT *, lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host, regexp_extract(regexp_replace(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1) AS path,
  list_filter(string_split(regexp_extract(regexp_replace(coalesce(page, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1), '/'), lambda s: s <> '') AS segments FROM b)
SELECT row_id, lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*')) || substr(bare, length(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*')) + 1) AS key,
  CASE WHEN u = '' THEN u ELSE rtrim(split_part(u, '#', 1), '/') || '/' END AS canonical, host, path, regexp_extract(rtrim(path, '/'), '([^/]*)$', 1) AS last,
  regexp_extract(lower(path), '[^/](\\.[a-z0-9]{1,5})$', 1) AS ext,
  CASE WHEN segments[1] IN ('resources', 'support') AND segments[2] IS NOT NULL THEN segments[1] || '/' || segments[2] ELSE coalesce(segments[1], '') END AS area
FROM p"""
)
def q_url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "listings").select(
        "row_id", urls.listing_key(u).alias("key"), urls.canonical(u).alias("canonical"), urls.host(u).alias("host"), urls.path(u).alias("path"),
        urls.last_segment(u).alias("last"), urls.extension(u).alias("ext"), urls.area_of(F.col("page")).alias("area"),
    )


@query(
    """WITH p AS (SELECT row_id, coalesce(title, '') AS t, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host,
  lower(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1)) AS path FROM listings),
k AS (SELECT *, regexp_extract(path, '[^/](\\.[a-z0-9]{1,5})$', 1) AS ext FROM p),
m AS (SELECT row_id, CASE WHEN contains(host, 'youtu') OR contains(host, 'vimeo') THEN 'video' WHEN contains(host, 'hub.nordquill') THEN 'hub' WHEN ext = '.pdf' THEN 'pdf'
  WHEN ext IN ('.zip', '.tar', '.gz', '.tgz') THEN 'archive' WHEN ext IN ('.xlsx', '.xls', '.csv') THEN 'sheet'
  WHEN starts_with(host, 'developer.') OR contains(path, 'api') OR regexp_matches(t, '\\bAPI\\b') THEN 'api'
  WHEN host = 'docs.nordquill.example' THEN CASE WHEN ext IN ('', '.html', '.htm', '.shtml') THEN 'portal' ELSE 'other' END
  WHEN contains(host, 'nordquill.example') THEN 'page' ELSE 'external' END AS kind FROM k)
SELECT row_id, kind, CASE kind WHEN 'pdf' THEN 'pdf' WHEN 'portal' THEN 'pdf' WHEN 'archive' THEN 'zip' WHEN 'sheet' THEN 'xlsx' WHEN 'api' THEN 'api' WHEN 'video' THEN 'video' WHEN 'hub' THEN 'file' WHEN 'other' THEN 'other' ELSE 'page' END AS format,
  CASE kind WHEN 'portal' THEN 'html_guide' WHEN 'hub' THEN 'content_hub' ELSE 'direct' END AS via FROM m"""
)
def q_link_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "listings").select("row_id", links.link_kind(F.col("url"), F.col("title"), **HOSTS).alias("kind"))
    return kinds.select("row_id", "kind", links.format_via(F.col("kind")).alias("fv")).select("row_id", "kind", "fv.format", "fv.via")


@query(
    """SELECT row_id, CASE WHEN list_contains(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], lower(m)) THEN y || '-' || lpad(list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], lower(m))::varchar, 2, '0') ELSE '' END AS month_iso
FROM (SELECT row_id, regexp_extract(coalesce(date, ''), '([A-Za-z]{3})[a-z]*\\.? (\\d{4})', 1) AS m, regexp_extract(coalesce(date, ''), '([A-Za-z]{3})[a-z]*\\.? (\\d{4})', 2) AS y FROM listings)"""
)
def q_month_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "listings").select("row_id", dates.month_iso(F.col("date")).alias("month_iso"))


@query(
    f"""WITH v AS (SELECT row_id, {KEY_SQL.format("coalesce(min_fw_version, '')")} AS k FROM ap_firmware)
SELECT row_id, array_to_string(k, '.') AS key, array_to_string(list_resize(k, 8, 0), '.') AS padded, k[1] AS major, array_to_string([k[1], coalesce(k[2], 0)], '.') AS line FROM v WHERE k IS NOT NULL
UNION ALL SELECT row_id, NULL, NULL, NULL, NULL FROM v WHERE k IS NULL"""
)
def q_version_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = versions.version_key(F.col("min_fw_version"))
    shown = lambda c: F.when(c.isNotNull(), F.array_join(F.transform(c, lambda x: x.cast("string")), "."))
    return table(spark, sf_dir, "ap_firmware").select("row_id", shown(key).alias("key"), shown(versions.padded(key)).alias("padded"), versions.major(key).alias("major"), shown(versions.line(key)).alias("line"))


@query(
    f"""WITH v AS (SELECT row_id, {KEY_SQL.format("regexp_replace(coalesce(maintenance_release, ''), '^[A-Za-z -]+ ', '')")} AS a, {KEY_SQL.format("regexp_replace(coalesce(latest_feature_release, ''), '^[A-Za-z -]+ ', '')")} AS b FROM recommendations)
SELECT row_id, CASE WHEN list_resize(a, 8, 0) < list_resize(b, 8, 0) THEN -1 WHEN list_resize(a, 8, 0) > list_resize(b, 8, 0) THEN 1 WHEN a IS NOT NULL AND b IS NOT NULL THEN 0 END AS padded_order,
  coalesce(a, [-1::BIGINT]) < coalesce(b, [-1::BIGINT]) AS lists_before, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN list_resize(a[1:len(b)], 8, 0) <= list_resize(b, 8, 0) END AS up_to FROM v"""
)
def q_version_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (versions.version_key(F.regexp_replace(c, "^[A-Za-z -]+ ", "")) for c in ("maintenance_release", "latest_feature_release"))
    return table(spark, sf_dir, "recommendations").select(
        "row_id", versions.compare(a, b).alias("padded_order"), (versions.listed(a) < versions.listed(b)).alias("lists_before"),
        F.when(a.isNotNull() & b.isNotNull(), versions.cut_to(a, b) <= versions.padded(b)).alias("up_to"),
    )


@query(
    """SELECT doc_id, CASE WHEN coalesce(text, '') <> '' THEN sha256(text) END AS text_sha256,
  sha1(regexp_replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), '^<!-- Generated by[^\\n]*\\n?', '')) AS page_hash, sha1(source) AS cache_key FROM documents"""
)
def q_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", hashing.text_sha256(c).alias("text_sha256"), hashing.page_hash(c).alias("page_hash"), hashing.cache_key(F.col("source")).alias("cache_key"))


def _mentions(text: str) -> str:
    """SQL of the first versions a text names: what stands after v, version or release, or has three or more parts."""
    found = [f"regexp_extract_all({text}, '{cards.VERSION}', {i})" for i in (1, 2)]
    joined = f"list_transform(list_zip({found[0]}, {found[1]}), lambda p: coalesce(p[1], '') || coalesce(p[2], ''))"
    return f"array_to_string(list_filter({joined}, lambda x, i: list_position({joined}, x) = i)[1:8], ' ')"


def _word_count(text: str) -> str:
    blank = "[\\s\\p{Z}\\x{85}]+"
    return f"(CASE WHEN regexp_replace({text}, '{blank}', '', 'g') = '' THEN 0 ELSE len(regexp_split_to_array(regexp_replace({text}, '^{blank}|{blank}$', '', 'g'), '{blank}')) END)::INTEGER"


_FIELDS = ", ".join(f"nullif(regexp_extract(h, '{pattern}', 1), '') AS {name}" for name, pattern in (("part_number", cards.PART_NUMBER), ("revision", cards.REVISION), ("published", cards.PUBLISHED)))
_PAGE = "Page [0-9]+ of [0-9]+"


@query(
    f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS h FROM documents)
SELECT doc_id, {_word_count('h')} AS words, {_FIELDS}, {_mentions('h')} AS versions, CASE WHEN h <> '' THEN sha256(h) END AS text_sha256 FROM d"""
)
def q_text_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    card = table(spark, sf_dir, "documents").select("doc_id", cards.text_card(F.col("text")).alias("c"))
    return card.select("doc_id", "c.words", "c.part_number", "c.revision", "c.published", F.array_join("c.versions", " ").alias("versions"), "c.text_sha256")


@query(
    f"""WITH p AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_split_to_array(text, '{_PAGE}') END AS p FROM documents),
d AS (SELECT doc_id, len(p)::INTEGER AS pages, coalesce(array_to_string(p, chr(10)), '') AS w, coalesce(array_to_string(p[1:4], chr(10)), '') AS h FROM p)
SELECT doc_id, pages, {_word_count('w')} AS words, {_FIELDS}, {_mentions('h')} AS versions FROM d"""
)
def q_page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of texts that come page by page: pages end at their running foot."""
    card = table(spark, sf_dir, "documents").select("doc_id", cards.page_card(F.split("text", _PAGE)).alias("c"))
    return card.select("doc_id", "c.pages", "c.words", "c.part_number", "c.revision", "c.published", F.array_join("c.versions", " ").alias("versions"))


@query(
    f"""SELECT row_id, {TYPE_SQL} AS type, regexp_matches(lower(coalesce(title, '')), 'errata|deutsch|français') AS is_translation, contains(lower(coalesce(title, '')), 'quick reference') AS is_quick,
  CASE {TYPE_SQL} WHEN 'Release Notes' THEN 'high' WHEN 'Installation Guide' THEN 'high' WHEN 'User Guide' THEN 'medium' WHEN 'Security Guide' THEN 'medium' WHEN 'Reference' THEN 'low' WHEN 'Other' THEN 'low' END AS value FROM listings"""
)
def q_document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = table(spark, sf_dir, "listings").select("row_id", "title", RULES.document_type(F.col("title"), F.col("format")).alias("type"))
    return typed.select("row_id", "type", RULES.is_translation(F.col("title")).alias("is_translation"), RULES.is_quick_reference(F.col("title")).alias("is_quick"), RULES.value_class(F.col("type")).alias("value"))


@query(
    """SELECT entry_id, CASE WHEN family IN ('Access points', 'Second generation', 'Switches') THEN 'Hardware' WHEN family IS NOT NULL THEN 'Software' END AS kind, family FROM (
SELECT entry_id, CASE WHEN regexp_full_match(entry, 'LP[0-9]+[A-Za-z]*') THEN 'Access points' WHEN regexp_full_match(entry, '.+ [0-9]{4} Gen2') THEN 'Second generation'
  WHEN regexp_full_match(entry, '[A-Z][A-Za-z ]+ [0-9]{4}( Series)?') THEN 'Switches' WHEN regexp_full_match(entry, '.+ (Site Manager|Cloud Controller|Fabric Orchestrator)') THEN 'Management'
  WHEN regexp_full_match(entry, '.+ (Policy Engine|Guest Portal)') THEN 'Security' END AS family FROM entries)"""
)
def q_product_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "entries").select("entry_id", PRODUCTS.place(F.col("entry")).alias("p"))
    return placed.select("entry_id", "p.kind", "p.family")


@query(
    """SELECT row_id, CASE WHEN starts_with(r, 'Fabric NOS ') THEN 'Fabric NOS' WHEN starts_with(r, 'Fabric ') THEN 'Fabric' WHEN starts_with(r, 'NQ-OS ') THEN 'NQ-OS' END AS software,
  CASE WHEN starts_with(r, 'Fabric NOS ') THEN trim(substr(r, 12)) WHEN starts_with(r, 'Fabric ') THEN trim(substr(r, 8)) WHEN starts_with(r, 'NQ-OS ') THEN trim(substr(r, 7)) END AS release
FROM (SELECT row_id, trim(coalesce(maintenance_release, '')) AS r FROM recommendations)"""
)
def q_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "recommendations").select("row_id", rules.longest_prefix(F.col("maintenance_release"), PREFIXES).alias("s"))
    return said.select("row_id", F.col("s.name").alias("software"), F.col("s.rest").alias("release"))


@query(
    """WITH r AS (SELECT regexp_extract(rtrim(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1), '/'), '([^/]*)$', 1) AS f, host FROM listings)
SELECT host, coalesce(nullif(lower(regexp_extract(f, '[^/](\\.[^./]+)$', 1)), ''), '(none)') AS ext, count(*) AS n FROM r GROUP BY ALL"""
)
def q_extension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.coalesce(F.nullif(F.lower(F.regexp_extract(urls.last_segment(F.col("url")), r"[^/](\.[^./]+)$", 1)), F.lit("")), F.lit("(none)"))
    return table(spark, sf_dir, "listings").groupBy("host", ext.alias("ext")).agg(F.count("*").alias("n"))


@query(
    """SELECT row_id, nullif(regexp_extract('Updated on ' || coalesce(recommendation_effective_date, ''), '(?i)(?:current as of|as of|updated on|last updated:?)\\s+([A-Za-z]+\\.? \\d{1,2},? \\d{4}|\\d{1,2}[ -][A-Za-z]+[ -]\\d{4}|[A-Za-z]+ \\d{4}|\\d{4}-\\d{2}-\\d{2})', 1), '') AS stated,
  format('{:,}', row_id) AS shown FROM recommendations"""
)
def q_stated_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("Updated on "), F.coalesce(F.col("recommendation_effective_date"), F.lit("")))
    return table(spark, sf_dir, "recommendations").select("row_id", dates.stated_date(said).alias("stated"), text.thousands(F.col("row_id")).alias("shown"))


@query()
def q_joined_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.split_part("links", F.lit(" "), F.lit(1))
    sheets = table(spark, sf_dir, "recommendations").select("row_id", first.alias("link"))
    return sheets.select("row_id", links.join_url(F.lit("https://docs.nordquill.example/entry/"), F.col("link")).alias("absolute"), links.quote_url(F.col("link")).alias("quoted"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
