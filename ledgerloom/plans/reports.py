"""Queries of aggregates, reports, compatibility and page furniture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import due_on
from ledgerloom.operators import catalog, compat, releases, reporting
from ledgerloom.operators.scan import snapshot_totals
from ledgerloom.plans.common import IS_LATEST_SQL, LABEL_SQL, LAST_NO, PREV_NO, PRODUCTS, RULES, TYPE_SQL, TYPES, is_latest, label, last_scans, scan_rows, snapshot_rows, snapshot_sql
from ledgerloom.plans import ledgers
from ledgerloom.plans.releases import docs
from ledgerloom.session import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_AREA = "CASE WHEN s[1] IN ('resources', 'support') AND s[2] IS NOT NULL THEN s[1] || '/' || s[2] ELSE coalesce(s[1], '') END"
_SEGMENTS = "list_filter(string_split(regexp_extract(regexp_replace(coalesce(page, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1), '/'), lambda x: x <> '')"


@query(
    f"""WITH l AS (SELECT *, row_id AS ord, {TYPE_SQL} AS type, {_SEGMENTS} AS s FROM listings),
p AS (SELECT page, min(row_id) AS ord, {_AREA} AS area FROM l GROUP BY page, s)
SELECT 'heading' AS section, heading AS name, count(*) AS n, min(ord) AS first_ord FROM l GROUP BY heading
UNION ALL SELECT 'format', CASE WHEN coalesce(via, '') IN ('', 'direct') THEN format ELSE format || ' via ' || via END, count(*), min(ord) FROM l GROUP BY 2
UNION ALL SELECT 'host', host, count(*), min(ord) FROM l GROUP BY host
UNION ALL SELECT 'type', type, count(*), min(ord) FROM l GROUP BY type
UNION ALL SELECT 'role', 'release', count(*), min(ord) FROM p
UNION ALL SELECT 'area', area, count(*), min(ord) FROM p GROUP BY area
UNION ALL SELECT 'check', status::varchar, count(*), min(scan_no) FROM snapshots GROUP BY status
UNION ALL SELECT 'total', 'datasheets', count(*), min(ord) FROM (SELECT split_part(url, '?', 1), min(row_id) AS ord FROM datasheets GROUP BY 1)
UNION ALL SELECT 'total', 'translations', count(*), min(ord) FROM l WHERE regexp_matches(lower(coalesce(title, '')), 'errata|deutsch|français')
UNION ALL SELECT 'total', 'quick references', count(*), min(ord) FROM l WHERE contains(lower(coalesce(title, '')), 'quick reference')"""
)
def q_catalog_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerloom.functions.urls import area_of

    listings = table(spark, sf_dir, "listings").withColumn("ord", F.col("row_id"))
    pages = listings.groupBy("page").agg(F.min("row_id").alias("ord")).select(F.lit("release").alias("role"), area_of(F.col("page")).alias("area"), "ord")
    sheets = table(spark, sf_dir, "datasheets").select("url", F.col("row_id").alias("ord"))
    health = table(spark, sf_dir, "snapshots").select(F.col("status").cast("string").alias("check"), F.col("scan_no").alias("ord"))
    return reporting.catalog_numbers(listings, pages, sheets, health, RULES)


@query("SELECT host AS name, n FROM (SELECT host, count(*) AS n, min(row_id) AS f FROM listings GROUP BY host ORDER BY n DESC, f LIMIT 8)")
def q_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.most_common(reporting.counted(table(spark, sf_dir, "listings"), "host", F.col("host"), "row_id"), 8).select("name", "n")


@query(f"SELECT entry, n FROM (SELECT entry, count(DISTINCT {LABEL_SQL}) AS n FROM listings GROUP BY entry ORDER BY n DESC, entry LIMIT 6)")
def q_top_menus(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "listings").groupBy("entry").agg(F.count_distinct(label()).alias("n"))
    return counts.orderBy(F.desc("n"), "entry").limit(6)


@query(
    f"SELECT entry, {', '.join(f'''count(CASE WHEN type = '{t}' THEN 1 END) AS "{t}"''' for t in TYPES)} FROM (SELECT entry, {TYPE_SQL} AS type FROM listings WHERE scan_no = {LAST_NO} QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1) GROUP BY entry"
)
def q_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.matrix(docs(spark, sf_dir), TYPES)


@query(
    f"SELECT entry, title, url, type FROM (SELECT entry, title, url, {TYPE_SQL} AS type, {LABEL_SQL} AS release FROM listings WHERE scan_no = {LAST_NO} QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1) WHERE contains(lower(coalesce(title, '')), 'series') AND contains(lower(coalesce(title, '')), 'guide') AND type IN ('User Guide', 'Security Guide')"
)
def q_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.search(docs(spark, sf_dir), "Series guide", type=["User Guide", "Security Guide"]).select("entry", "title", "url", "type")


_FAMILY = """CASE WHEN regexp_full_match(entry, 'LP[0-9]+[A-Za-z]*') THEN 'Access points' WHEN regexp_full_match(entry, '.+ [0-9]{4} Gen2') THEN 'Second generation'
  WHEN regexp_full_match(entry, '[A-Z][A-Za-z ]+ [0-9]{4}( Series)?') THEN 'Switches' WHEN regexp_full_match(entry, '.+ (Site Manager|Cloud Controller|Fabric Orchestrator)') THEN 'Management'
  WHEN regexp_full_match(entry, '.+ (Policy Engine|Guest Portal)') THEN 'Security' END"""


@query(
    f"""WITH d AS (SELECT entry, {_FAMILY} AS family FROM (SELECT * FROM listings WHERE scan_no = {LAST_NO} QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1))
SELECT CASE WHEN family IN ('Access points', 'Second generation', 'Switches') THEN 'Hardware' WHEN family IS NOT NULL THEN 'Software' END AS kind, family, count(*) AS documents, count(DISTINCT entry) AS entries FROM d GROUP BY ALL"""
)
def q_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.by_product(docs(spark, sf_dir), PRODUCTS)


@query(f"SELECT DISTINCT entry FROM entries WHERE {_FAMILY} IS NULL")
def q_unplaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reporting.unplaced(table(spark, sf_dir, "entries"), PRODUCTS)


@query(
    f"""WITH d AS (SELECT entry, url, {LABEL_SQL} AS release, {TYPE_SQL} AS type FROM listings WHERE scan_no = {LAST_NO} QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1),
k AS (SELECT DISTINCT entry, release, CASE WHEN regexp_extract(release, '^v?([0-9]+(?:[.][0-9]+)*)', 1) <> '' THEN list_transform(string_split(regexp_extract(release, '^v?([0-9]+(?:[.][0-9]+)*)', 1), '.'), lambda x: x::BIGINT) ELSE [-1::BIGINT] END AS k FROM d),
o AS (SELECT entry, release, row_number() OVER (PARTITION BY entry ORDER BY release = '', k DESC, release DESC) AS place FROM k)
SELECT d.entry, d.url, (o.place - 1)::INTEGER AS rel_no, list_position({TYPES!r}, d.type)::BIGINT - 1 AS type_no FROM d JOIN o USING (entry, release)"""
)
def q_release_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir)
    return reporting.release_places(rows, releases.in_release_order(rows.select("entry", "release")), TYPES).select("entry", "url", "rel_no", "type_no")


@query()
def q_explorer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).withColumn("month", F.lit("")).withColumn("via", F.lit("direct"))
    return reporting.explorer_rows(rows)


_KIND_OF_TITLE = "regexp_extract(coalesce(title, ''), '([A-Za-z]+ [A-Za-z]+)$', 1)"


@query(
    f"""WITH l AS (SELECT DISTINCT page, {_KIND_OF_TITLE} AS href FROM listings)
SELECT href, count(*) AS pages FROM l GROUP BY href HAVING count(*) >= greatest(8, 0.2 * (SELECT count(DISTINCT page) FROM listings))"""
)
def q_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "listings").select("page", F.regexp_extract(F.coalesce("title", F.lit("")), "([A-Za-z]+ [A-Za-z]+)$", 1).alias("href"))
    return catalog.furniture(links, links.agg(F.count_distinct("page")).head()[0])


@query(
    f"""WITH l AS (SELECT DISTINCT heading AS area, page, {_KIND_OF_TITLE} AS href FROM listings WHERE format <> 'html_guide'), z AS (SELECT heading AS area, count(DISTINCT page) AS size FROM listings GROUP BY heading HAVING count(DISTINCT page) >= 5)
SELECT l.area, href, count(*) AS pages FROM l JOIN z ON z.area = l.area GROUP BY l.area, href, size HAVING count(*) >= 0.6 * size"""
)
def q_area_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "listings")
    href = F.regexp_extract(F.coalesce("title", F.lit("")), "([A-Za-z]+ [A-Za-z]+)$", 1)
    links = rows.select(F.col("heading").alias("area"), "page", href.alias("href"), (~F.coalesce(F.col("format") != "html_guide", F.lit(False))).alias("is_hub"))
    return catalog.area_furniture(links, rows.select(F.col("heading").alias("area"), "page"))


_FIRST, _LAST = "Minimum Software Version", "Last Supported Software Version"


@query(
    f"""WITH c AS (SELECT table_name, trim(coalesce(json_extract_string(record, '$."{_FIRST}"'), '')) AS f, lower(trim(coalesce(json_extract_string(record, '$."{_LAST}"'), ''))) AS l FROM support_rows),
k AS (SELECT table_name, list_transform(string_split(regexp_extract(f, '^v?([0-9]+(?:[.][0-9]+)*)', 1), '.'), lambda x: x::BIGINT) AS v, starts_with(l, 'latest') AS latest,
  CASE WHEN regexp_extract(replace(l, '.x', '.999'), '^v?([0-9]+(?:[.][0-9]+)*)', 1) <> '' THEN list_transform(string_split(regexp_extract(replace(l, '.x', '.999'), '^v?([0-9]+(?:[.][0-9]+)*)', 1), '.'), lambda x: x::BIGINT) END AS e
  FROM c WHERE regexp_extract(f, '^v?([0-9]+(?:[.][0-9]+)*)', 1) <> ''),
g AS (SELECT table_name, min(v) AS lo, max(CASE WHEN NOT latest THEN e END) AS hi, bool_or(latest) AS is_open FROM k GROUP BY table_name)
SELECT table_name, array_to_string(lo, '.') AS min, CASE WHEN NOT is_open THEN replace(array_to_string(hi, '.'), '.999', '.x') END AS max, is_open FROM g WHERE is_open OR hi IS NOT NULL"""
)
def q_compat_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "support_rows").select(
        "table_name", F.get_json_object("record", f"$['{_FIRST}']").alias("first"), F.get_json_object("record", f"$['{_LAST}']").alias("last")
    )
    found = compat.ranges(bounds, ["table_name"])
    text = lambda c: F.array_join(F.transform(c, lambda p: p.cast("string")), ".")
    return found.select("table_name", text(F.col("lo")).alias("min"), F.when(~F.col("is_open"), F.replace(text(F.col("hi")), F.lit(".999"), F.lit(".x"))).alias("max"), "is_open")


def _recommended(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "recommendations")
    cell = lambda no, header, c: F.struct(F.lit(no).alias("col_no"), F.lit(header).alias("header"), F.col(c).alias("value"))
    cells = rows.select(F.col("site").alias("table_name"), F.col("row_id").alias("row_no"), F.explode(F.array(
        cell(0, "Platform", "platform"), cell(1, "Maintenance Release", "maintenance_release"), cell(2, "Latest Feature Release", "latest_feature_release"),
        cell(3, "Release Effective Date", "recommendation_effective_date"),
    )).alias("c")).select("table_name", "row_no", "c.*")
    platforms = {r[0]: r[0] for r in table(spark, sf_dir, "entries").select("entry").orderBy("entry").collect()}  # at most what the fixed product list holds, 466
    return compat.recommended_relations(cells, compat.RecommendedSource("recommendations", platforms, {"Fabric NOS": "Fabric NOS", "NQ-OS": "NQ-OS"}))


@query(
    """WITH r AS (SELECT site, row_id, entry AS platform, unnest([1, 2]) AS col_no, unnest([trim(maintenance_release), trim(latest_feature_release)]) AS v FROM recommendations JOIN entries ON lower(trim(platform)) = lower(entry)),
s AS (SELECT site, row_id, platform, col_no, CASE WHEN starts_with(v, 'Fabric NOS ') THEN 'Fabric NOS' WHEN starts_with(v, 'NQ-OS ') THEN 'NQ-OS' END AS software, CASE WHEN starts_with(v, 'Fabric NOS ') THEN trim(substr(v, 12)) ELSE trim(substr(v, 7)) END AS rest FROM r)
SELECT platform, software, string_agg(rest, ',' ORDER BY col_no) AS releases FROM s WHERE software IS NOT NULL GROUP BY site, row_id, platform, software"""
)
def q_compat_recommended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommended(spark, sf_dir)[0].select("platform", F.array_join("software", ",").alias("software"), F.array_join("releases", ",").alias("releases"))


@query("SELECT DISTINCT 'recommendations' AS source, trim(platform, ' ') AS name FROM recommendations WHERE trim(coalesce(platform, ''), ' ') <> '' AND lower(trim(platform, ' ')) NOT IN (SELECT lower(entry) FROM entries)")
def q_compat_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recommended(spark, sf_dir)[1]


_SAID = "regexp_extract('Current as of ' || coalesce(recommendation_effective_date, ''), '(?i)(?:current as of|as of|updated on|last updated:?)\\s+([A-Za-z]+\\.? \\d{1,2},? \\d{4}|\\d{1,2}[ -][A-Za-z]+[ -]\\d{4}|[A-Za-z]+ \\d{4}|\\d{4}-\\d{2}-\\d{2})', 1)"


@query(
    f"""WITH s AS (SELECT coalesce(platform, '') AS key, site, coalesce(maintenance_release, '') AS title, nullif({_SAID}, '') AS said FROM recommendations WHERE site IN ('docs-site', 'main-site')),
g AS (SELECT key, max(CASE WHEN site = 'docs-site' THEN title END) AS t1, max(CASE WHEN site = 'main-site' THEN title END) AS t2, max(CASE WHEN site = 'docs-site' THEN said END) AS d1, max(CASE WHEN site = 'main-site' THEN said END) AS d2 FROM s GROUP BY key)
SELECT key, coalesce(t1, t2) AS title, coalesce(d1, '–') AS first_date, coalesce(d2, '–') AS second_date FROM g"""
)
def q_recommendation_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("Current as of "), F.coalesce("recommendation_effective_date", F.lit("")))
    pages = table(spark, sf_dir, "recommendations").where(F.col("site").isin("docs-site", "main-site")).select(F.coalesce("platform", F.lit("")).alias("key"), "site", F.coalesce("maintenance_release", F.lit("")).alias("title"), said.alias("text"))
    return reporting.recommendation_dates(pages)


@query("SELECT site, max(scan_date) AS scanned, (max(scan_date)::DATE + 30)::VARCHAR AS due FROM snapshots GROUP BY site")
def q_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "snapshots").groupBy("site").agg(F.max("scan_date").alias("scanned"))
    return last.select("site", "scanned", due_on(F.col("scanned"), 30).cast("string").alias("due"))


_STEPS = """SELECT entry AS step, count(*) AS pages, (epoch_us(max(loaded_at)) - epoch_us(min(loaded_at))) / 1e6 AS seconds FROM listings
WHERE scan_no = {0} AND strftime(loaded_at, '%Y-%m-%d') = scan_date GROUP BY entry"""


@query(
    f"""WITH n AS ({_STEPS.format(LAST_NO)}), p AS ({_STEPS.format(PREV_NO)})
SELECT n.step, n.pages / n.seconds AS rate, p.pages / p.seconds AS before FROM n JOIN p ON p.step = n.step WHERE n.seconds > 0 AND p.seconds > 0 AND n.pages / n.seconds < 0.5 * (p.pages / p.seconds)"""
)
def q_slow_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries loaded at less than half the last scan's rate, by the times recorded on the scan's own day."""
    previous, latest = last_scans(spark, sf_dir)
    at = F.unix_micros(F.col("loaded_at").cast("timestamp")) / 1e6
    on_time = table(spark, sf_dir, "listings").where(F.date_format("loaded_at", "yyyy-MM-dd") == F.col("scan_date"))
    steps = lambda n: on_time.where(F.col("scan_no") == n).groupBy(F.col("entry").alias("step")).agg(F.count("*").alias("pages"), (F.max(at) - F.min(at)).alias("seconds"))
    return reporting.slow_steps(steps(latest[0]), steps(previous[0]))


def _check_sql() -> str:
    """Every check's names from the SQL of the query that finds them."""
    label = f"entry || ': ' || {LABEL_SQL}"
    parts = {
        "recommendation pages changed": f"SELECT name FROM ({ledgers.SQL['q_snapshot_changes']}) WHERE contains(name, 'recommend')",
        "other snapshots changed": f"SELECT name FROM ({ledgers.SQL['q_snapshot_changes']}) WHERE NOT coalesce(contains(name, 'recommend'), false)",
        "new latest documents": f"SELECT d.entry AS name FROM (WITH {ledgers.DIFF_SQL} SELECT d.change, b.entry, coalesce(regexp_matches(lower(b.latest), '^\\s*(yes|y|true)\\s*$'), false) AS l FROM d JOIN b ON b.url = d.url AND b.page = d.page) d WHERE change = 'new' AND l",
        "rows no longer listed": f"SELECT url AS name FROM ({ledgers.SQL['q_catalog_diff']}) WHERE change = 'no_longer_listed'",
        "datasheets changed": f"SELECT page AS name FROM ({SQL['q_lost_datasheets']})",
        "health changed": f"SELECT site || ' ' || status AS name FROM ({ledgers.SQL['q_health_delta']})",
        "new entries": "SELECT DISTINCT name FROM (SELECT entry AS name, min(first_seen) AS f, max(max(last_seen)) OVER () AS today, min(min(first_seen)) OVER () AS begun FROM listings WHERE entry <> '' AND first_seen <> '' GROUP BY entry) WHERE f = today AND today <> begun",
        "profiles name unknown entries": "SELECT DISTINCT entry AS name FROM entries WHERE entry NOT IN (SELECT entry FROM listings WHERE entry <> '' AND first_seen <> '')",
        "unread labels": f"SELECT {label} AS name FROM (SELECT DISTINCT entry, release FROM listings) WHERE {LABEL_SQL} <> '' AND NOT regexp_matches({LABEL_SQL}, '^v?[0-9]') AND NOT regexp_matches({LABEL_SQL}, '(?i)latest')",
        "slow steps": f"SELECT step AS name FROM ({SQL['q_slow_steps']})",
        "unmapped names": f"SELECT name FROM ({SQL['q_compat_unmapped']})",
        "unplaced products": f"SELECT entry AS name FROM ({SQL['q_unplaced']})",
    }
    each = [
        f"""SELECT '{check}' AS "check", count(*) AS n, array_to_string((list(DISTINCT name ORDER BY name))[1:{reporting.CHECKS[check]}], ', ') AS sample FROM ({sql}) HAVING count(*) > 0"""
        for check, sql in parts.items()
    ]
    return "\nUNION ALL ".join(each)


def q_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to look at after the last scan. Profiles name the whole product list."""
    listings, entries = table(spark, sf_dir, "listings"), table(spark, sf_dir, "entries")
    _, latest = last_scans(spark, sf_dir)
    now = scan_rows(spark, sf_dir, latest[0]).select("url", "page", F.col("entry").alias("name"), is_latest().alias("latest"))
    changed = ledgers.listing_changes(spark, sf_dir)
    new = changed.where("change = 'new'").select("change", "url", "page").join(now, ["url", "page"]).select("change", "name", "latest")
    gone = changed.where("change = 'no_longer_listed'").select("change", F.col("url").alias("name"), F.lit(False).alias("latest"))
    sheets = q_lost_datasheets(spark, sf_dir).select(F.lit("new").alias("change"), F.col("page").alias("name"), F.lit(False).alias("latest"))
    pages = listings.where("entry <> '' AND first_seen <> ''").groupBy("entry").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    labels = listings.select("entry", "release").distinct().select("entry", label().alias("label"), F.lit("release").alias("role"))
    return reporting.scan_checks(
        {"listings": new.unionByName(gone), "datasheets": sheets},
        ledgers.q_snapshot_changes(spark, sf_dir),
        ledgers.q_health_delta(spark, sf_dir).select(F.concat_ws(" ", "site", F.col("status").cast("string")).alias("name")),
        pages,
        entries,
        catalog.unread_labels(labels, "latest").select(F.concat_ws(": ", "entry", "label").alias("name")),
        q_slow_steps(spark, sf_dir).select(F.col("step").alias("name")),
        q_compat_unmapped(spark, sf_dir),
        q_unplaced(spark, sf_dir).select(F.col("entry").alias("name")),
    )


@query(
    f"""WITH b AS (SELECT DISTINCT url FROM listings WHERE scan_no = {PREV_NO}), n AS (SELECT entry, title, url FROM listings WHERE scan_no = {LAST_NO} AND {IS_LATEST_SQL} AND url NOT IN (SELECT url FROM b))
SELECT DISTINCT entry, title FROM n ORDER BY entry, title LIMIT 25"""
)
def q_new_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    rows = table(spark, sf_dir, "listings")
    new = rows.where((F.col("scan_no") == latest[0]) & is_latest()).join(rows.where(F.col("scan_no") == previous[0]).select("url"), "url", "left_anti")
    return new.select("entry", "title").distinct().orderBy("entry", "title").limit(25)


@query(
    f"""WITH had AS (SELECT DISTINCT page FROM listings WHERE scan_no = {PREV_NO} AND format = 'pdf'), has AS (SELECT DISTINCT page FROM listings WHERE scan_no = {LAST_NO} AND format = 'pdf' AND last_seen = scan_date), f AS (SELECT DISTINCT page FROM listings WHERE scan_no = {LAST_NO})
SELECT page FROM had WHERE page NOT IN (SELECT page FROM has) AND page IN (SELECT page FROM f)"""
)
def q_lost_datasheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    rows = table(spark, sf_dir, "listings")
    now = rows.where(F.col("scan_no") == latest[0])
    had = rows.where((F.col("scan_no") == previous[0]) & (F.col("format") == "pdf"))
    return catalog.lost_datasheets(had, now.where((F.col("format") == "pdf") & (F.col("last_seen") == F.col("scan_date"))), now)


@query(
    """WITH u AS (SELECT DISTINCT rtrim(url, '/') AS url, list_filter(string_split(regexp_extract(regexp_replace(rtrim(url, '/'), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1), '/'), lambda x: x <> '') AS s FROM snapshots)
SELECT url, regexp_matches(regexp_extract(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1), '^/(kestrion.+|velmark-policies$)') AS is_snapshot FROM u WHERE starts_with(s[1], 'k') OR s[1] IN ('velmark-policies')"""
)
def q_page_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "snapshots").select("url")
    first = F.get(F.filter(F.split(F.regexp_replace("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "/"), lambda x: x != ""), F.lit(0))
    areas = sorted({r[0] for r in pages.where(first.startswith("k")).select(first).distinct().collect()} | {"velmark-policies"})
    found = catalog.page_targets(pages, areas, [])
    stem = F.col("url").rlike("://[^/]+/(kestrion.+|velmark-policies$)")
    return found.select("url", (catalog.snapshot_page(F.col("url"), ["/velmark-policies"]) | stem).alias("is_snapshot"))


@query("SELECT coalesce(doc_type, '') AS doc_type, count(*) AS n, sum(n_chars)::BIGINT AS chars, max(n_chars) AS longest FROM documents GROUP BY 1")
def q_document_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").groupBy(F.coalesce("doc_type", F.lit("")).alias("doc_type"))
    return rows.agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("longest"))


@query(f"WITH {snapshot_sql('s', LAST_NO)} SELECT site, count(*) AS pages, sum(tables)::BIGINT AS tables, sum(\"rows\")::BIGINT AS \"rows\" FROM s GROUP BY site")
def q_snapshot_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    return snapshot_totals(snapshot_rows(spark, sf_dir, latest[0]))


@query(f"SELECT DISTINCT url FROM listings WHERE scan_no = {LAST_NO} AND url NOT IN (SELECT url FROM listings WHERE scan_no = {PREV_NO})")
def q_unread_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    at = lambda n: table(spark, sf_dir, "listings").where(F.col("scan_no") == n).select("url")
    return catalog.unread_options(at(latest[0]), at(previous[0]))


QUERIES["q_to_check"], SQL["q_to_check"] = q_to_check, _check_sql()


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
