"""Queries of the ledger operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.versions import listed, version_key
from ledgerloom.operators import ledger
from ledgerloom.operators.catalog import documents, scan_summary
from ledgerloom.plans.common import IS_LATEST_SQL, KEY_SQL, LABEL_SQL, LAST_DAY, LAST_NO, PREV_DAY, PREV_NO, is_latest, label, last_scans, scan_rows, scan_sql, snapshot_rows, snapshot_sql
from ledgerloom.session import table

SHOWN = ["format", "latest", "month", "release", "title"]
QUERIES, SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("SELECT row_id, url, page, last_seen FROM listings WHERE last_seen = (SELECT max(last_seen) FROM listings)")
def q_current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.current(table(spark, sf_dir, "listings")).select("row_id", "url", "page", "last_seen")


@query("SELECT row_id, scan_no FROM listings WHERE first_seen <= '2025-04-16' AND last_seen >= '2025-04-16'")
def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.as_of(table(spark, sf_dir, "listings"), "2025-04-16").select("row_id", "scan_no")


@query("SELECT url, page, title, row_id FROM listings QUALIFY row_number() OVER (PARTITION BY url, page ORDER BY row_id) = 1")
def q_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.first_wins(table(spark, sf_dir, "listings").select("url", "page", "title", "row_id"), ["url", "page"], [F.col("row_id")])


@query(
    f"""WITH new_ AS (SELECT * FROM listings WHERE scan_no = {LAST_NO} AND last_seen = scan_date QUALIFY row_number() OVER (PARTITION BY url, page ORDER BY row_id) = 1),
old_ AS (SELECT * FROM listings WHERE scan_no = {PREV_NO} QUALIFY row_number() OVER (PARTITION BY url, page ORDER BY row_id DESC) = 1)
SELECT coalesce(n.url, o.url) AS url, coalesce(n.page, o.page) AS page, CASE WHEN n.url IS NOT NULL THEN n.title ELSE o.title END AS title,
  CASE WHEN n.url IS NOT NULL THEN n.release ELSE o.release END AS release,
  CASE WHEN n.url IS NOT NULL THEN coalesce(nullif(o.first_seen, ''), {LAST_DAY}) ELSE o.first_seen END AS first_seen,
  CASE WHEN n.url IS NOT NULL THEN {LAST_DAY} ELSE o.last_seen END AS last_seen
FROM new_ n FULL JOIN old_ o ON n.url = o.url AND n.page = o.page"""
)
def q_ledger_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    rows = table(spark, sf_dir, "listings")
    cols = ["url", "page", "title", "release", "first_seen", "last_seen"]
    old = ledger.last_wins(rows.where(F.col("scan_no") == previous[0]).select(*cols, "row_id"), ["url", "page"], [F.col("row_id")]).select(*cols)
    new = rows.where((F.col("scan_no") == latest[0]) & (F.col("last_seen") == F.col("scan_date")))
    return ledger.merge_ledger(old, new, ["url", "page"], latest[1], [F.col("row_id")])


def listing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    before, after = (scan_rows(spark, sf_dir, n).select("url", "page", "last_seen", *SHOWN) for n in (previous[0], latest[0]))
    return ledger.catalog_changes(before, after, ["url", "page"], SHOWN, previous[1], latest[1])


DIFF_SQL = f"""{scan_sql('a', PREV_NO)}, {scan_sql('b', LAST_NO)},
d AS (SELECT coalesce(b.url, a.url) AS url, coalesce(b.page, a.page) AS page,
  CASE WHEN a.url IS NULL THEN 'new' WHEN a.last_seen = {PREV_DAY} AND (b.url IS NULL OR b.last_seen <> {LAST_DAY}) THEN 'no_longer_listed'
       WHEN a.url IS NOT NULL AND b.url IS NOT NULL AND ({' OR '.join(f"coalesce(a.{c}, '') <> coalesce(b.{c}, '')" for c in SHOWN)}) THEN 'changed' END AS change,
  CASE WHEN a.url IS NOT NULL AND b.url IS NOT NULL THEN concat_ws(',', {', '.join(f"CASE WHEN coalesce(a.{c}, '') <> coalesce(b.{c}, '') THEN '{c}' END" for c in SHOWN)}) ELSE '' END AS fields
  FROM a FULL JOIN b ON a.url = b.url AND a.page = b.page)"""


@query(f"WITH {DIFF_SQL} SELECT change, url, page, fields FROM d WHERE change IS NOT NULL")
def q_catalog_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_changes(spark, sf_dir).select("change", "url", "page", F.array_join(F.array_sort(F.map_keys("changed")), ",").alias("fields"))


@query(
    f"""WITH {DIFF_SQL}, {snapshot_sql('sa', PREV_NO)}, {snapshot_sql('sb', LAST_NO)}
SELECT 'listings' AS ledger, change, count(*) AS n FROM d WHERE change IS NOT NULL GROUP BY change
UNION ALL SELECT 'snapshots', CASE WHEN sa.name IS NULL THEN 'new' WHEN sb.name IS NULL THEN 'gone' ELSE 'changed' END AS change, count(*)
FROM sa FULL JOIN sb ON sa.site = sb.site AND sa.name = sb.name WHERE sa.name IS NULL OR sb.name IS NULL OR sa.body <> sb.body GROUP BY 2"""
)
def q_change_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    pages = ledger.key_changes(snapshot_rows(spark, sf_dir, previous[0]), snapshot_rows(spark, sf_dir, latest[0]), ["site", "name"], "body")
    both = listing_changes(spark, sf_dir).select(F.lit("listings").alias("ledger"), "change").unionByName(pages.select(F.lit("snapshots").alias("ledger"), "change"))
    return ledger.change_summary(both)


@query(
    f"""WITH {snapshot_sql('a', PREV_NO)}, {snapshot_sql('b', LAST_NO)}
SELECT coalesce(a.site, b.site) AS site, coalesce(a.name, b.name) AS name, CASE WHEN a.name IS NULL THEN 'new' WHEN b.name IS NULL THEN 'gone' ELSE 'changed' END AS change
FROM a FULL JOIN b ON a.site = b.site AND a.name = b.name WHERE a.name IS NULL OR b.name IS NULL OR a.body <> b.body"""
)
def q_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    return ledger.key_changes(snapshot_rows(spark, sf_dir, previous[0]), snapshot_rows(spark, sf_dir, latest[0]), ["site", "name"], "body")


@query(
    f"""WITH a AS (SELECT site, status, count(*) AS n FROM snapshots WHERE scan_no = {PREV_NO} GROUP BY ALL), b AS (SELECT site, status, count(*) AS n FROM snapshots WHERE scan_no = {LAST_NO} GROUP BY ALL)
SELECT coalesce(a.site, b.site) AS site, coalesce(a.status, b.status) AS status, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after
FROM a FULL JOIN b ON a.site = b.site AND a.status = b.status WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)"""
)
def q_health_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    counts = table(spark, sf_dir, "snapshots").groupBy("scan_no", "site", "status").agg(F.count("*").alias("n"))
    before, after = (counts.where(F.col("scan_no") == n).drop("scan_no") for n in (previous[0], latest[0]))
    return ledger.count_delta(before, after, ["site", "status"])


@query(
    """WITH c AS (SELECT scan_no, count(*) AS now_, count_if(status <> 200)::BIGINT AS failed FROM snapshots GROUP BY scan_no)
SELECT c.scan_no, c.now_ AS now, p.now_ AS before, c.failed, CASE WHEN c.now_ < 0.9 * p.now_ THEN 'shrunk' WHEN c.failed > 0.02 * c.now_ THEN 'failed' ELSE '' END AS verdict
FROM c LEFT JOIN c p ON p.scan_no = c.scan_no - 1"""
)
def q_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "snapshots").groupBy("scan_no").agg(F.count("*").alias("now"), F.count_if(F.col("status") != 200).alias("failed"))
    before = counts.select((F.col("scan_no") + 1).alias("scan_no"), F.col("now").alias("before"))
    both = counts.join(before, "scan_no", "left")
    return both.select("scan_no", "now", "before", "failed", ledger.guard_verdict(F.col("now"), F.col("before"), F.col("failed")).alias("verdict"))


@query(
    f"""WITH r AS (SELECT entry, url, row_id, title, {IS_LATEST_SQL} AS l, coalesce({KEY_SQL.format(LABEL_SQL)}, [-1::BIGINT]) AS k FROM listings),
g AS (SELECT entry, url, list({{'o': row_id, 'l': l, 'k': k, 'p': title}} ORDER BY row_id) AS v FROM r GROUP BY entry, url),
b AS (SELECT entry, url, list_reduce(v, lambda a, b: CASE WHEN (b.l AND NOT a.l) OR b.k > a.k THEN b ELSE a END) AS x FROM g)
SELECT entry, url, x.o AS row_id, x.p AS title FROM b"""
)
def q_fold_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "listings").select("entry", "url", "row_id", "title", is_latest().alias("is_latest"), listed(version_key(label())).alias("key"))
    return ledger.fold_best(rows, ["entry", "url"], "row_id", "is_latest", "key", "title")


@query(
    f"""WITH v AS (SELECT url, title, format, via, host, 0 AS v, row_id AS ord FROM listings WHERE scan_no = {LAST_NO}
  UNION ALL SELECT url, label, 'file', 'content_hub', regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), 1, row_id FROM datasheets),
once AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY url ORDER BY v, ord) = 1),
n AS (SELECT url, min(release) AS r FROM listings WHERE scan_no = {LAST_NO} GROUP BY url), o AS (SELECT url, min(release) AS r, min(month) AS m FROM listings WHERE scan_no = {PREV_NO} GROUP BY url),
nm AS (SELECT url, min(month) AS m FROM listings WHERE scan_no = {LAST_NO} GROUP BY url)
SELECT once.url, title, format, via, host, CASE WHEN coalesce(n.r, '') <> '' THEN n.r ELSE coalesce(o.r, '') END AS redirect,
  CASE WHEN coalesce(n.r, '') <> '' THEN coalesce(nm.m, '') ELSE coalesce(o.m, '') END AS revision
FROM once LEFT JOIN n ON n.url = once.url LEFT JOIN o ON o.url = once.url LEFT JOIN nm ON nm.url = once.url"""
)
def q_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    rows, sheets = table(spark, sf_dir, "listings"), table(spark, sf_dir, "datasheets")
    now = rows.where(F.col("scan_no") == latest[0])
    sheets = sheets.select("url", F.col("label").alias("title"), F.lit("file").alias("format"), F.lit("content_hub").alias("via"), F.regexp_extract(F.lower("url"), "^[a-z]+://([^/?#]*)", 1).alias("host"), F.col("row_id").alias("ord"))
    known = lambda df: df.groupBy("url").agg(F.min("release").alias("redirect"), F.min("month").alias("revision"))
    return documents([now.withColumn("ord", F.col("row_id")), sheets], known(rows.where(F.col("scan_no") == previous[0])), known(now))


@query(
    f"""SELECT unnest(['pages', 'failed']) AS metric, unnest([count(*), count_if(status <> 200)::BIGINT]) AS n FROM snapshots WHERE scan_no = {LAST_NO}
UNION ALL SELECT unnest(['listings', 'documents', 'latest_documents']), unnest([count(*), count(DISTINCT url), count(DISTINCT CASE WHEN latest = 'yes' THEN url END)]) FROM listings WHERE scan_no = {LAST_NO}"""
)
def q_scan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    at = lambda name: table(spark, sf_dir, name).where(F.col("scan_no") == latest[0])
    return scan_summary(at("snapshots"), at("listings"))


@query("SELECT page, min(first_seen) AS first_seen, max(last_seen) AS last_seen, count(*) AS n FROM listings WHERE first_seen <> '' GROUP BY page")
def q_seen_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "listings").where(F.col("first_seen") != "")
    return rows.groupBy("page").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.count("*").alias("n"))


@query(
    """WITH a AS (SELECT DISTINCT trim(platform) AS name FROM recommendations WHERE platform IS NOT NULL), b AS (SELECT DISTINCT entry AS name FROM entries), c AS (SELECT DISTINCT trim(product) AS name FROM datasheets WHERE product IS NOT NULL)
SELECT 'intersect' AS op, name FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'except', name FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
UNION ALL SELECT 'union', name FROM (SELECT * FROM a UNION SELECT * FROM c)
UNION ALL SELECT 'semi', name FROM b WHERE name IN (SELECT name FROM c)
UNION ALL SELECT 'anti', name FROM b WHERE name NOT IN (SELECT name FROM c)"""
)
def q_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lambda name, c: table(spark, sf_dir, name).where(F.col(c).isNotNull()).select(F.trim(c).alias("name")).distinct()
    a, b, c = named("recommendations", "platform"), named("entries", "entry"), named("datasheets", "product")
    parts = {"intersect": a.intersect(b), "except": b.exceptAll(a), "union": a.union(c).distinct(), "semi": b.join(c, "name", "left_semi"), "anti": b.join(c, "name", "left_anti")}
    union = None
    for op, df in parts.items():
        row = df.select(F.lit(op).alias("op"), "name")
        union = row if union is None else union.unionByName(row)
    return union


@query(
    """SELECT row_id, page, last_value(nullif(release, '') IGNORE NULLS) OVER (PARTITION BY page ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM listings"""
)
def q_fill_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "listings").select("row_id", "page", "release")
    return ledger.fill_forward(rows, F.nullif(F.col("release"), F.lit("")), ["page"], "row_id", "filled").select("row_id", "page", "filled")


@query("SELECT name, site, title, status FROM snapshots WHERE site <> 'main-site' OR site IS NULL UNION ALL SELECT name, site, upper(title), status FROM snapshots WHERE site = 'main-site'")
def q_replace_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "snapshots").select("name", "site", "title", "status")
    renewed = pages.where("site = 'main-site'").withColumn("title", F.upper("title"))
    return ledger.replace_partition(pages, renewed, "site", "main-site")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
