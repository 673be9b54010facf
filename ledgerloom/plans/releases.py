"""Queries of release rules, profiles and the document tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.versions import line, major
from ledgerloom.operators import catalog, profiles, releases
from ledgerloom.operators.ledger import first_wins
from ledgerloom.plans.common import IS_LATEST_SQL, KEY_SQL, LABEL_SQL, LAST_NO, RULES, TYPE_SQL, is_latest, label, last_scans
from ledgerloom.session import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry, release, pos: every release label of every entry, in order of first listing."""
    return table(spark, sf_dir, "listings").groupBy("entry", label().alias("release")).agg(F.min("row_id").alias("pos"))


_LABELS = f"""labels AS (SELECT entry, {LABEL_SQL} AS release, min(row_id) AS pos FROM listings GROUP BY ALL),
n AS (SELECT *, {KEY_SQL.format('release')} AS k FROM labels), num AS (SELECT *, list_resize(k, 8, 0) AS pk, [k[1], coalesce(k[2], 0)] AS ln FROM n WHERE k IS NOT NULL)"""


def _best(group: str, down: bool) -> str:
    return f"SELECT entry, release FROM num QUALIFY row_number() OVER (PARTITION BY entry, {group} ORDER BY pk {'DESC' if down else 'ASC'}, pos) = 1"


_NEWEST = "SELECT entry, release FROM num QUALIFY dense_rank() OVER (PARTITION BY entry ORDER BY ln DESC) <= 2"
_RANGE = "SELECT entry, release FROM num WHERE list_resize(k[1:1], 8, 0) >= [3, 0, 0, 0, 0, 0, 0, 0] AND list_resize(k[1:2], 8, 0) <= [8, 4, 0, 0, 0, 0, 0, 0]"


@query(f"WITH {_LABELS} {_best('k[1]', True)}")
def q_latest_per_major(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.best_per(labels(spark, sf_dir), "entry", "release", major, "pos", True)


@query(f"WITH {_LABELS} {_best('ln', True)}")
def q_latest_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.best_per(labels(spark, sf_dir), "entry", "release", line, "pos", True)


@query(f"WITH {_LABELS} {_best('ln', False)}")
def q_first_per_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.best_per(labels(spark, sf_dir), "entry", "release", line, "pos", False)


@query(f"WITH {_LABELS} {_NEWEST}")
def q_newest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.newest_lines(labels(spark, sf_dir), "entry", "release", 2)


@query(f"WITH {_LABELS} {_RANGE}")
def q_release_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels(spark, sf_dir)
    return rows.where(releases.in_range(F.col("release"), "3", "8.4")).select("entry", "release")


@query(f"WITH {_LABELS} {_best('k[1]', True)} UNION {_NEWEST} UNION {_RANGE} UNION SELECT entry, release FROM labels WHERE release IN ('9.9', '2.0')")
def q_release_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = ["latest-per-major", {"newest": 2}, {"from": "3", "to": "8.4"}, "9.9", "2.0"]
    return releases.release_set(labels(spark, sf_dir), releases.release_rules(written))


@query(f"WITH {_LABELS} SELECT entry, release, row_number() OVER (PARTITION BY entry ORDER BY release = '', coalesce(k, [-1::BIGINT]) DESC, release DESC)::INTEGER AS place FROM n")
def q_release_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.in_release_order(labels(spark, sf_dir))


@query(
    f"""WITH {_LABELS}, l AS (SELECT *, regexp_extract(release, '^v?([0-9]+\\.[0-9]+)', 1) AS line FROM labels WHERE regexp_matches(release, '^v?[0-9]+\\.[0-9]+')), f AS (SELECT entry, arg_min(line, pos) AS line FROM l GROUP BY entry)
SELECT entry, release AS label, pos FROM l SEMI JOIN f USING (entry, line)"""
)
def q_latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return releases.latest_line(labels(spark, sf_dir).withColumnRenamed("release", "label").select("entry", "label", "pos"))


@query(
    f"""WITH o AS (SELECT entry, {LABEL_SQL} AS label, page, min(row_id) AS pos FROM listings GROUP BY ALL), p AS (SELECT page, entry, min(label) AS label, min(page) OVER (PARTITION BY entry) AS entry_page FROM o GROUP BY page, entry),
l AS (SELECT *, regexp_extract(label, '^v?([0-9]+\\.[0-9]+)', 1) AS line FROM o WHERE regexp_matches(label, '^v?[0-9]+\\.[0-9]+')), f AS (SELECT entry, arg_min(line, pos) AS newest FROM l GROUP BY entry),
on_ AS (SELECT DISTINCT l.entry, l.page FROM l JOIN f ON f.entry = l.entry AND f.newest = l.line)
SELECT p.page, p.entry, CASE WHEN p.page = p.entry_page THEN 'entry' ELSE 'release' END AS role,
  on_.page IS NOT NULL OR (p.page = p.entry_page AND (f.newest IS NULL OR contains(lower(p.label), 'latest'))) AS is_latest
FROM p LEFT JOIN f ON f.entry = p.entry LEFT JOIN on_ ON on_.entry = p.entry AND on_.page = p.page"""
)
def q_latest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = table(spark, sf_dir, "listings").groupBy("entry", label().alias("label"), "page").agg(F.min("row_id").alias("pos"))
    pages = options.groupBy("page", "entry").agg(F.min("label").alias("label"))
    first = options.groupBy("entry").agg(F.min("page").alias("entry_page"))
    marked = catalog.latest_mark(options, pages.join(first, "entry"))
    return marked.select("page", "entry", catalog.role_of(F.col("entry"), F.col("page"), F.col("entry_page")).alias("role"), "is_latest")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the last scan, each once, with type and release, for profiles."""
    _, latest = last_scans(spark, sf_dir)
    rows = table(spark, sf_dir, "listings").where(F.col("scan_no") == latest[0])
    once = first_wins(rows.select("url", "entry", "title", "release", "latest", "format", "row_id"), ["url"], [F.col("row_id")])
    return once.select(
        "url", "entry", "title", "format", label().alias("release"), is_latest().alias("is_latest"), RULES.document_type(F.col("title"), F.col("format")).alias("type"),
        RULES.is_translation(F.col("title")).alias("is_translation"), F.array().cast("array<string>").alias("ents"), "row_id", F.col("row_id").alias("pos"),
    )


_DOCS = f"""docs AS (SELECT url, entry, title, format, {LABEL_SQL} AS release, {IS_LATEST_SQL} AS is_latest, {TYPE_SQL} AS type, regexp_matches(lower(coalesce(title, '')), 'errata|deutsch|français') AS tr, row_id
  FROM (SELECT * FROM listings WHERE scan_no = {LAST_NO} QUALIFY row_number() OVER (PARTITION BY url ORDER BY row_id) = 1)),
dl AS (SELECT entry, release, min(row_id) AS pos, {KEY_SQL.format('release')} AS k FROM docs GROUP BY entry, release),
lpm AS (SELECT entry, release FROM dl WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entry, k[1] ORDER BY list_resize(k, 8, 0) DESC, pos) = 1),
rng AS (SELECT entry, release FROM dl WHERE k IS NOT NULL AND list_resize(k[1:1], 8, 0) >= [5, 0, 0, 0, 0, 0, 0, 0]),
m AS (SELECT docs.*, CASE WHEN type = 'Release Notes' AND NOT tr AND (is_latest OR lpm.release IS NOT NULL) THEN 0 WHEN format = 'zip' AND is_latest AND NOT tr THEN 1
   WHEN type IN ('User Guide', 'Security Guide') AND rng.release IS NOT NULL THEN 2 END AS filter
  FROM docs LEFT JOIN lpm ON lpm.entry = docs.entry AND lpm.release = docs.release LEFT JOIN rng ON rng.entry = docs.entry AND rng.release = docs.release)"""

PROFILE = profiles.load_profile(
    {
        "use": ["notes"],
        "filters": [{"format": "zip"}, {"types": ["User Guide", "Security Guide"], "releases": [{"from": "5"}], "translations": True, "into": "guides/{type}/{release}"}],
        "folders": "{profile}/{entry}",
    },
    {"notes": {"filters": [{"types": "Release Notes", "releases": ["latest", "latest-per-major"]}]}},
)


@query(f"WITH {_DOCS} SELECT url, filter FROM m")
def q_profile_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.matched(docs(spark, sf_dir), PROFILE).select("url", "filter")


def _safe(c: str) -> str:
    return f"coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace(regexp_replace({c}, '[\\\\/:*?\"<>|\\x00-\\x1f]', ' ', 'g'), '[\\s\\p{{Z}}\\x{{85}}]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g'), 120), '^[ .]+|[ .]+$', '', 'g'), ''), 'untitled')"


_PLAN = f"""{_DOCS}, f AS (SELECT *, CASE WHEN filter = 2 THEN 'guides/' || {_safe('type')} || '/' || CASE WHEN release = '' THEN '' ELSE {_safe('release')} END
   ELSE CASE WHEN filter = 0 THEN 'notes' ELSE '' END || '/' || {_safe('entry')} END AS raw,
   {_safe("regexp_replace(coalesce(nullif(title, ''), regexp_extract(url, '([^/]*)$', 1)), '(?i)\\.(?:pdf|zip|xlsx?|csv|html?|gz)$', '')")} AS base FROM m WHERE filter IS NOT NULL),
plan AS (SELECT url, entry, type, release, filter, concat_ws('/', nullif(regexp_replace(regexp_replace(raw, '/+', '/', 'g'), '^/|/$', '', 'g'), ''), base) AS path FROM f)"""


@query(f"WITH {_PLAN} SELECT * FROM plan"
)
def q_file_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.plan_files(docs(spark, sf_dir), PROFILE, ["row_id"]).select("url", "entry", "type", "release", "filter", "path")


@query(f"WITH {_PLAN} SELECT path, count(*) AS n, min(url) AS first_url FROM plan GROUP BY path HAVING count(*) > 1")
def q_path_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.path_collisions(profiles.plan_files(docs(spark, sf_dir), PROFILE, ["row_id"]))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    rows = table(spark, sf_dir, "listings").where(F.col("scan_no") == latest[0]).withColumn("latest", F.when(is_latest(), "yes").otherwise("")).withColumn("release", label()).withColumn("ord", F.col("row_id"))
    sheets = table(spark, sf_dir, "datasheets").where("product IS NOT NULL").select("product", "url", F.col("row_id").alias("ord"))
    entries = table(spark, sf_dir, "entries").select("entry")
    return catalog.entry_documents(rows, RULES).unionByName(catalog.datasheet_documents(sheets, entries, {"Thermal probe bundle": ["LP651W", "nowhere"], "Spare fan tray": ["Norvane 2830"]}))


@query(
    f"""WITH l AS (SELECT entry, url, list({{'o': row_id, 'l': {IS_LATEST_SQL}, 'k': coalesce({KEY_SQL.format(LABEL_SQL)}, [-1::BIGINT]), 't': title, 'r': {LABEL_SQL}, 'y': {TYPE_SQL}}} ORDER BY row_id) AS v FROM listings WHERE scan_no = {LAST_NO} GROUP BY entry, url),
b AS (SELECT entry, url, list_reduce(v, lambda a, b: CASE WHEN (b.l AND NOT a.l) OR b.k > a.k THEN b ELSE a END) AS x FROM l),
s AS (SELECT product, url, row_id FROM datasheets WHERE product IS NOT NULL QUALIFY row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY row_id, product, url) = 1)
SELECT 'docs' AS site, entry, x.t AS title, x.r AS release, x.l AS is_latest, x.y AS type, url, '' AS ents FROM b
UNION ALL SELECT 'main', product, product || ' Data Sheet', '', true, 'Datasheet', url,
  CASE WHEN product IN (SELECT entry FROM entries) THEN product WHEN product = 'Thermal probe bundle' THEN 'LP651W' WHEN product = 'Spare fan tray' THEN 'Norvane 2830' ELSE '' END FROM s"""
)
def q_document_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree(spark, sf_dir).select("site", "entry", "title", "release", "is_latest", "type", "url", F.array_join("ents", ",").alias("ents"))


@query(
    """WITH e AS (SELECT page AS url, heading, entry, row_id AS ord, CASE WHEN scan_no = 1 THEN 0 ELSE 1 END AS p FROM listings)
SELECT url, heading, entry FROM e QUALIFY row_number() OVER (PARTITION BY url ORDER BY p, ord) = 1"""
)
def q_page_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "listings").select(F.col("page").alias("url"), "heading", "entry", F.col("row_id").alias("ord"), "scan_no")
    return catalog.page_owners(rows.where("scan_no = 1").drop("scan_no"), rows.where("scan_no <> 1").drop("scan_no"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
