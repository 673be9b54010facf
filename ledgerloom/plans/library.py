"""Queries of the library operators; listings of the last two scans stand for lock and observation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import slug
from ledgerloom.operators import library
from ledgerloom.plans.common import LAST_DAY, LAST_NO, PREV_NO, last_scans, scan_rows, scan_sql, snapshot_rows, snapshot_sql

QUERIES, SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def register(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(
    f"""WITH {snapshot_sql('a', PREV_NO)}, {snapshot_sql('b', LAST_NO)}
SELECT coalesce(a.name, b.name) AS path, CASE WHEN a.name IS NULL THEN 'new' WHEN b.name IS NULL THEN 'missing' WHEN a.body = b.body THEN 'ok' ELSE 'changed' END AS verdict FROM a FULL JOIN b ON a.name = b.name AND a.site = b.site"""
)
def q_lock_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    held = lambda n: snapshot_rows(spark, sf_dir, n).select(F.col("name").alias("path"), F.sha2(F.col("body"), 256).alias("sha256"))
    return library.check_files(held(previous[0]), held(latest[0]))


def _lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, _ = last_scans(spark, sf_dir)
    rows = scan_rows(spark, sf_dir, previous[0], ("url",))
    none = F.array().cast("array<struct<sha256:string,bytes:bigint,last_modified:string,fetched:string>>")
    return rows.select(
        "url", slug(F.col("title")).alias("path"), F.sha2(F.coalesce("title", F.lit("")), 256).alias("sha256"), F.length(F.coalesce("title", F.lit(""))).cast("bigint").alias("bytes"), F.col("title"),
        F.coalesce("month", F.lit("")).alias("etag"), F.coalesce("date", F.lit("")).alias("last_modified"), F.col("last_seen").alias("fetched"), none.alias("earlier"),
    )


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    rows = scan_rows(spark, sf_dir, latest[0], ("url",))
    return rows.select(
        "url", F.when(F.col("via") == "portal", 404).otherwise(200).alias("head_status"), F.coalesce("month", F.lit("")).alias("etag"), F.coalesce("date", F.lit("")).alias("last_modified"),
        F.length(F.coalesce("title", F.lit(""))).cast("bigint").alias("content_length"), F.when(F.col("format") == "zip", 503).otherwise(200).alias("status"),
        F.sha2(F.coalesce("title", F.lit("")), 256).alias("sha256"), (F.col("release") != "").alias("on_disk"), F.length(F.coalesce("title", F.lit(""))).cast("bigint").alias("bytes"), "title",
    )


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    return scan_rows(spark, sf_dir, latest[0], ("url",)).where(F.col("last_seen") == latest[1]).select("url", slug(F.col("title")).alias("path"))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.sync_decisions(_plan(spark, sf_dir), _lock(spark, sf_dir), _seen(spark, sf_dir))


_SAME_HEAD = "coalesce(o.via, '') <> 'portal' AND ((coalesce(k.month, '') <> '' AND coalesce(o.month, '') = coalesce(k.month, '')) OR (coalesce(k.date, '') <> '' AND coalesce(o.date, '') = coalesce(k.date, '') AND length(coalesce(o.title, '')) = length(coalesce(k.title, ''))))"
_SLUG = "coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace(lower(coalesce({0}.title, '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), '^-+|-+$', '', 'g'), ''), 'untitled')"
_DECISIONS = f"""{scan_sql('k', PREV_NO, 'url')}, {scan_sql('o', LAST_NO, 'url')},
d AS (SELECT o.url, {_SLUG.format('k')} AS kp, {_SLUG.format('o')} AS op, k.url IS NOT NULL AS locked,
  CASE WHEN k.url IS NOT NULL AND coalesce(o.release <> '', false) AND ({_SAME_HEAD}) THEN 'same' WHEN o.format = 'zip' THEN 'failed'
    WHEN k.url IS NOT NULL AND coalesce(o.release <> '', false) AND coalesce(o.title, '') = coalesce(k.title, '') THEN 'same' WHEN k.url IS NOT NULL THEN 'updated' ELSE 'new' END AS decision
  FROM o LEFT JOIN k ON k.url = o.url WHERE o.last_seen = {LAST_DAY}),
decided AS (SELECT url, CASE WHEN locked THEN kp ELSE op END AS path, decision FROM d
UNION ALL SELECT k.url, {_SLUG.format('k')}, 'dropped' FROM k WHERE k.url NOT IN (SELECT url FROM d))"""


@query(f"WITH {_DECISIONS} SELECT url, path, decision FROM decided")
def q_sync_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir)


@query(f"WITH {_DECISIONS} SELECT decision, count(*) AS n FROM decided GROUP BY decision")
def q_sync_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.tally(_decisions(spark, sf_dir))


@query(
    f"""WITH {_DECISIONS} SELECT d.url, d.path, sha256(CASE WHEN d.decision IN ('new', 'updated') THEN coalesce(o.title, '') ELSE coalesce(k.title, '') END) AS sha256,
  CASE WHEN d.decision IN ('new', 'updated') THEN {LAST_DAY} ELSE k.last_seen END AS fetched, CASE WHEN d.decision = 'updated' THEN 1 ELSE 0 END AS earlier, CASE WHEN d.decision = 'updated' THEN sha256(coalesce(k.title, '')) END AS before
FROM decided d LEFT JOIN k ON k.url = d.url LEFT JOIN o ON o.url = d.url WHERE d.decision <> 'dropped' AND (d.decision IN ('new', 'updated') OR k.url IS NOT NULL)"""
)
def q_next_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    lock = library.next_lock(_lock(spark, sf_dir), _decisions(spark, sf_dir), _seen(spark, sf_dir), latest[1])
    return lock.select("url", "path", "sha256", "fetched", F.size("earlier").alias("earlier"), F.get(F.col("earlier"), F.lit(0))["sha256"].alias("before"))


@query(
    f"""WITH {scan_sql('k', PREV_NO, 'url')}, {scan_sql('o', LAST_NO, 'url')}
SELECT k.url, CASE WHEN o.url IS NULL OR coalesce(o.via, '') = 'portal' THEN 'unreachable' WHEN {_SAME_HEAD} THEN 'ok' ELSE 'upstream' END AS verdict FROM k LEFT JOIN o ON o.url = k.url"""
)
def q_remote_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.remote_verdicts(_lock(spark, sf_dir), _seen(spark, sf_dir))


@query(
    f"""WITH {_DECISIONS} SELECT path, decision AS what, {LAST_DAY} AS day FROM decided WHERE decision <> 'same'"""
)
def q_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, latest = last_scans(spark, sf_dir)
    return library.history_entry(_decisions(spark, sf_dir), latest[1]).select("path", "what", "day")


@query(
    f"""WITH {snapshot_sql('a', PREV_NO)}, {snapshot_sql('b', LAST_NO)} SELECT b.name AS path FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.name = b.name AND a.body = b.body)"""
)
def q_stale_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, latest = last_scans(spark, sf_dir)
    held = lambda n: snapshot_rows(spark, sf_dir, n).select(F.col("name").alias("path"), F.sha2(F.col("body"), 256).alias("sha256"))
    return library.stale_details(held(latest[0]), held(previous[0])).select("path")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
