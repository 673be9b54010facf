"""What several query modules share: rows of one scan, sample rules, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.rules import ProductRules, TypeRules
from ledgerloom.operators.history import scan_calendar
from ledgerloom.operators.ledger import first_wins
from ledgerloom.session import table

#: Numbers and days of the last two scans delivered, in SQL.
LAST_NO = "(SELECT max(scan_no) FROM snapshots)"
PREV_NO = f"(SELECT max(scan_no) FROM snapshots WHERE scan_no < {LAST_NO})"
LAST_DAY, PREV_DAY = (f"(SELECT max(scan_date) FROM snapshots WHERE scan_no = {no})" for no in (LAST_NO, PREV_NO))

RULES = TypeRules(
    by_format={"video": "Video", "api": "API Reference"},
    by_title=[
        ("Release Notes", "release notes|migration notes"),
        ("Installation Guide", "install|getting started|quick reference"),
        ("Security Guide", "security|regulatory"),
        ("User Guide", "user guide|configuration|deployment|upgrade"),
        ("Reference", "reference|matrix"),
    ],
    values={"Release Notes": "high", "Installation Guide": "high", "User Guide": "medium", "Security Guide": "medium", "Reference": "low", "Other": "low"},
    translation="errata|deutsch|français",
    quick_reference="quick reference",
)
TYPES = ["Video", "API Reference", "Collection", "Release Notes", "Installation Guide", "Security Guide", "User Guide", "Reference", "Other"]
PRODUCTS = ProductRules(
    [
        ("Hardware", "Access points", r"LP[0-9]+[A-Za-z]*"),
        ("Hardware", "Second generation", r".+ [0-9]{4} Gen2"),
        ("Hardware", "Switches", r"[A-Z][A-Za-z ]+ [0-9]{4}( Series)?"),
        ("Software", "Management", r".+ (Site Manager|Cloud Controller|Fabric Orchestrator)"),
        ("Software", "Security", r".+ (Policy Engine|Guest Portal)"),
    ]
)

TYPE_SQL = """CASE WHEN format = 'video' THEN 'Video' WHEN format = 'api' THEN 'API Reference'
  WHEN contains(lower(coalesce(title, '')), 'document collection') THEN 'Collection'
  WHEN regexp_matches(lower(coalesce(title, '')), 'release notes|migration notes') THEN 'Release Notes'
  WHEN regexp_matches(lower(coalesce(title, '')), 'install|getting started|quick reference') THEN 'Installation Guide'
  WHEN regexp_matches(lower(coalesce(title, '')), 'security|regulatory') THEN 'Security Guide'
  WHEN regexp_matches(lower(coalesce(title, '')), 'user guide|configuration|deployment|upgrade') THEN 'User Guide'
  WHEN regexp_matches(lower(coalesce(title, '')), 'reference|matrix') THEN 'Reference' ELSE 'Other' END"""

LABEL_SQL = "regexp_replace(coalesce(release, ''), '^Version ', '')"
KEY_SQL = "CASE WHEN regexp_extract({0}, '^v?([0-9]+(?:[.][0-9]+)*)', 1) <> '' THEN list_transform(string_split(regexp_extract({0}, '^v?([0-9]+(?:[.][0-9]+)*)', 1), '.'), lambda x: x::BIGINT) END"
IS_LATEST_SQL = "coalesce(regexp_matches(lower(latest), '^\\s*(yes|y|true)\\s*$'), false)"


def label(release: str = "release"):  # noqa: ANN201
    return F.regexp_replace(F.coalesce(F.col(release), F.lit("")), "^Version ", "")


def is_latest():  # noqa: ANN201
    return F.coalesce(F.col("latest").rlike(r"(?i)^\s*(yes|y|true)\s*$"), F.lit(False))


def last_scans(spark: SparkSession, sf_dir: str) -> tuple[tuple[int, str], tuple[int, str]]:
    """Number and day of the last scan but one and of the last one, from the small index of snapshot pages."""
    calendar = scan_calendar(table(spark, sf_dir, "snapshots"))
    return (calendar[-2] if len(calendar) > 1 else calendar[-1]), calendar[-1]


def scan_rows(spark: SparkSession, sf_dir: str, scan: int, key: tuple[str, ...] = ("url", "page")) -> DataFrame:
    """The rows of one scan, the first of each key."""
    rows = table(spark, sf_dir, "listings").where(F.col("scan_no") == scan)
    return first_wins(rows, list(key), [F.col("row_id")])


def scan_sql(name: str, scan: str, key: str = "url, page") -> str:
    return f"{name} AS (SELECT * FROM listings WHERE scan_no = {scan} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY row_id) = 1)"


def snapshot_rows(spark: SparkSession, sf_dir: str, scan: int) -> DataFrame:
    rows = table(spark, sf_dir, "snapshots").where(F.col("scan_no") == scan)
    rows = rows.withColumn("body", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("title", "status", "tables", "rows")]))
    return first_wins(rows.select("site", "name", "title", "status", "tables", "rows", "body"), ["site", "name"], [F.col("body")])


def snapshot_sql(name: str, scan: str) -> str:
    body = "concat_ws('|', coalesce(title, ''), coalesce(status::varchar, ''), coalesce(tables::varchar, ''), coalesce(\"rows\"::varchar, ''))"
    return f"{name} AS (SELECT *, {body} AS body FROM snapshots WHERE scan_no = {scan} QUALIFY row_number() OVER (PARTITION BY site, name ORDER BY {body}) = 1)"
