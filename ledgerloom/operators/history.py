"""Full history of entity attributes from periodic snapshots, by tree reduction over unit intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty
from ledgerloom.functions.urls import listing_key

YES = r"(?i)^\s*(yes|y|true)\s*$"


def scan_calendar(df: DataFrame, scan: str = "scan_no", date: str = "scan_date") -> list[tuple[int, str]]:
    """The scans delivered, in order, with their dates. One row per scan reaches the driver, however large the table."""
    found = df.where(F.col(scan).isNotNull()).groupBy(scan).agg(F.max(date).alias("_date"))
    return sorted((r[0], r[1] or "") for r in found.collect())


def rank_of_scan(scan: Column, calendar: list[tuple[int, str]]) -> Column:
    """Position of the scan in the calendar from 0; NULL for a scan that is not in it."""
    if not calendar:
        return F.lit(None).cast("int")
    pairs = [x for i, (no, _) in enumerate(calendar) for x in (F.lit(no), F.lit(i))]
    return F.try_element_at(F.create_map(*pairs), scan)


def date_of_rank(rank: Column, calendar: list[tuple[int, str]]) -> Column:
    return F.get(F.array(*[F.lit(d) for _, d in calendar]), rank) if calendar else F.lit(None).cast("string")


def _joined(left: Column, right: Column) -> Column:
    """Two neighbouring lists of runs as one; the runs that meet are one run if they touch and carry the same payload."""
    a, b = F.element_at(left, -1), F.get(right, F.lit(0))
    seam = F.struct(a["lo"].alias("lo"), b["hi"].alias("hi"), a["payload"].alias("payload"), a["opened"].alias("opened"))
    met = F.concat(F.slice(left, F.lit(1), F.size(left) - 1), F.array(seam), F.slice(right, F.lit(2), F.size(right)))
    return (
        F.when(right.isNull(), left)
        .when((a["hi"] + 1 == b["lo"]) & a["payload"].eqNullSafe(b["payload"]), met)
        .otherwise(F.concat(left, right))
    )


def coalesce_history(units: DataFrame, entity: list[str], rank: str, payload: Column, opened: Column, n_ranks: int) -> DataFrame:
    """Longest runs of consecutive ranks with an equal payload, per entity.

    units: at most one row per entity and rank (a unit interval). Result: entity columns, lo, hi (ranks), payload and
    opened (of the run's first unit). Neighbouring lists of runs are merged pairwise, ceil(log2(n_ranks)) rounds.
    An entity never has more units than there are ranks, so what one task gathers does not grow with the table.
    Payloads may be NULL (equal to each other); entities without units have no rows; an empty input gives no rows.
    """
    unit = F.struct(F.col(rank).alias("lo"), F.col(rank).alias("hi"), payload.alias("payload"), opened.alias("opened"))
    runs = units.groupBy(*entity).agg(F.array_sort(F.collect_list(unit)).alias("_units"))
    runs = runs.select(*entity, F.transform("_units", lambda u: F.array(u)).alias("_runs"))
    for _ in range(max(0, math.ceil(math.log2(max(1, n_ranks))))):
        here = F.col("_runs")
        halves = F.sequence(F.lit(0), F.floor((F.size(here) + 1) / 2).cast("int") - 1)
        runs = runs.select(*entity, F.transform(halves, lambda i: _joined(F.get(here, 2 * i), F.get(here, 2 * i + 1))).alias("_runs"))
    return runs.select(*entity, F.explode(F.get("_runs", F.lit(0))).alias("_run")).select(*entity, "_run.*")


def last_loaded(df: DataFrame, key: list[str], fields: dict[str, Column], loaded: list[Column]) -> DataFrame:
    """One row per key: the one loaded last, ties by the later columns of `loaded`, then by the fields' own values.

    The maximum of a struct is taken on the map side first, so a key that holds a third of all rows is shrunk before
    the shuffle. NULL load times count as earliest.
    """
    order = [c.alias(f"_o{i}") for i, c in enumerate(loaded)]
    top = F.max(F.struct(*order, *[c.alias(n) for n, c in fields.items()])).alias("_top")
    return df.groupBy(*key).agg(top).select(*key, *[F.col("_top")[n].alias(n) for n in fields])


def listing_versions(listings: DataFrame, calendar: list[tuple[int, str]] | None = None) -> DataFrame:
    """History of each listing's `latest` mark: url, page, latest, valid_from, valid_to.

    Rows without a scan number are in no scan and are left out. NULL urls and pages count as ''. A scan lists a key if
    the row loaded last there has last_seen equal to scan_date. `latest` is yes for yes, y, true in any case, else no.
    valid_from of a run that begins in the first scan is that row's first_seen, if filled; valid_to is '' while open.
    Extra columns are ignored whatever their names; an empty table gives no rows.
    """
    calendar = scan_calendar(listings) if calendar is None else calendar
    rows = listings.select(
        listing_key(F.col("url")).alias("url"),
        text_or_empty(F.col("page")).alias("page"),
        rank_of_scan(F.col("scan_no"), calendar).alias("rank"),
        F.col("loaded_at"),
        F.coalesce(F.col("last_seen") == F.col("scan_date"), F.lit(False)).alias("listed"),
        F.coalesce(F.col("latest").rlike(YES), F.lit(False)).alias("is_latest"),
        F.when(F.col("scan_no") == (calendar[0][0] if calendar else None), F.trim("first_seen")).alias("first_seen"),
        F.col("row_id"),
    ).where(F.col("rank").isNotNull())
    units = last_loaded(
        rows, ["url", "page", "rank"], {n: F.col(n) for n in ("listed", "is_latest", "first_seen")}, [F.col("loaded_at"), F.col("row_id")]
    ).where("listed")
    runs = coalesce_history(units, ["url", "page"], "rank", F.col("is_latest"), F.nullif(F.col("first_seen"), F.lit("")), len(calendar))
    return runs.select(
        "url",
        "page",
        F.when(F.col("payload"), "yes").otherwise("no").alias("latest"),
        F.coalesce(F.when(F.col("lo") == 0, F.col("opened")), date_of_rank(F.col("lo"), calendar)).alias("valid_from"),
        F.when(F.col("hi") == len(calendar) - 1, "").otherwise(date_of_rank(F.col("hi"), calendar)).alias("valid_to"),
    )
