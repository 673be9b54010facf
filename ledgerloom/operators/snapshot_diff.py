"""What changed between consecutive full snapshots: tagged union, one aggregation shuffle, classification by row hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import squeeze, text_or_empty
from ledgerloom.functions.urls import listing_key
from ledgerloom.operators.history import rank_of_scan, scan_calendar


def tagged(df: DataFrame, key: list[str], rank: str, n_ranks: int, loaded: list[str], listed: Column, fingerprint: Column) -> DataFrame:
    """Each row once as the later side of its own comparison and once as the earlier side of the next one."""
    here, beyond = F.col(rank), F.col(rank) + 1
    sides = F.array(F.struct(here.alias("pair"), F.lit(True).alias("later")), F.struct(beyond.alias("pair"), F.lit(False).alias("later")))
    seen = F.struct(*loaded, listed.alias("listed"), fingerprint.alias("hash"))
    return df.select(*key, seen.alias("seen"), F.explode(sides).alias("_side")).select(
        *key, "_side.pair", F.when(F.col("_side.later"), F.col("seen")).alias("after"), F.when(~F.col("_side.later"), F.col("seen")).alias("before")
    ).where(F.col("pair").between(1, n_ranks - 1))


def classify(sides: DataFrame, key: list[str]) -> DataFrame:
    """added, removed or changed per key and pair; equal rows give nothing.

    On either side the row loaded last counts, ties by the later of the other load columns, then by the larger
    (listed, hash). Both maxima are taken on the map side
    before the single shuffle, so repeated rows of one key never travel.
    """
    both = sides.groupBy(*key, "pair").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    was, now = (F.coalesce(F.col(s)["listed"], F.lit(False)) for s in ("before", "after"))
    change = (
        F.when(was & ~now, "removed").when(~was & now, "added").when(was & now & (F.col("before")["hash"] != F.col("after")["hash"]), "changed")
    )
    return both.select(*key, "pair", change.alias("change")).where(F.col("change").isNotNull())


def ledger_changes(listings: DataFrame, snapshots: DataFrame, calendar: list[tuple[int, str]] | None = None) -> DataFrame:
    """Changes of both ledgers between consecutive scans: ledger, scan_no (the later one), key_a, key_b, change.

    Scans are those either ledger delivers. Keys are never NULL ('' instead). Titles are compared without white space,
    invisible characters and marks; NULL and '' are the same title, while NULL numbers differ from every number.
    Rows without a scan number are left out; of listings loaded at the same time the larger row_id counts; repeated rows
    change nothing; empty tables give no rows.
    """
    if calendar is None:
        calendar = sorted(dict(scan_calendar(snapshots) + scan_calendar(listings)).items())
    if not calendar:
        calendar = [(0, "")]
    n, key = len(calendar), ["ledger", "key_a", "key_b"]
    rank = rank_of_scan(F.col("scan_no"), calendar).alias("rank")
    docs = listings.select(
        F.lit("listings").alias("ledger"),
        listing_key(F.col("url")).alias("key_a"),
        text_or_empty(F.col("page")).alias("key_b"),
        rank,
        "loaded_at",
        F.col("row_id").alias("no"),
        F.coalesce(F.col("last_seen") == F.col("scan_date"), F.lit(False)).alias("listed"),
        F.xxhash64(squeeze(F.col("title"))).alias("hash"),
    )
    pages = snapshots.select(
        F.lit("snapshots").alias("ledger"),
        text_or_empty(F.col("name")).alias("key_a"),
        text_or_empty(F.col("site")).alias("key_b"),
        rank,
        "loaded_at",
        F.lit(None).cast("bigint").alias("no"),
        F.lit(True).alias("listed"),
        F.xxhash64(squeeze(F.col("title")), *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in ("status", "tables", "rows")]).alias("hash"),
    )
    sides = tagged(docs.unionByName(pages).where(F.col("rank").isNotNull()), key, "rank", n, ["loaded_at", "no"], F.col("listed"), F.col("hash"))
    number = F.get(F.array(*[F.lit(no) for no, _ in calendar]), F.col("pair"))
    return classify(sides, key).select("ledger", number.cast("int").alias("scan_no"), "key_a", "key_b", "change")
