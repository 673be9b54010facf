import random

from pyspark.sql import functions as F

from ledgerloom.operators.history import coalesce_history, listing_versions
from ledgerloom.operators.snapshot_diff import ledger_changes

SCHEMA = "row_id long, scan_no int, scan_date string, loaded_at timestamp, latest string, title string, url string, page string, first_seen string, last_seen string"
PAGES = "scan_no int, scan_date string, loaded_at timestamp, site string, name string, title string, status int, tables int, rows int, url string"
DATES = {n: f"2025-0{n}-10" for n in range(1, 9)}


def listing(row, scan, url="https://h/a", latest="yes", title="T", page="p", first="2024-01-01", seen=None, loaded="2025-01-01 00:00:00"):
    import datetime as dt

    return (row, scan, DATES.get(scan), dt.datetime.fromisoformat(loaded) if loaded else None, latest, title, url, page, first, DATES.get(scan) if seen is None else seen)


def test_versions(spark):
    rows = [
        listing(1, 1, "HTTPS://H/a#x"),
        listing(2, 2, "https://h/a/", latest=" Y "),
        listing(3, 3, latest="no"),
        listing(4, 4, latest=None),
        listing(5, 6, latest="TRUE"),
        listing(6, 7, latest="yes", seen=DATES[6]),  # frozen: not listed
        listing(7, 8, latest="no", loaded="2025-01-01 00:00:00"),
        listing(8, 8, latest="true", loaded="2025-01-02 00:00:00"),  # loaded last
        listing(8, 8, latest="true", loaded="2025-01-02 00:00:00"),  # repeated
        listing(9, 1, url=None, page=None, first=None, latest="yes"),
        listing(10, None, url="https://h/none"),
        listing(11, 1, url="https://h/b", loaded=None),
    ]
    rows += [listing(20, 5, url="https://h/other"), listing(21, 2, url="x" * 100_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")).withColumn("payload", F.lit(1)).withColumn("listed", F.lit("clash"))
    got = {tuple(r) for r in listing_versions(df).collect() if len(r["url"]) < 1000}
    assert got == {
        ("https://h/a", "p", "yes", "2024-01-01", DATES[2]),
        ("https://h/a", "p", "no", DATES[3], DATES[4]),
        ("https://h/a", "p", "yes", DATES[6], DATES[6]),
        ("https://h/a", "p", "yes", DATES[8], ""),
        ("", "", "yes", DATES[1], DATES[1]),
        ("https://h/b", "p", "yes", "2024-01-01", DATES[1]),
        ("https://h/other", "p", "yes", DATES[5], DATES[5]),
    }
    assert listing_versions(df.limit(0)).collect() == []


def test_tree_reduction_against_brute_force(spark):
    rng = random.Random(7)
    units = [(e, r, rng.choice([None, "a", "b"])) for e in range(60) for r in range(13) if rng.random() < 0.7]
    df = spark.createDataFrame(units, "e int, r int, v string")
    got = {(x["e"], x["lo"], x["hi"], x["payload"]) for x in coalesce_history(df, ["e"], "r", F.col("v"), F.lit("o"), 13).collect()}
    exp = set()
    for e in range(60):
        mine = sorted((r, v) for x, r, v in units if x == e)
        i = 0
        while i < len(mine):
            j = i
            while j + 1 < len(mine) and mine[j + 1][0] == mine[j][0] + 1 and mine[j + 1][1] == mine[i][1]:
                j += 1
            exp.add((e, mine[i][0], mine[j][0], mine[i][1]))
            i = j + 1
    assert got == exp


def test_changes(spark):
    rows = [
        listing(1, 1, title="A"), listing(2, 2, title=" A\xa0®™​"), listing(3, 3, title="B"),
        listing(4, 1, url="https://h/gone"), listing(5, 2, url="https://h/gone", seen=DATES[1]),
        listing(6, 2, url="https://h/new"), listing(7, 3, url="https://h/new"), listing(8, 3, url="https://h/new"),
        listing(9, 2, url="https://h/dup", title="old", loaded="2025-01-01 00:00:00"), listing(10, 2, url="https://h/dup", title="new", loaded="2025-01-03 00:00:00"),
        listing(11, 3, url="https://h/dup", title="new"), listing(16, 2, url="https://h/tie", title="Z"), listing(17, 2, url="https://h/tie", title="A"), listing(18, 3, url="https://h/tie", title="A"), listing(12, None, url="https://h/null"),
        listing(13, 1, url=None, page=None, title=None), listing(14, 2, url="", page="", title=""), listing(15, 3, url=None, page="", title="x"),
    ]
    pages = [
        (1, DATES[1], None, "s", "n", "T", 200, 1, 2, "u"), (2, DATES[2], None, "s", "n", "T ®", 200, 1, 2, "u"), (3, DATES[3], None, "s", "n", "T", 404, 1, None, "u"),
        (1, DATES[1], None, None, None, None, None, None, None, None), (2, DATES[2], None, "s", "late", "x", 1, 1, 1, "u"), (3, DATES[3], None, "s", "late", "x", 1, 1, 1, "u"),
    ]
    a = spark.createDataFrame(rows, SCHEMA).withColumn("pair", F.lit("clash")).withColumn("ledger", F.lit("clash"))
    b = spark.createDataFrame(pages, PAGES).withColumn("hash", F.lit("clash"))
    got = sorted(tuple(r) for r in ledger_changes(a, b).collect())
    assert got == sorted(
        [
            ("listings", 3, "https://h/a", "p", "changed"),
            ("listings", 2, "https://h/gone", "p", "removed"),
            ("listings", 2, "https://h/new", "p", "added"),
            ("listings", 2, "https://h/dup", "p", "added"),
            ("listings", 2, "https://h/tie", "p", "added"),
            ("listings", 3, "", "", "changed"),
            ("snapshots", 3, "n", "s", "changed"),
            ("snapshots", 2, "", "", "removed"),
            ("snapshots", 2, "late", "s", "added"),
        ]
    )
    assert ledger_changes(a.limit(0), b.limit(0)).collect() == []
    assert {r["ledger"] for r in ledger_changes(a.limit(0), b).collect()} == {"snapshots"}
