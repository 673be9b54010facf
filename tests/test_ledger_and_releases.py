import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ledger, profiles, releases
from ledgerloom.operators.ledger import GuardError, VersionStore, guard, merge_meta, scan_due

KEYED = "url string, page string, title string, ord int"


def merged(spark, old, new, today):
    o = spark.createDataFrame(old, "url string, page string, title string, first_seen string, last_seen string")
    return {tuple(r) for r in ledger.merge_ledger(o, spark.createDataFrame(new, KEYED), ["url", "page"], today, [F.col("ord")]).collect()}


def test_merge(spark):
    old = [("a", "p", "A", "d1", "d1"), ("b", "p", "B", "d1", "d1"), (None, "p", "N", "", "d1")]
    new = [("a", "p", "A2", 2), ("a", "p", "later", 3), ("c", "p", "C", 1), (None, "p", "N2", 1)]
    want = {("a", "p", "A2", "d1", "d2"), ("b", "p", "B", "d1", "d1"), ("c", "p", "C", "d2", "d2"), (None, "p", "N2", "d2", "d2")}
    assert merged(spark, old, new, "d2") == want
    assert merged(spark, sorted(want, key=str), new, "d2") == want  # the same day again changes nothing
    assert merged(spark, old, [], "d2") == set(old)


def test_merge_invariants(spark):
    rng, rows, day = random.Random(1), [], 1
    for day in range(1, 5):
        new = [(rng.choice("abcdef"), rng.choice("pq"), rng.choice("xyz"), i) for i in range(rng.randint(0, 9))]
        before = {(r[0], r[1]) for r in rows}
        rows = sorted(merged(spark, rows, new, f"d{day}"))
        keys = [(r[0], r[1]) for r in rows]
        assert len(keys) == len(set(keys)) and before <= set(keys)
        assert all(r[3] <= r[4] for r in rows)
        assert {(r[0], r[1]) for r in rows if r[4] == f"d{day}"} == {(n[0], n[1]) for n in new}


def test_changes_between_versions(spark):
    schema = "url string, title string, last_seen string"
    before = spark.createDataFrame([("a", "old", "1"), ("b", "t", "1"), ("back", "t", "0")], schema)
    after = spark.createDataFrame([("a", "new", "2"), ("b", "t", "1"), ("c", "t", "2"), ("back", "t", "2")], schema)
    got = {(r["change"], r["url"]): r["changed"] for r in ledger.catalog_changes(before, after, ["url"], ["title"], "1", "2").collect()}
    assert set(got) == {("new", "c"), ("no_longer_listed", "b"), ("changed", "a")}
    assert got["changed", "a"]["title"]["old"] == "old" and got["changed", "a"]["title"]["new"] == "new"
    same_day = ledger.catalog_changes(before, after, ["url"], ["title"], "1", "1").collect()
    assert "no_longer_listed" not in {r["change"] for r in same_day}


def test_current_and_as_of(spark):
    df = spark.createDataFrame([("a", "1", "3"), ("b", "1", "2"), ("c", "3", "3")], "url string, first_seen string, last_seen string")
    assert {r[0] for r in ledger.current(df).collect()} == {"a", "c"}
    assert ledger.current(df.limit(0)).collect() == []
    assert {r[0] for r in ledger.as_of(df, "2").collect()} == {"a", "b"}


def test_fold_is_no_maximum(spark):
    rows = [("e", "u", 1, True, [9, 3], "x"), ("e", "u", 2, False, [9, 5], "y"), ("e", "u", 3, True, [9, 1], "z")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "e string, u string, o int, l boolean, k array<bigint>, p string").repartition(3)
        assert [tuple(r) for r in ledger.fold_best(df, ["e", "u"], "o", "l", "k", "p").collect()] == [("e", "u", 3, "z")]


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_fold_in_blocks_is_the_fold(spark, block):
    rng = random.Random(block)
    rows = [(g, o, rng.random() < 0.4, [rng.randint(0, 4)] + [rng.randint(0, 3)] * rng.randint(0, 1), f"{g}{o}") for g in range(40) for o in rng.sample(range(60), rng.randint(1, 40))]
    df = spark.createDataFrame(rows, "g int, o int, l boolean, k array<bigint>, p string").repartition(5)
    got = {r["g"]: (r["o"], r["p"]) for r in ledger.fold_best(df, ["g"], "o", "l", "k", "p", block).collect()}
    for g in range(40):
        held = None
        for _, o, latest, k, p in sorted(r for r in rows if r[0] == g):
            if held is None or (latest and not held[1]) or k > held[2]:
                held = (o, latest, k, p)
        assert got[g] == (held[0], held[3])


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_fill_forward(spark, block):
    rng = random.Random(block)
    rows = [(g, i, rng.choice([None, None, f"v{i}"])) for g in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "g string, o int, v string").repartition(4)
    got = {(r["g"], r["o"]): r["f"] for r in ledger.fill_forward(df, F.col("v"), ["g"], "o", "f", block).collect()}
    for g in "ab":
        last = None
        for x, o, v in rows:
            if x == g:
                last = v or last
                assert got[g, o] == last


def test_guards():
    for now, before, failed in ((263, 1475, 0), (1475, 1475, 100)):
        with pytest.raises(GuardError):
            guard("pages", now, before, failed)
        assert guard("pages", now, before, failed, allow=True)
    assert guard("pages", 1400, 1475, 3) == "" and guard("pages", 10, None) == ""


def test_due_and_metadata():
    assert scan_due("2025-02-01", {"a": "2025-01-02", "b": "2025-01-20"}, ["a", "b"])[0]
    assert not scan_due("2025-01-31", {"a": "2025-01-02", "b": "2025-01-20"}, ["a", "b"])[0]
    assert scan_due("2025-01-03", {"a": "2025-01-02"}, ["a", "b"])[0]
    old = {"version": 2, "scanned": {"a": "1", "b": "1"}, "counts": {"a": {"n": 1}, "b": {"n": 2}}}
    meta = merge_meta(old, {"a": {"n": 9}}, ["a"], "2")
    assert meta["scanned"] == {"a": "2", "b": "1"} and meta["counts"] == {"a": {"n": 9}, "b": {"n": 2}} and meta["version"] == 2


def test_version_store(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "store"))
    with pytest.raises(LookupError):
        store.read("t")
    store.publish("2025-01-01", {"t": spark.createDataFrame([(1,)], "x int"), "u": spark.createDataFrame([(5,)], "x int")})
    store.publish("2025-02-01", {"t": store.read("t").union(spark.createDataFrame([(2,)], "x int"))}, {"t": []})
    assert store.versions() == ["2025-01-01", "2025-02-01"]
    assert sorted(r[0] for r in store.read("t").collect()) == [1, 2] and [r[0] for r in store.read("t", "2025-01-15").collect()] == [1]
    assert [r[0] for r in store.read("u").collect()] == [5]
    store.publish("2025-02-01", {"t": spark.createDataFrame([(7,)], "x int")})
    assert [r[0] for r in store.read("t").collect()] == [7]


LABELS = ["9.4.1", "9.4", "9.3.2", "9.3", "8.10.1", "8.9", "33.6.2", "Beta"]


def chosen(spark, written, until=None):
    df = spark.createDataFrame([("e", x, i) for i, x in enumerate(LABELS)], "entry string, release string, pos int")
    return {r["release"] for r in releases.release_set(df, releases.release_rules(written, until)).collect()}


def test_release_rules(spark):
    assert chosen(spark, ["latest-per-major"]) == {"9.4.1", "8.10.1", "33.6.2"}
    assert chosen(spark, ["latest-per-line"]) == {"9.4.1", "9.3.2", "8.10.1", "8.9", "33.6.2"}
    assert chosen(spark, ["first-per-line"]) == {"9.4", "9.3", "8.10.1", "8.9", "33.6.2"}
    assert chosen(spark, [{"newest": 2}]) == {"33.6.2", "9.4", "9.4.1"}
    assert chosen(spark, ["first-per-line", {"newest": 1}]) == {"9.4", "9.3", "8.10.1", "8.9", "33.6.2"}
    assert chosen(spark, [{"from": "9.3", "to": "9.4"}]) == {"9.4.1", "9.4", "9.3.2", "9.3"}
    assert chosen(spark, [{"to": "33.6"}]) == set(LABELS) - {"Beta"}
    assert chosen(spark, ["Beta", 8.9]) == {"Beta", "8.9"}


def test_release_ok(spark):
    df = spark.createDataFrame([("e", x, i, i == 1) for i, x in enumerate(LABELS)], "entry string, release string, pos int, is_latest boolean")
    ok = lambda written, until=None: {r["release"] for r in releases.with_release_ok(df, releases.release_rules(written, until), "ok").where("ok").collect()}
    assert ok(None) == {"9.4"} and ok("latest") == {"9.4"} and ok([]) == set(LABELS) and ok("all") == set(LABELS)
    assert ok("all", "9") == {"9.4.1", "9.4", "9.3.2", "9.3", "8.10.1", "8.9"}
    assert ok(["latest", {"newest": 1}]) == {"9.4", "33.6.2"}


def test_latest_line_and_order(spark):
    df = spark.createDataFrame([("e", "All", 0), ("e", "9.4.1.0", 1), ("e", "9.4.0", 2), ("e", "9.5", 3), ("f", "None", 0)], "entry string, label string, pos int")
    assert {r["label"] for r in releases.latest_line(df).collect()} == {"9.4.1.0", "9.4.0"}
    labels = spark.createDataFrame([("e", x) for x in ("9.4", "9.4.0", "", "x", "10.1", "9.4")] + [("e", None)], "entry string, release string")
    got = [r["release"] for r in releases.in_release_order(labels).orderBy("place").collect()]
    assert got == ["10.1", "9.4.0", "9.4", "x", ""]


def test_profiles(spark):
    rows = [
        ("u1", "E1", "Notes 1", "Notes", "pdf", "9.4", True, False, None), ("u2", "E1", "Guide", "Guide", "pdf", "9.3", False, False, None), ("u3", "E2", "Guide.pdf", "Guide", "pdf", "", True, True, None),
        ("u4", "Sheet", "Sheet", "Datasheet", "file", "", True, False, ["E2"]), ("u1", "E2", "Again", "Notes", "pdf", "9.4", True, False, None), ("u5", "E1", "Skip", "Notes", "pdf", "9.4", True, False, None),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "url string, entry string, title string, type string, format string, release string, is_latest boolean, is_translation boolean, ents array<string>, pos int")
    starters = {"notes": {"filters": [{"types": ["Notes"]}], "snapshots": ["s1"]}}
    written = {"use": ["notes"], "filters": [{"entries": ["E2"]}, {"url": ["u3"]}, {"types": ["Guide"], "releases": "all", "into": "g/{release}"}], "skip": ["u5"], "snapshots": ["s2", "s1"], "folders": "{entry}/{profile}"}
    profile = profiles.load_profile(written, starters)
    assert profile.snapshots == ("s1", "s2")
    got = {r["url"]: (r["filter"], r["path"]) for r in profiles.plan_files(df, profile, ["pos"]).collect()}
    assert got == {"u1": (0, "E1/notes/Notes 1"), "u2": (3, "g/9.3/Guide"), "u3": (2, "E2/Guide"), "u4": (1, "Sheet/Sheet")}
    with pytest.raises(LookupError):
        profiles.load_profile({"use": ["none"]}, starters)
    assert profiles.plan_files(df, profiles.load_profile({}), ["pos"]).collect() == []
    same = profiles.load_profile({"filters": [{"types": "Notes"}], "folders": "x", "names": "url"})
    assert profiles.path_collisions(profiles.plan_files(df.withColumn("url", F.concat(F.lit("h/"), "url", F.lit("/a.pdf"))), same, ["pos"])).count() == 1
