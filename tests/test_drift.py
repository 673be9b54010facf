import itertools
import json
import random

from pyspark.sql import functions as F

from ledgerloom.operators.drift import assignment, match_columns, schema_changes, unified

SCHEMA = "row_id long, file_id long, table_name string, scan_no int, row_no int, record string"


def file(fid, scan, rows, table="t"):
    return [(fid * 1000 + i, fid, table, scan, i, json.dumps(r) if not isinstance(r, str) and r is not None else r) for i, r in enumerate(rows)]


def versions(n, seed):
    rng = random.Random(seed)
    return [f"{rng.randint(1, 40)}.{rng.randint(0, 9)}.{rng.randint(0, 99)}" for _ in range(n)]


def test_changes(spark):
    n = 12
    names, low, flag = [f"P-{i}" for i in range(n)], versions(n, 1), [bool(i % 2) for i in range(n)]
    first = [{"Component": names[i], "Min  Version": low[i], "PoE": flag[i], "Gone": i, "Optics": [i]} for i in range(n)]
    second = [{"c0": names[i], "MIN version ": low[i], "PoE": "Yes" if flag[i] else "No", "New": str(90 - i), "Optics": None} for i in range(n)]
    second = [dict(reversed(r.items())) for r in second]
    third = [{"c0": names[i], "Lowest": low[i] if i else "other", "PoE": "Yes" if flag[i] else "No", "New": 5, "Optics": [1]} for i in range(n)]
    rows = file(1, 1, first) + file(2, 2, second) + file(2, 2, second[:3]) + file(4, 5, third)
    rows += file(7, 1, [{"a": 1}], "alone") + file(8, 1, ["no json", None, "[1]", "{}"], "bad") + file(9, 2, [{"x": None}], "bad")
    rows += [(1, None, "t", 1, 1, "{}"), (2, 50, "t", None, 1, "{}")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lit("clash")).withColumn("anchor", F.lit(1)).withColumn("fields", F.lit(2))
    got = {tuple(r) for r in schema_changes(df).collect()}
    assert got == {
        (2, "renamed", "component", "c0"),
        (2, "retyped", "poe", "poe"),
        (2, "removed", "gone", ""),
        (2, "added", "", "new"),
        (4, "renamed", "min version", "lowest"),
        (4, "retyped", "new", "new"),
        (9, "added", "", "x"),
    }
    table = unified(df, schema_changes(df), ["row_id"]).collect()
    fields = {(r["file"], r["name"]): r["field"] for r in table}
    assert fields[4, "lowest"] == fields[2, "min version"] == fields[1, "min version"] == "min version"
    assert fields[4, "c0"] == "component" and fields[2, "new"] == "new"
    assert schema_changes(df.limit(0)).collect() == [] and unified(df.limit(0), schema_changes(df.limit(0)), []).collect() == []


def test_shuffled_values_are_no_rename(spark):
    names, low = [f"P-{i}" for i in range(20)], versions(20, 3)
    shuffled = low[1:] + low[:1]
    rows = file(1, 1, [{"Part": names[i], "A": low[i]} for i in range(20)]) + file(2, 2, [{"Part": names[i], "B": shuffled[i]} for i in range(20)])
    got = {tuple(r) for r in schema_changes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(2, "removed", "a", ""), (2, "added", "", "b")}


def test_large_files_give_the_same(spark, monkeypatch):
    import ledgerloom.operators.drift as drift

    names, low = [f"P-{i}" for i in range(40)], versions(40, 9)
    rows = file(1, 1, [{"Part": names[i], "A": low[i]} for i in range(40)] * 3) + file(2, 2, [{"Part": names[i], "B": low[i]} for i in range(40)] * 2)
    rows += file(3, 3, [{"Part": "x", "B": "1.2"}])
    df = spark.createDataFrame(rows, SCHEMA)
    want = {tuple(r) for r in schema_changes(df).collect()}
    monkeypatch.setattr(drift, "LARGE", 10)
    assert {tuple(r) for r in schema_changes(df).collect()} == want == {(2, "renamed", "a", "b")}


def test_renames_without_an_identifying_column(spark):
    """Columns of the same kind with nearly the same set of values; sets of few values, and other kinds, are no rename."""
    low = versions(6, 5)
    old = [{"A": low[i % 6], "Flag": "yes" if i % 2 else "no", "N": i % 5} for i in range(30)]
    new = [{"B": low[(i + 1) % 6], "Mark": "yes" if i % 3 else "no", "M": str(i % 5)} for i in range(30)]
    rows = file(1, 1, old) + file(2, 2, new)
    df = spark.createDataFrame([(r, f"f{i}", *rest) for r, i, *rest in rows], SCHEMA.replace("file_id long", "file_id string"))
    changes = schema_changes(df)
    got = {tuple(r) for r in changes.collect()}
    assert got == {("f2", "renamed", "a", "b"), ("f2", "removed", "flag", ""), ("f2", "removed", "n", ""), ("f2", "added", "", "mark"), ("f2", "added", "", "m")}
    assert {r["field"] for r in unified(df, changes, []).where("file = 'f2' AND name = 'b'").collect()} == {"a"}


def test_assignment_is_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 5)
        cost = [[rng.randint(0, 9) for _ in range(n)] for _ in range(n)]
        chosen = assignment(cost)
        assert sorted(chosen) == list(range(n))
        assert sum(cost[i][chosen[i]] for i in range(n)) == min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
    found = match_columns([("a", "x", 0.9), ("a", "y", 0.95), ("b", "y", 0.9)])
    assert {(m["old_name"], m["new_name"]) for m in found} == {("a", "x"), ("b", "y")}
