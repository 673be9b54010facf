import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.canonical import canonical_entries, deletions, map_to_entries

ENTRIES = [
    (1, "Velmark 3560"), (2, "Halbrook 6650 Gen2"), (3, "LP565i"), (4, "LP565e"), (5, "Juniperal Guest Portal"), (6, "Juniperal Policy Engine"),
    (7, "Ironquay Policy Engine"), (8, "Copperline Event Collector"), (9, "LP323CX"), (10, None), (None, "Nobody Here"), (11, "Velmark 3560"), (12, ""),
]
CASES = {
    "Velmark 3560": 1, "velmark-3560": 1, "VELMARK3560 ser.": 1, "3560": 1, "Vlemark 3560 Series - Enterprise Switches": 1, "_OS on 3560": 1, "Velmark 3561": 0, "Velmark": 0,
    "6650 Halbrook Gen2": 2, "AP LP565i indoor": 3, "lp 565e®": 4, "LP-565-E": 4, "LP565x": 0, "565": 0, "LP323-CX": 9,
    "JuniperalGuestPortal": 5, "juniperalguestportal": 5, "Guest Portal, Juniperal": 5, "Junpieral Gest Portl (software)": 5, "Junip. Guest Portal": 5, "Juniperal Guest Portal v7.3": 5,
    "Juniperal Event Collector": 0, "Ironqauy Policy Enigne": 7, "Policy Engine": 0, "JUNIPERAL POLICYENGINE": 6, "Thermal probe": 0, "various": 0, "​copperline event_collector": 8,
    "x" * 100_000: 0, "...": 0,
}


def test_cases(spark):
    entries = spark.createDataFrame(ENTRIES, "entry_id long, entry string").withColumn("word", F.lit("clash"))
    rows = [(i, v) for i, v in enumerate(CASES)] + [(900, "Velmark 3560"), (900, "Velmark 3560"), (901, None), (902, " \xa0​"), (None, "3560")]
    df = spark.createDataFrame(rows, "row_id long, value string").withColumn("plain", F.lit("clash")).withColumn("score", F.lit(1))
    got = map_to_entries(df, entries, ["row_id"]).collect()
    by = {r["row_id"]: r["entry_id"] for r in got}
    assert {v: by[i] for i, v in enumerate(CASES)} == CASES
    assert [r["entry_id"] for r in got if r["row_id"] == 900] == [1, 1] and by[None] == 1
    assert 901 not in by and 902 not in by
    assert map_to_entries(df.limit(0), entries, ["row_id"]).collect() == []
    assert {r["entry_id"] for r in map_to_entries(df, entries.limit(0), ["row_id"]).collect()} == {0}
    assert canonical_entries(df, entries.limit(0)).collect() == []


def test_entries_are_ranked_by_all_their_words(spark):
    """Values with a model number are repaired and ranked like others: words decide between entries that the number leaves."""
    listed = [(1, "Velmark 3560"), (2, "Halbrook 6650 Gen2"), (3, "Sundrel 4100"), (4, "Marquell 4100"), (5, "Policy Engine"), (6, "Ironquay Policy Engine")]
    entries = spark.createDataFrame(listed, "entry_id long, entry string")
    cases = {
        "Halbrok 6650 (was 3560)": 2, "Vlemark 3560 (was 6650)": 1, "Marquel-4100": 4, "Marq. 4100 switches": 4, "Sundrel 4100": 3, "4100": 3, "Marquell 4200": 0,
        "Ironqauy Policy Engine": 6, "Policy Engine": 5, "Ironquay Engine": 0,
    }
    got = {r["value"]: r["entry_id"] for r in map_to_entries(spark.createDataFrame([(v,) for v in cases], "value string"), entries, []).collect()}
    assert got == cases


@pytest.mark.parametrize(("a", "b"), [("portal", "potral"), ("portal", "ortal"), ("portal", "pprtall"), ("engine", "engnie")])
def test_near_words_share_a_variant(spark, a, b):
    row = spark.range(1).select(deletions(F.lit(a)).alias("a"), deletions(F.lit(b)).alias("b")).head()
    assert set(row["a"]) & set(row["b"])
