import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm.packing import TOKENIZER, encoder, pack, pack_texts, plan_containers, segments_of


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30), st.booleans())
def test_patterns_hold_everything_once(counts, harmonic):
    if harmonic:  # slots of reciprocal classes
        slots = {}
        for n, k in counts.items():
            slots[64 // (64 // n)] = slots.get(64 // (64 // n), 0) + k
        counts = slots
    patterns = plan_containers(counts, 64, harmonic)
    held = {}
    for pattern, times in patterns:
        assert times > 0 and 0 < sum(slot * n for slot, n in pattern) <= 64
        for slot, n in pattern:
            held[slot] = held.get(slot, 0) + n * times
    assert held == counts
    assert len(patterns) <= 2 * len(counts) + 1 if not harmonic else len(patterns) <= 2 * len(counts)
    segments_of(patterns)


@pytest.mark.parametrize("harmonic", [False, True])
def test_containers(spark, harmonic):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 7, 50, 99, 100, 101, 333, rng.randint(1, 250)])) for i in range(3000)] + [(9000 + i, 40) for i in range(1500)] + [(5, 7), (5, 7)]
    df = spark.createDataFrame(rows, "doc_id long, tokens int").withColumn("slot", F.lit("clash"))
    got = pack(df.select("doc_id", "tokens"), 100, harmonic).toPandas()
    assert got["tokens"].sum() == sum(t for _, t in rows)
    placed = got[got["container"].notna()]
    used = placed.groupby("container")["tokens"].sum()
    assert used.max() <= 100 and used.min() > 0
    assert sorted(used.index) == list(range(len(used)))
    for _, inside in placed.sort_values(["container", "offset"]).groupby("container"):
        ends = (inside["offset"] + inside["tokens"]).tolist()
        assert all(a <= b for a, b in zip(ends, inside["offset"].tolist()[1:])) and ends[-1] <= 100
    whole = placed[placed["doc_id"] != 5].groupby("doc_id")
    pieces = whole["tokens"].apply(list)
    for i, t in rows[:3000]:
        if t and i != 5:
            assert len(pieces[i]) == -(-t // 100) and sum(pieces[i]) == t
    assert len(got[got["container"].isna()]) == sum(t == 0 for _, t in rows)
    if not harmonic:
        assert used.sum() / (100 * len(used)) > 0.95
    assert pack(df.select("doc_id", "tokens").limit(0), 100, harmonic).count() == 0


def test_texts(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (4, "word " * 20_000), (None, "x"), (6, "<|endoftext|> is text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tokens", F.lit("clash")).withColumn("piece", F.lit(1))
    got = pack_texts(df).toPandas()
    sizes = {r[0]: len(encoder(TOKENIZER).encode_ordinary(r[1])) if r[1] else 0 for r in rows}
    for doc, size in sizes.items():
        mine = got[got["doc_id"].isna()] if doc is None else got[got["doc_id"] == doc]
        assert mine["tokens"].sum() == size
        assert sorted(mine["first_token"]) == list(range(0, max(size, 1), 2048))
    assert pack_texts(df.limit(0)).count() == 0
