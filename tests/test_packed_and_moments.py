import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.moments import BEGIN, CHANGES, STATES, best_states, normalise_moments, reading_in, readings, times, unit, viterbi
from ledgerloom.operators.packed import STRONG, delimiter_scores, split_cell, unpack


@pytest.mark.parametrize(
    ("cell", "values"),
    [
        (None, []),
        ("", []),
        ("  \xa0 ", []),
        ("N/A", []),
        ("n/a ", []),
        ("-", []),
        ("v1.2", ["v1.2"]),
        ("a, b and c", ["a", "b", "c"]),
        ("a, b, and c,", ["a", "b", "c"]),
        ('"one, two"; three', ["one, two", "three"]),
        ("'X 19\" shelf', Y", ['X 19" shelf', "Y"]),
        ('"X 19"" shelf"', ['X 19" shelf']),
        ("“one; two” | three (four, five)", ["one; two", "three (four, five)"]),
        ("LP10i/e / LP20", ["LP10i/e", "LP20"]),
        ("LP10i/e", ["LP10i/e"]),
        ("a\r\nb\tc", ["a", "b", "c"]),
        ("a; ; b,, c", ["a", "b", "c"]),
        ("Big  \xa0 Name", ["Big Name"]),
        ('unclosed "quote, x', ['unclosed "quote', "x"]),
        (",;|", []),
        ("a & b or c", ["a", "b", "c"]),
    ],
)
def test_split_cell(cell, values):
    assert split_cell(cell, STRONG) == values


def test_very_long_cells():
    assert len(split_cell(", ".join(f"v1.{i}" for i in range(50_000)), STRONG)) == 50_000
    assert split_cell("x" * 500_000, STRONG) == ["x" * 500_000]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.from_regex(r"[A-Za-z]{3,8} [0-9]{3}", fullmatch=True), min_size=1, max_size=6), st.sampled_from([", ", ";", " | ", "\n", "\t", " / ", " and "]))
def test_round_trip(values, delimiter):
    assert split_cell(delimiter.join(values), STRONG) == values


def test_unpack_infers_per_source(spark):
    rows = [("fw", i, f"v{i}.1.2, v{i}.3.4") for i in range(20)] + [("fw", 100 + i, f"v{i}.1") for i in range(30)]
    rows += [("parts", i, f"AB-{i}-C / AB-{i + 1}-C") for i in range(20)] + [("parts", 100 + i, f"AB-{i}-C") for i in range(30)]
    rows += [("fw", 900, None), (None, 901, "x, y"), ("fw", 902, "v1.1.1, v2.2.2"), ("fw", 902, "v1.1.1, v2.2.2")]
    df = spark.createDataFrame(rows, "source_name string, row_id long, packed string").withColumn("pos", F.lit("clash")).withColumn("delimiters", F.lit(1)).withColumn("cell", F.lit(2))
    found = unpack(df, F.col("source_name"), "packed", ["row_id"]).collect()
    by = {}
    for r in found:
        by.setdefault((r["source"], r["row_id"]), []).append((r["pos"], r["val"]))
    assert sorted(by["parts", 3]) == [(1, "AB-3-C"), (2, "AB-4-C")]
    assert sorted(by["parts", 103]) == [(1, "AB-3-C")]
    assert sorted(by["fw", 902]) == [(1, "v1.1.1"), (1, "v1.1.1"), (2, "v2.2.2"), (2, "v2.2.2")]
    assert ("fw", 900) not in by
    scores = {(r["source"], r["candidate"]): r for r in delimiter_scores(df.select(F.col("source_name").alias("source"), F.col("packed").alias("cell"))).collect()}
    assert not scores["parts", "hyphen"]["accepted"] and scores["parts", "spaced slash"]["accepted"]
    assert not scores["fw", "point"]["accepted"] and scores["fw", "comma"]["accepted"]


def test_unpack_empty(spark):
    df = spark.createDataFrame([], "source_name string, row_id long, packed string")
    assert unpack(df, F.col("source_name"), "packed", ["row_id"]).collect() == []


CASES = [
    ("2019-13-04", "UTC", None),
    ("30 Feb 2020", "UTC", None),
    ("Q3 2021", "UTC", None),
    ("Winter 2022", "UTC", None),
    ("June 2023", "UTC", "2023-06"),
    ("05/2020", "UTC", "2020-05"),
    ("FEBRUARY, 2016", "UTC", "2016-02"),
    ("août 2012", "UTC", "2012-08"),
    ("22. Oktober 2019", "UTC", "2019-10-22"),
    ("June 10th, 2010", "UTC", "2010-06-10"),
    ("14-Oct-14", "UTC", "2014-10-14"),
    ("20221006", "UTC", "2022-10-06"),
    ("05/07/2018", "America/New_York", "2018-05-07"),
    ("05/07/2018", "Europe/Berlin", "2018-07-05"),
    ("13/07/2018", "America/New_York", None),
    ("5.12.2014", "America/New_York", "2014-12-05"),
    ("1351817100", "Asia/Tokyo", "2012-11-02T00:45:00Z"),
    ("1288097160116", "UTC", "2010-10-26T12:46:00Z"),
    ("2017-09-12T11:03:09.990215Z", "UTC", "2017-09-12T11:03:09Z"),
    ("2024-10-27T03:43:30+02:00", "UTC", "2024-10-27T01:43:30Z"),
    ("2015-12-01 09:06:02 +0900", "UTC", "2015-12-01T00:06:02Z"),
    ("2012-03-29 18:35:00 Europe/Berlin", "UTC", "2012-03-29T16:35:00Z"),
    ("2010-10-09 03:36:00 America/Los_Angeles", "UTC", "2010-10-09T10:36:00Z"),
    ("Apr 4, 2015 7:42 AM EDT", "Australia/Sydney", "2015-04-04T11:42:00Z"),
    ("Tue, 24 Jan 2017 02:59:00 GMT", "Asia/Tokyo", "2017-01-24T02:59:00Z"),
    ("03/12/2017 2:00 AM", "America/New_York", "2017-03-12T07:00:00Z"),
    ("2023-11-05 01:30", "America/New_York", "2023-11-05T05:30:00Z"),
    ("2013-03-31 02:14", "Europe/Berlin", "2013-03-31T01:14:00Z"),
    ("11/05/2017 12:45 AM", "America/Los_Angeles", "2017-11-05T07:45:00Z"),
    ("11/05/2017 13:45 AM", "America/Los_Angeles", None),
    ("2020-01-01 25:00", "UTC", None),
    (None, "UTC", None),
    ("", "UTC", None),
    ("x" * 200_000, "UTC", None),
]


def test_moments(spark):
    rows = [(i, v, z) for i, (v, z, _) in enumerate(CASES)] + [(None, "2020-01-02", None), (None, "2020-01-02", "No/Zone")]
    df = spark.createDataFrame(rows, "row_id long, written string, tz string").withColumn("_block", F.lit("clash"))
    found = normalise_moments(df, F.lit("t"), F.lit("s"), F.col("row_id"), F.col("written"), F.col("tz"), ["row_id"]).collect()
    got = {r["row_id"]: r["moment"] for r in found if r["row_id"] is not None}
    assert got == {i: m for i, (_, _, m) in enumerate(CASES) if m}
    assert [r["moment"] for r in found if r["row_id"] is None] == ["2020-01-02"] * 2
    assert normalise_moments(df.limit(0), F.lit("t"), F.lit("s"), F.col("row_id"), F.col("written"), F.col("tz"), ["row_id"]).collect() == []


def days(written, stated=False):
    return [[r for r in readings(w, "UTC", {"slash": "dmy"}) if r.usual or not stated] for w in written]


def test_viterbi_follows_the_record_order():
    written = ["01/02/2020", "03/02/2020", "02/13/2020", "02/20/2020", "03/05/2020"]
    assert [r.moment for r in viterbi(days(written))] == ["2020-02-01", "2020-02-03", "2020-02-13", "2020-02-20", "2020-03-05"]
    # An order holds until another is seen, whatever stands between, and each family has its own.
    written = ["02/13/2020", "Mar 1, 2020", "n/a", "03.04.2020", "2020-05-01", "06/07/2020", "1584000000"]
    assert [r and r.moment[:10] for r in viterbi(days(written))] == ["2020-02-13", "2020-03-01", None, "2020-04-03", "2020-05-01", "2020-06-07", "2020-03-12"]
    # With the convention stated nothing is open, and what it makes impossible is not readable.
    assert [r and r.moment for r in viterbi(days(written[:1] + ["03/05/2020"], True))] == [None, "2020-05-03"]


def cost_of(chosen, states):
    cost = BEGIN[states[0]]
    for (a, s), (b, t) in zip(zip(chosen, states), zip(chosen[1:], states[1:])):
        cost += CHANGES[s, t] + (b.at < a.at)
    return cost


def brute(rows):
    """The cheapest of all ways to be in a state at every value and to read it so."""
    import itertools

    held = [r for r in rows if r]
    fits = lambda here, s: None if np.isinf(times(here)[s]) else reading_in(here, s)
    best = np.inf
    for states in itertools.product(range(len(STATES)), repeat=len(held)):
        chosen = [fits(h, s) for h, s in zip(held, states)]
        if None not in chosen:
            best = min(best, cost_of(chosen, states))
    return best


WRITTEN = st.one_of(
    st.tuples(st.integers(1, 14), st.sampled_from("/."), st.integers(1, 14)).map(lambda t: f"{t[0]:02d}{t[1]}{t[2]:02d}{t[1]}2020"),
    st.sampled_from(["2020-03-01", "2020-07", "n/a", "10-Aug-14", "3-Mar-21"]),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(WRITTEN, min_size=1, max_size=4))
def test_viterbi_is_cheapest(written):
    rows = days(written)
    held = [r for r in rows if r]
    if held:
        states = [s for s, _ in best_states([unit(times(r)) for r in held], None, None)]
        assert abs(cost_of([reading_in(r, s) for r, s in zip(held, states)], states) - brute(rows)) < 1e-9
        assert [r for r in viterbi(rows) if r] == [reading_in(r, s) for r, s in zip(held, states)]


def planted(n, seed):
    """Records in order of time whose order of day and month changes now and then, with jumps back; and what they mean."""
    rng, at, out = random.Random(seed), dt.date(2015, 1, 1), []
    forms = ["%d/%m/%Y", "%m/%d/%Y"]
    for _ in range(n):
        at += dt.timedelta(days=rng.randint(0, 5)) if rng.random() < 0.97 else -dt.timedelta(days=40)
        if rng.random() < 0.06:
            forms.reverse()
        form = forms[0] if rng.random() < 0.6 else rng.choice(["%Y-%m-%d", "%b %d, %Y", "%d.%m.%Y"])
        out.append((at.strftime(form), at.isoformat(), form))
    return out


@pytest.mark.parametrize("block", [1, 7, 40, 20_000])
def test_orders_are_found_alike_in_blocks_of_any_size(spark, block):
    held = [(i * 2 + s, f"s{s}", w, want, form) for s in (0, 1) for i, (w, want, form) in enumerate(planted(250, s))]
    df = spark.createDataFrame(held, "row_id long, s string, w string, want string, form string")
    found = normalise_moments(df, F.lit("t"), F.col("s"), F.col("row_id"), F.col("w"), F.lit("UTC"), ["row_id"], stated=False, block_rows=block)
    got = {r["row_id"]: r["moment"] for r in found.collect()}
    whole = {}
    for s in ("s0", "s1"):
        mine = [h for h in held if h[1] == s]
        whole |= {h[0]: r.moment for h, r in zip(mine, viterbi(days([h[2] for h in mine])))}
    assert got == whole
    open_ones = [h for h in held if "/" in h[2] and int(h[2][:2]) <= 12 and int(h[2][3:5]) <= 12 and h[2][:2] != h[2][3:5]]
    right = sum(got[h[0]] == h[3] for h in open_ones)
    fixed = sum(h[4] == "%d/%m/%Y" for h in open_ones)
    assert right >= 0.9 * len(open_ones) and fixed < 0.8 * right


@pytest.mark.parametrize("block", [7, 20_000])
def test_what_conventions_leave_open_is_found_by_the_record_order(spark, block):
    """Named days with the year first, in order of time in one table, and in no order, with the day first, in the other."""
    rng, held = random.Random(5), []
    for name, form in (("timed", "%y-%b-%d"), ("mixed", "%d-%b-%y")):
        days = [dt.date(2012, 1, 10) + dt.timedelta(days=4 * i) for i in range(400)]
        if name == "mixed":
            rng.shuffle(days)
        held += [(name, 2 * i + 1, "31-Feb-21", "2031-02-21" if name == "timed" else None) for i in (7, 200)]  # impossible with the day first
        held += [(name, 2 * i, d.strftime(form if d.day > 9 and i % 5 < 3 else "%d/%m/%Y"), d.isoformat()) for i, d in enumerate(days)]
    df = spark.createDataFrame(held, "t string, row_id long, w string, want string")
    found = normalise_moments(df, F.col("t"), F.lit("s"), F.col("row_id"), F.col("w"), F.lit("UTC"), ["row_id"], block_rows=block)
    assert {(r["source_table"], r["row_id"]): r["moment"] for r in found.collect()} == {(t, i): want for t, i, _, want in held if want}


@settings(max_examples=60, deadline=None)
@given(st.datetimes(dt.datetime(1980, 1, 1), dt.datetime(2060, 1, 1)), st.sampled_from(["%Y-%m-%d %H:%M:%S", "%d-%b-%Y %H:%M:%S", "%d.%m.%Y %H:%M:%S", "%a, %d %b %Y %H:%M:%S GMT", "%Y%m%dT%H%M%SZ"]))
def test_written_and_read_again(moment, form):
    found = readings(moment.strftime(form), "UTC", {"slash": "dmy"})
    assert any(r.usual and r.moment == moment.strftime("%Y-%m-%dT%H:%M:%SZ") for r in found)


def test_types_of_long_pieces_differ_by_their_tails():
    from ledgerloom.operators.packed import signature

    head = " ".join(["a"] * 12)
    assert signature(f"{head} 1") != signature(f"{head} b") and signature(f"{head} 1") == signature(f"{head} 22")
    assert signature(head) == " ".join(["A"] * 12)
