"""Mixed timestamp formats and zones: all valid readings per value, chosen by Viterbi over each source's record order."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone
from functools import lru_cache, reduce
from itertools import islice, product
from typing import NamedTuple
from zoneinfo import ZoneInfo, available_timezones

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import cut_lineage

# Month names of four languages, in calendar order.
MONTH_NAMES = {
    1: "january jan januar jän jänner janvier janv enero ene",
    2: "february feb februar février févr fév febrero",
    3: "march mar märz mär mrz mars marzo",
    4: "april apr avril avr abril abr",
    5: "may mai mayo",
    6: "june jun juni juin junio",
    7: "july jul juli juillet juil julio",
    8: "august aug août aout agosto ago",
    9: "september sept sep septembre septiembre set",
    10: "october oct oktober okt octobre octubre",
    11: "november nov novembre noviembre",
    12: "december dec dezember dez décembre déc diciembre dic",
}
MONTHS = {name: no for no, names in MONTH_NAMES.items() for name in names.split()}
# Offsets of zone abbreviations in minutes.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "SGT": 480, "HKT": 480, "JST": 540, "KST": 540, "ACST": 570, "AEST": 600, "ACDT": 630, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
WEEKDAY = re.compile(r"^(?:mon|tue|wed|thu|fri|sat|sun|mo|di|mi|do|fr|sa|so)[a-z]*\.?,\s*", re.I)
ZONES = available_timezones()

_NAME = r"(?P<name>[^\W\d_]+)\.?"
_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?(?: ?(?P<half>[AaPp])\.?[Mm]\b\.?)?"
_ZONE = r"(?: ?(?P<off>[+-]\d{2}(?::?\d{2})?)| ?(?P<zone>[A-Za-z][A-Za-z0-9_+/-]*))?"
_TIME = rf"(?:(?:[T ]|, ?){_CLOCK}{_ZONE})?"
#: Families of written forms; the orders are tried in turn, the first being the usual one.
FAMILIES: list[tuple[str, re.Pattern, tuple[str, ...]]] = [
    ("iso", re.compile(rf"(?P<a>\d{{4}})-(?P<b>\d{{2}})-(?P<c>\d{{2}}){_TIME}$"), ("ymd",)),
    ("iso month", re.compile(r"(?P<y>\d{4})-(?P<m>\d{2})$"), ("ym",)),
    ("basic", re.compile(r"(?P<a>\d{4})(?P<b>\d{2})(?P<c>\d{2})(?:T(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})?(?:[.,]\d+)?" + _ZONE + ")?$"), ("ymd",)),
    ("slash month", re.compile(r"(?P<m>\d{1,2})/(?P<y>\d{4})$"), ("ym",)),
    ("slash", re.compile(rf"(?P<a>\d{{1,2}})/(?P<b>\d{{1,2}})/(?P<c>\d{{4}}|\d{{2}}){_TIME}$"), ("dmy", "mdy")),
    ("point", re.compile(rf"(?P<a>\d{{1,2}})\.(?P<b>\d{{1,2}})\.(?P<c>\d{{4}}|\d{{2}}){_TIME}$"), ("dmy", "mdy")),
    ("day name", re.compile(rf"(?P<a>\d{{1,2}})(?:st|nd|rd|th)?\.?(?:[ -]| de | of ){_NAME}(?:[ -]|, | de )(?P<c>\d{{4}}|\d{{2}}){_TIME}$"), ("dmy", "ymd")),
    ("name day", re.compile(rf"{_NAME} (?P<a>\d{{1,2}})(?:st|nd|rd|th)?,? (?P<c>\d{{4}}){_TIME}$"), ("dmy",)),
    ("name month", re.compile(rf"{_NAME}(?:,? | de )(?P<y>\d{{4}})$"), ("ym",)),
    ("seconds", re.compile(r"(?P<e>\d{10})$"), ("unix",)),
    ("milliseconds", re.compile(r"(?P<e>\d{13})$"), ("unix",)),
]


class Reading(NamedTuple):
    """One interpretation: its form, whether it follows the order usual for the source, its text and a time to compare."""

    form: str
    usual: bool
    moment: str
    at: float


@lru_cache(maxsize=2048)
def zone_of(name: str) -> timezone | ZoneInfo | None:
    if (minutes := ABBREVIATIONS.get(name.upper() if len(name) < 6 else name)) is not None:
        return timezone(timedelta(minutes=minutes))
    return ZoneInfo(name) if name in ZONES else None


@lru_cache(maxsize=2048)
def offset_of(text: str) -> timezone | None:
    digits = text[1:].replace(":", "").ljust(4, "0")
    minutes = int(digits[:2]) * 60 + int(digits[2:])
    return timezone(timedelta(minutes=-minutes if text[0] == "-" else minutes)) if minutes < 1440 and int(digits[2:]) < 60 else None


def _date(part: dict, order: str) -> tuple[int, int, int] | None:
    """year, month, day under an order of the parts a, b, c; a month name stands for the month part."""
    if part.get("name") is not None:
        month = MONTHS.get(part["name"].lower())
        if month is None:
            return None
        first, last = part["a"], part["c"]
        if order == "ymd" and (len(last) != 2 or len(first) != 2):
            return None
        year, day = (last, first) if order == "dmy" else (first, last)
    else:
        by = dict(zip(order, (part["a"], part["b"], part["c"])))
        year, month, day = by["y"], int(by["m"]), by["d"]
    return (2000 if len(year) == 2 else 0) + int(year), int(month), int(day)


def _clock(part: dict) -> tuple[int, int, int] | None:
    hour, half = int(part["h"]), part.get("half")
    if half:
        if not 1 <= hour <= 12:
            return None
        hour = hour % 12 + (12 if half in "pP" else 0)
    return hour, int(part["mi"]), int(part["s"] or 0)


def readings(text: str | None, zone: str, usual: dict[str, str]) -> list[Reading]:
    """All valid interpretations of a value. zone: where none is stated; usual: family -> order that is usual here.

    A local time that occurs twice is the first one; one that is skipped takes the offset before the change.
    """
    if text is None:
        return []
    text = WEEKDAY.sub("", " ".join(re.sub("[\u200b\u200c\u200d\ufeff]", "", text).split()))
    found = []
    for family, pattern, orders in FAMILIES:
        match = pattern.match(text)
        if not match:
            continue
        part = match.groupdict()
        for order in orders:
            try:
                if order == "unix":
                    at = datetime(1970, 1, 1) + timedelta(seconds=int(part["e"][:10]))
                    moment = at.strftime("%Y-%m-%dT%H:%M:%SZ")
                elif order == "ym":
                    month = MONTHS.get(part["name"].lower()) if part.get("name") else int(part["m"])
                    if month is None:
                        continue
                    at = datetime(int(part["y"]), month, 1)
                    moment = f"{at.year:04d}-{at.month:02d}"
                else:
                    date = _date(part, order)
                    if date is None:
                        continue
                    at = datetime(*date)
                    moment = f"{at.year:04d}-{at.month:02d}-{at.day:02d}"
                    if part.get("h"):
                        clock = _clock(part)
                        stated = offset_of(part["off"]) if part.get("off") else zone_of(part["zone"] if part.get("zone") else zone)
                        if clock is None or stated is None:
                            continue
                        at = datetime(*date, *clock, tzinfo=stated).astimezone(timezone.utc).replace(tzinfo=None)
                        moment = f"{at.year:04d}-{at.month:02d}-{at.day:02d}T{at.hour:02d}:{at.minute:02d}:{at.second:02d}Z"
            except (ValueError, OverflowError):
                continue
            found.append(Reading(f"{family} {order}", order == usual.get(family, orders[0]), moment, (at - datetime(1970, 1, 1)).total_seconds()))
    return found


#: Families whose written form leaves the order of its parts open. A source is in one order of each at any time.
OPEN = {family: orders for family, _, orders in FAMILIES if len(orders) > 1}
#: All states of a source: for each open family the place of the order it is in.
STATES = list(product(*[range(len(orders)) for orders in OPEN.values()]))
#: Orders two states differ in; what a change of order and a jump back in time cost; and what it costs to begin otherwise than usual.
CHANGES = np.array([[sum(x != y for x, y in zip(a, b)) for b in STATES] for a in STATES], dtype=float)
SWITCH, BACKWARD, UNUSUAL = 1.0, 1.0, 0.25
BEGIN = np.array([UNUSUAL * sum(1 for x in state if x) for state in STATES])


def _fits(family: str, order: str) -> np.ndarray:
    """The states in which a value of a family is read in an order."""
    if family not in OPEN:
        return np.ones(len(STATES), dtype=bool)
    at = list(OPEN).index(family)
    return np.array([OPEN[family][state[at]] == order for state in STATES])


FITS = {f"{family} {order}": _fits(family, order) for family, _, orders in FAMILIES for order in orders}
#: A named day that can be read with the year first only: an impossible date unless the source is in that order, which it can't tell.
DOUBTFUL, YEAR_FIRST = "day name doubtful", FITS["day name ymd"]
FITS[DOUBTFUL] = np.ones(len(STATES), dtype=bool)


def times(here: list[Reading]) -> np.ndarray:
    """For every state the time of the reading it gives a value; infinite where it gives none."""
    found = np.full(len(STATES), np.inf)
    for r in here:
        found[FITS[r.form]] = r.at
    return found


def step_costs(before: np.ndarray | None, now: np.ndarray, backward: float = BACKWARD) -> np.ndarray:
    """Cost of going from each state at one value to each state at the next one, given the times they read there."""
    back = 0.0 if before is None else backward * (now[None, :] < before[:, None])
    return np.where(np.isinf(now)[None, :], np.inf, SWITCH * CHANGES + back)


class Stretch(NamedTuple):
    """Consecutive values of a source summed up: cost from each state at its first value to each at its last, and the times there."""

    costs: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def then(self, other: Stretch, backward: float = BACKWARD) -> Stretch:
        """This stretch and the one that follows it as one; the order of joining makes no difference."""
        between = cheapest(self.costs, step_costs(self.last, other.first, backward))
        return Stretch(cheapest(between, other.costs), self.first, other.last)


def cheapest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two tables of costs: cheapest way from each row of the one to each column of the other."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def unit(now: np.ndarray) -> Stretch:
    """One value as a stretch: it is left in the state it is met in."""
    costs = np.where(np.eye(len(STATES), dtype=bool) & ~np.isinf(now)[None, :], 0.0, np.inf)
    return Stretch(costs, now, now)


def best_states(parts: list[Stretch], enter: np.ndarray | None, leave: int | None, backward: float = BACKWARD) -> list[tuple[int, int]]:
    """The cheapest state at the first and the last value of each stretch. Ties go to the earlier state.

    enter: costs of the states at the first value (BEGIN if NULL); leave: the state at the last value, if it is settled.
    """
    ahead: list[np.ndarray] = []  # cost to go from each state at the first value of a stretch
    to_go = np.zeros(len(STATES)) if leave is None else np.where(np.arange(len(STATES)) == leave, 0.0, np.inf)
    for i in range(len(parts) - 1, -1, -1):
        if i + 1 < len(parts):
            to_go = (step_costs(parts[i].last, parts[i + 1].first, backward) + ahead[-1][None, :]).min(axis=1)
        ahead.append((parts[i].costs + to_go[None, :]).min(axis=1))
    ahead.reverse()
    chosen, costs = [], BEGIN if enter is None else enter
    for i, part in enumerate(parts):
        first = int(np.argmin(costs + ahead[i]))
        after = np.zeros(len(STATES)) if leave is None else np.where(np.arange(len(STATES)) == leave, 0.0, np.inf)
        if i + 1 < len(parts):
            after = (step_costs(part.last, parts[i + 1].first, backward) + ahead[i + 1][None, :]).min(axis=1)
        last = int(np.argmin(part.costs[first] + after))
        chosen.append((first, last))
        if i + 1 < len(parts):
            costs = step_costs(part.last, parts[i + 1].first, backward)[last]
    return chosen


def viterbi(rows: list[list[Reading]], enter: int | None = None, leave: int | None = None, backward: float = BACKWARD) -> list[Reading | None]:
    """The cheapest choice of one reading per value: changes of an order within a family and jumps back in time cost.

    A source is in one order of every open family at any time, so a value that can be read in one order only speaks for
    all of its family before and after it, whatever stands between them. Values without a reading are passed over. enter
    and leave: states at the first and the last value where they are settled already.
    """
    chosen: list[Reading | None] = [None] * len(rows)
    places = [i for i, here in enumerate(rows) if here]
    if not places:
        return chosen
    if all(len(rows[i]) == 1 and rows[i][0].form != DOUBTFUL for i in places):
        for i in places:
            chosen[i] = rows[i][0]
        return chosen
    for i in places:
        if len(rows[i]) == 1:
            chosen[i] = rows[i][0]
    kept = events(rows, places)
    begin = None if enter is None else np.where(np.arange(len(STATES)) == enter, 0.0, np.inf)
    for i, (state, _) in zip(kept, best_states([unit(times(rows[i])) for i in kept], begin, leave, backward)):
        chosen[i] = reading_in(rows[i], state)
    return chosen


def is_plain(here: list[Reading]) -> bool:
    """Whether a value has one reading and that says nothing about an order."""
    return len(here) == 1 and here[0].form.rpartition(" ")[0] not in OPEN


def events(rows: list[list[Reading]], places: list[int]) -> list[int]:
    """The values that can make a difference: those of open families, what stands directly before and after them, and both ends.

    Between other values every state costs the same, so no state would change there.
    """
    plain = [is_plain(rows[i]) for i in places]
    last = len(places) - 1
    return [i for n, i in enumerate(places) if n in (0, last) or not (plain[n] and plain[n - 1] and plain[n + 1])]


def reading_in(here: list[Reading], state: int) -> Reading | None:
    """The reading a state gives a value."""
    if here[0].form == DOUBTFUL and not YEAR_FIRST[state]:
        return None
    return next((r for r in here if FITS[r.form][state]), here[0])


#: Families whose order a convention states; that of named days with a year of two digits is left open.
SETTLED = ("slash", "point")


def _readings_of(pdf: pd.DataFrame, stated: bool) -> list[list[Reading]]:
    american, plain = {"slash": "mdy"}, {"slash": "dmy"}
    zones = [z if z and z in ZONES else "UTC" for z in pdf["_zone"]]
    if not stated:
        return [readings(v, z, plain) for v, z in zip(pdf["_value"], zones)]
    found = [[r for r in readings(v, z, american if z.startswith("America") else plain) if r.usual or not r.form.startswith(SETTLED)] for v, z in zip(pdf["_value"], zones)]
    return [[here[0]._replace(form=DOUBTFUL)] if len(here) == 1 and here[0].form == "day name ymd" else here for here in found]


def _by_source(pdf: pd.DataFrame) -> dict[str, list[int]]:
    found: dict[str, list[int]] = {}
    for i, s in enumerate(pdf["_source"]):
        found.setdefault(s, []).append(i)
    return found


def _summed(pdf: pd.DataFrame, stated: bool = False, backward: dict[str, float] | None = None) -> pd.DataFrame:
    """One block of a table: for each of its sources the stretch of its values; sources without a readable value have none."""
    pdf = pdf.sort_values(["_order", "_value"], kind="stable")
    parsed, out = _readings_of(pdf, stated), []
    cost = (backward or {}).get(pdf["_table"].iat[0], BACKWARD)
    for source, places in _by_source(pdf).items():
        held = [i for i in places if parsed[i]]
        if held:
            whole = reduce(lambda a, b: a.then(b, cost), [unit(times(parsed[i])) for i in events(parsed, held)])
            out.append((pdf["_table"].iat[0], source, pdf["_block"].iat[0], whole.costs.ravel(), whole.first, whole.last))
    return pd.DataFrame(out, columns=["_table", "_source", "_block", "costs", "first", "last"])


def _steps(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of a table: for each of its sources the first and last time told by one reading, and how often the next is later or earlier."""
    pdf = pdf.sort_values(["_order", "_value"], kind="stable")
    parsed, out = _readings_of(pdf, True), []
    for source, places in _by_source(pdf).items():
        told = np.array([parsed[i][0].at for i in places if len(parsed[i]) == 1 and parsed[i][0].form != DOUBTFUL])
        if len(told):
            out.append((pdf["_table"].iat[0], source, pdf["_block"].iat[0], told[0], told[-1], int((np.diff(told) > 0).sum()), int((np.diff(told) < 0).sum())))
    return pd.DataFrame(out, columns=["_table", "_source", "_block", "first", "last", "forth", "back"])


def jump_costs(rows: DataFrame) -> dict[str, float]:
    """What a jump back in time costs in each table: BACKWARD if its records stand in order of time, 0 if in none.

    Told by all values that have one reading: by how much more of them are later than the one before than earlier, beyond
    three standard errors. In steps of 2^-10, so that sums of costs are exact in any order.
    """
    steps = rows.groupBy("_table", "_block").applyInPandas(_steps, "_table string, _source string, _block long, first double, last double, forth long, back long")
    before = F.lag("last").over(Window.partitionBy("_table", "_source").orderBy("_block"))
    steps = steps.withColumn("_edge", F.coalesce(F.signum(F.col("first") - before), F.lit(0.0)))
    sums = steps.groupBy("_table").agg(F.sum(F.col("forth") + (F.col("_edge") > 0).cast("long")).alias("forth"), F.sum(F.col("back") + (F.col("_edge") < 0).cast("long")).alias("back"))
    found = {}
    for r in sums.collect():  # one row per table
        n = max(1, r["forth"] + r["back"])
        found[r["_table"]] = round(1024 * BACKWARD * max(0.0, (r["forth"] - r["back"]) / n - 3 / n**0.5)) / 1024
    return found


def _groups(batches: Iterator[pd.DataFrame], keys: int) -> Iterator[list[tuple]]:
    """Rows that agree in their first `keys` columns, from batches of a partition sorted by these."""
    held: list[tuple] = []
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _stretch(costs: Sequence[float], first: Sequence[float], last: Sequence[float]) -> Stretch:
    return Stretch(np.array(costs).reshape(len(STATES), -1), np.array(first), np.array(last))


def _frames(rows: Iterator[tuple], columns: list[str], size: int = 5_000) -> Iterator[pd.DataFrame]:
    while part := list(islice(rows, size)):
        yield pd.DataFrame(part, columns=columns)


def settled_blocks(summed: DataFrame, run: int = 1_000, backward: dict[str, float] | None = None) -> DataFrame:
    """_table, _source, _block, enter, leave: the states of each source at the first and the last value of each block.

    summed holds a stretch for every source and block. Runs of `run` blocks are joined to one stretch each, the ends of
    runs are settled over a source's runs, and then the ends of blocks within each run. So what one step holds is a
    thousandth, or a millionth, of what a block sums up, and the result is that of one pass over all records.
    """
    costs = backward or {}
    held = summed.select("_table", "_source", F.floor(F.col("_block") / run).alias("_run"), "_block", "costs", "first", "last")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for group in _groups(batches, 3):
                whole = reduce(lambda a, b: a.then(b, costs.get(group[0][0], BACKWARD)), (_stretch(*r[4:7]) for r in group))
                yield *group[0][:3], whole.costs.ravel(), whole.first, whole.last

        yield from _frames(rows(), ["_table", "_source", "_run", "costs", "first", "last"])

    def over_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for group in _groups(batches, 2):
                ends = best_states([_stretch(*r[3:6]) for r in group], None, None, costs.get(group[0][0], BACKWARD))
                yield from ((*r[:3], *e) for r, e in zip(group, ends))

        yield from _frames(rows(), ["_table", "_source", "_run", "enter", "leave"])

    def within_run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for group in _groups(batches, 3):
                begin = np.where(np.arange(len(STATES)) == group[0][7], 0.0, np.inf)
                ends = best_states([_stretch(*r[4:7]) for r in group], begin, int(group[0][8]), costs.get(group[0][0], BACKWARD))
                yield from ((r[0], r[1], r[3], *e) for r, e in zip(group, ends))

        yield from _frames(rows(), ["_table", "_source", "_block", "enter", "leave"])

    key = ["_table", "_source", "_run"]
    kinds = "_table string, _source string, "
    runs = held.repartition(*key).sortWithinPartitions(*key, "_block").mapInPandas(joined, kinds + "_run long, costs array<double>, first array<double>, last array<double>")
    ends = runs.repartition(*key[:2]).sortWithinPartitions(*key).mapInPandas(over_runs, kinds + "_run long, enter int, leave int")
    met = held.join(ends.hint("merge"), key).select(*key, "_block", "costs", "first", "last", "enter", "leave")
    return met.repartition(*key).sortWithinPartitions(*key, "_block").mapInPandas(within_run, kinds + "_block long, enter int, leave int")


def normalise_moments(
    df: DataFrame, table: Column, source: Column, order: Column, value: Column, zone: Column, keep: list[str], stated: bool = True, block_rows: int = 20_000
) -> DataFrame:
    """table, the columns in `keep`, and moment (UTC text at the value's own precision), one row per readable value.

    All valid readings of a value are taken, and one path through them is chosen for each source over its records in their
    order. With stated=True, conventions settle what is valid: slashed days are month first where the zone starts with
    America, else day first; with points, day first; one that is impossible under its convention is not readable. Whether
    the day or the year of two digits comes first with a named month, no convention says. With stated=False no order of
    parts is known. Viterbi finds what is open from the values that can be read in one order only, from changes of order
    and from jumps back in time; with stated=True these cost what `jump_costs` finds them to tell in a table.

    Records are read in blocks of `block_rows` consecutive order numbers, a bound on what one task holds whatever the
    source's share of the rows; blocks are summed up and joined, so that the result does not depend on them.
    NULL, blank and impossible values give no rows; an unknown or missing zone counts as UTC; ties of the order number are
    taken in the value's own order, and rows without one by a hash of their value; a NULL source is the source ''; repeated
    rows give repeated results; an empty table gives no rows.
    """
    rows = df.select(
        table.cast("string").alias("_table"), F.coalesce(source.cast("string"), F.lit("")).alias("_source"), order.cast("bigint").alias("_order"),
        value.cast("string").alias("_value"), zone.cast("string").alias("_zone"), *keep,
    ).where(F.length(F.trim("_value")) > 0)
    rows = rows.withColumn("_block", F.floor(F.coalesce(F.col("_order"), F.xxhash64("_value")) / block_rows))
    schema = "_table string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", moment string"

    backward = jump_costs(rows) if stated else {}

    def choose(pdf: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_value"], kind="stable")
        parsed = _readings_of(pdf, stated)
        at = {s: (a, b) for s, a, b in zip(ends["_source"], ends["enter"], ends["leave"])}
        moments: list = [None] * len(parsed)
        for s, places in _by_source(pdf).items():
            cost = backward.get(pdf["_table"].iat[0], BACKWARD)
            for i, r in zip(places, viterbi([parsed[i] for i in places], *at.get(s, (None, None)), cost)):
                if r is not None:
                    moments[i] = r.moment
        out = pdf[["_table", *keep]].assign(moment=moments)
        return out[out["moment"].notna()]

    summed = cut_lineage(
        rows.groupBy("_table", "_block").applyInPandas(
            lambda pdf: _summed(pdf, stated, backward), "_table string, _source string, _block long, costs array<double>, first array<double>, last array<double>"
        )
    )
    ends = settled_blocks(summed, backward=backward)
    found = rows.groupBy("_table", "_block").cogroup(ends.groupBy("_table", "_block")).applyInPandas(choose, schema)
    return found.withColumnRenamed("_table", "source_table")
