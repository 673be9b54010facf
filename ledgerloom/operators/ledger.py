"""Ledgers: merging a delivery into history, current rows, differences between versions, guards, versioned storage."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.text import text_or_empty

#: A delivery smaller than this share of the one before, or with more than this share of failures, is not published.
SHRINK, FAILURES = 0.9, 0.02


def first_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order. Column names are kept; ties take any of the equal rows.

    The minimum of an ordered struct is aggregated on the map side, so a hot key never fills one task.
    """
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*key).agg(F.min(ranked).alias("_best"))
    return best.select(*key, *[F.col("_best")[f"_c{i}"].alias(c) for i, c in enumerate(rest)]).select(*df.columns)


def last_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last in the given order."""
    rest = [c for c in df.columns if c not in key]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)])
    best = df.groupBy(*key).agg(F.max(ranked).alias("_best"))
    return best.select(*key, *[F.col("_best")[f"_c{i}"].alias(c) for i, c in enumerate(rest)]).select(*df.columns)


def current(ledger: DataFrame, seen: str = "last_seen") -> DataFrame:
    """Rows whose last_seen is the ledger's newest. One value reaches the driver and is pushed down to the scan."""
    newest = ledger.agg(F.max(seen)).head()[0]
    return ledger.where(F.col(seen) == newest) if newest is not None else ledger.limit(0)


def as_of(ledger: DataFrame, day: str) -> DataFrame:
    """Rows that a ledger's dates say were listed on a day. Values overwritten since are not restored; VersionStore keeps them."""
    return ledger.where((F.col("first_seen") <= day) & (F.col("last_seen") >= day))


def merge_ledger(old: DataFrame, new: DataFrame, key: list[str], today: str, new_order: list[Column], old_order: list[Column] | None = None) -> DataFrame:
    """A delivery merged into its ledger: the ledger's columns, with first_seen and last_seen.

    Keys delivered take the new values, first_seen from the ledger if filled else today, last_seen today. A delivery that
    comes late never sets last_seen back: for keys seen since, it only moves first_seen to its day, and their values stay.
    Keys not delivered keep their row as it was. Repeated keys: the first delivered row wins, the last ledger row wins. Merging the
    same delivery again on the same day changes nothing. NULL keys are equal to each other.
    """
    values = [c for c in old.columns if c not in (*key, "first_seen", "last_seen")]
    once = first_wins(new.select(*key, *values, *[o.alias(f"_n{i}") for i, o in enumerate(new_order)]), key, [F.col(f"_n{i}") for i in range(len(new_order))])
    kept = last_wins(old, key, old_order) if old_order else old
    a, b = once.alias("a"), kept.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key]
    met = same[0]
    for s in same[1:]:
        met = met & s
    joined = a.withColumn("_new", F.lit(True)).alias("a").join(b.withColumn("_old", F.lit(True)).alias("b"), met, "full_outer")
    is_new = F.col("_new").isNotNull()
    newer = is_new & F.coalesce(F.col("b.last_seen") <= today, F.lit(True))
    take = lambda c, when: F.when(when, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c)
    first = F.when(is_new, F.least(F.nullif(F.col("b.first_seen"), F.lit("")), F.lit(today))).otherwise(F.col("b.first_seen"))
    last = F.when(is_new, F.greatest(F.lit(today), F.col("b.last_seen"))).otherwise(F.col("b.last_seen"))
    return joined.select(*[take(c, is_new) for c in key], *[take(c, newer) for c in values], first.alias("first_seen"), last.alias("last_seen"))


def stopped_total(merged: DataFrame, today: str) -> int:
    """Keys of the ledger that are not listed today, whenever they stopped."""
    return merged.where(F.col("last_seen") != today).count()


def catalog_changes(before: DataFrame, after: DataFrame, key: list[str], shown: list[str], prev_scan: str, this_scan: str) -> DataFrame:
    """Changes between two versions of a ledger: change, the key, and changed: map of field -> struct(old, new).

    new: a key the earlier version lacks. changed: a key in both with another value in a shown field. no_longer_listed:
    listed at the previous scan, not at this one; only when this scan is the later one. Anything else gives no row.
    """
    a, b = before.alias("a"), after.alias("b")
    met = F.lit(True)
    for k in key:
        met = met & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = a.withColumn("_was", F.lit(True)).alias("a").join(b.withColumn("_is", F.lit(True)).alias("b"), met, "full_outer")
    was, now = F.col("_was").isNotNull(), F.col("_is").isNotNull()
    pairs = F.array(*[F.struct(F.lit(f).alias("key"), F.struct(text_or_empty(F.col(f"a.{f}")).alias("old"), text_or_empty(F.col(f"b.{f}")).alias("new")).alias("value")) for f in shown])
    differing = F.map_from_entries(F.filter(pairs, lambda p: p["value"]["old"] != p["value"]["new"]))
    gone = F.lit(this_scan > prev_scan) & was & (F.col("a.last_seen") == prev_scan) & (~now | (F.col("b.last_seen") != this_scan))
    fields = joined.select(
        F.when(~was, "new").when(gone, "no_longer_listed").when(was & now & (F.size(differing) > 0), "changed").alias("change"),
        *[F.when(now, F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in key],
        F.when(was & now, differing).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<old:string,new:string>>"))).alias("changed"),
    )
    return fields.where(F.col("change").isNotNull())


def change_summary(changes: DataFrame) -> DataFrame:
    return changes.groupBy("ledger", "change").agg(F.count("*").alias("n"))


def key_changes(before: DataFrame, after: DataFrame, key: list[str], value: str) -> DataFrame:
    """new, gone and changed keys of two keyed tables: key, change."""
    a, b = before.select(*key, F.col(value).alias("_a")), after.select(*key, F.col(value).alias("_b"))
    joined = a.withColumn("_was", F.lit(True)).join(b.withColumn("_is", F.lit(True)), key, "full_outer")
    change = F.when(F.col("_was").isNull(), "new").when(F.col("_is").isNull(), "gone").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return joined.select(*key, change.alias("change")).where(F.col("change").isNotNull())


def count_delta(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """key, before, after where the counts differ; a missing key counts 0. Both tables have the key and n."""
    joined = before.withColumnRenamed("n", "before").join(after.withColumnRenamed("n", "after"), key, "full_outer")
    filled = joined.select(*key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return filled.where(F.col("before") != F.col("after"))


class GuardError(RuntimeError):
    """A delivery that must not be published."""


def guard_verdict(now: Column, before: Column, failed: Column) -> Column:
    """'' if a delivery may be published, else why not. A missing count before never stops it."""
    return F.when(now < SHRINK * before, "shrunk").when(failed > FAILURES * now, "failed").otherwise("")


def guard(what: str, now: int, before: int | None, failed: int = 0, allow: bool = False) -> str:
    """Raises GuardError for a delivery that shrank or failed too much; with allow=True it only says so."""
    why = ""
    if before and now < SHRINK * before:
        why = f"{what}: {now} now, {before} before"
    elif failed > FAILURES * now:
        why = f"{what}: {failed} of {now} failed"
    if why and not allow:
        raise GuardError(why)
    return why


@dataclass
class VersionStore:
    """Versions of tables as parquet folders under one root, published together by one small manifest.

    Nothing of a version is visible before its manifest is written, so a guard that fails late leaves no half of it.
    """

    spark: SparkSession
    root: str

    def _fs(self):  # noqa: ANN202
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.root)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[str]:
        fs, path = self._fs()
        folder = path(f"{self.root}/_versions")
        return sorted(s.getPath().getName().removesuffix(".json") for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")) if fs.exists(folder) else []

    def _manifest(self, version: str) -> dict[str, str | dict[str, str]]:
        return self.read_json(f"_versions/{version}.json", {})

    def publish(self, version: str, tables: dict[str, DataFrame], partition: dict[str, list[str]] | None = None) -> None:
        """Writes all tables, then the manifest. A version published again replaces the earlier one of that name."""
        places = self._manifest(self.versions()[-1]) if self.versions() else {}
        for name, df in tables.items():
            place = f"{name}/{version}-{uuid.uuid4().hex[:8]}"
            df.write.partitionBy(*(partition or {}).get(name, [])).parquet(f"{self.root}/{place}")
            places[name] = place
        self._point(version, places)

    def publish_buckets(self, version: str, name: str, rows: DataFrame, bucket: Column) -> None:
        """Replaces those buckets of one table that `rows` has rows of; the others stay where they are.

        rows must hold all rows of its buckets. A version published again keeps its other tables and buckets.
        """
        places = self._manifest(self.versions()[-1]) if self.versions() else {}
        place = f"{name}/{version}-{uuid.uuid4().hex[:8]}"
        rows.withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(f"{self.root}/{place}")
        fs, path = self._fs()
        written = [s.getPath().getName() for s in fs.listStatus(path(f"{self.root}/{place}")) if s.isDirectory()]
        held = places.get(name)
        places[name] = {**(held if isinstance(held, dict) else {}), **{b.removeprefix("_bucket="): f"{place}/{b}" for b in written if b.startswith("_bucket=")}}
        self._point(version, places)

    def _point(self, version: str, places: dict) -> None:
        """Makes a version visible: one small file, put in its place by renaming."""
        self.write_json(f"_versions/{version}.json", places)

    def write_json(self, name: str, value: object) -> None:
        """A small file below the root, on whatever file system that is."""
        fs, path = self._fs()
        target, draft = path(f"{self.root}/{name}"), path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True), "utf-8"))
        out.close()
        if fs.exists(target):
            fs.delete(target, False)
        fs.rename(draft, target)

    def read_json(self, name: str, default: object = None) -> object:
        fs, path = self._fs()
        if not fs.exists(path(f"{self.root}/{name}")):
            return default
        return json.loads("".join(r[0] for r in self.spark.read.option("wholetext", True).text(f"{self.root}/{name}").collect()))

    def read(self, name: str, version: str | None = None, buckets: list[int] | None = None) -> DataFrame:
        """A table as of a version (the newest one at or before it), or the newest; of a table in buckets only some, if named."""
        at = [v for v in self.versions() if version is None or v <= version]
        if not at:
            raise LookupError(f"no version of {name}")
        place = self._manifest(at[-1])[name]
        if isinstance(place, str):
            return self.spark.read.parquet(f"{self.root}/{place}")
        paths = [f"{self.root}/{p}" for b, p in sorted(place.items()) if buckets is None or int(b) in buckets]
        every = [f"{self.root}/{p}" for p in place.values()]
        return self.spark.read.parquet(*paths) if paths else self.spark.read.parquet(every[0]).limit(0)


def replace_partition(df: DataFrame, new: DataFrame, column: str, value: str) -> DataFrame:
    """The table with all rows of one value of a column replaced; the other rows stay."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value))).unionByName(new)


def scan_due(today: str, scanned: dict[str, str], sites: list[str], after_days: int = 30) -> tuple[bool, str]:
    """Whether the site scanned longest ago, or never, asks for another scan; the day itself counts."""
    missing = [s for s in sites if not scanned.get(s)]
    if missing:
        return True, f"never scanned: {', '.join(missing)}"
    oldest = min(scanned[s] for s in sites)
    due = date.fromisoformat(oldest) + timedelta(days=after_days)
    return date.fromisoformat(today) >= due, f"due on {due.isoformat()}"


def merge_meta(old: dict, counts: dict[str, dict], ran: list[str], today: str, timing: dict | None = None) -> dict:
    """Scan metadata with the scanned sites' counts and dates renewed; other sites keep theirs."""
    meta = {k: v for k, v in old.items() if k not in ("counts", "scanned", "timing")}
    meta["scanned"] = {**(old.get("scanned") or {}), **{s: today for s in ran}}
    meta["counts"] = {**(old.get("counts") or {}), **{s: counts[s] for s in ran if s in counts}}
    meta["timing"] = timing or {}
    return meta


def _replaces(row: Column, held: Column) -> Column:
    return (row["l"] & ~held["l"]) | (row["k"] > held["k"])


def _after(entries: Column, held: Column) -> Column:
    """What is held after a block: the outcome of the first of its entries that replaces it, else what was held."""
    first = F.get(F.filter(entries, lambda e: held.isNull() | _replaces(e, held)), F.lit(0))
    return F.when(first.isNull(), held).otherwise(first["final"])


def fold_best(rows: DataFrame, group: list[str], order: str, latest: str, key: str, payload: str, block: int = 100_000) -> DataFrame:
    """One row per group by an ordered fold: a row replaces the one held when it is latest and that is not, or its key is greater.

    The fold is not a maximum: a newer row that is not latest displaces one that is. `order` holds whole numbers, unique
    in a group. Rows are folded in blocks of `block` order numbers. A block is summed up by its entries: rows that can be
    the first to replace something, each with what is held at the block's end from then on. Read from the back, an entry
    falls when an earlier row replaces all that it could. So a block keeps at most two entries per distinct key, blocks
    are folded in turn, and a group that holds a third of all rows is spread over its blocks.
    """
    item = F.struct(F.col(order).alias("o"), F.col(latest).alias("l"), F.col(key).alias("k"), F.col(payload).alias("p"))
    kind = rows.select(item.alias("i")).schema["i"].dataType.simpleString()
    entry = f"array<struct<l:boolean,k:array<bigint>,final:{kind}>>"

    def before(entries: Column, row: Column) -> Column:
        here = F.struct(row["l"].alias("l"), row["k"].alias("k"), _after(entries, row).alias("final"))
        reachable = F.filter(entries, lambda e: (e["k"] > row["k"]) | (e["l"] & ~row["l"]))
        return F.concat(F.array(here), reachable)

    backwards = F.reverse(F.array_sort(F.collect_list(item)))
    blocks = rows.groupBy(*group, F.floor(F.col(order) / block).alias("_b")).agg(F.aggregate(backwards, F.array().cast(entry), before).alias("_e"))
    in_turn = F.transform(F.array_sort(F.collect_list(F.struct("_b", "_e"))), lambda x: x["_e"])
    best = F.aggregate(in_turn, F.lit(None).cast(kind), lambda held, entries: _after(entries, held))
    return blocks.groupBy(*group).agg(best.alias("_f")).select(*group, F.col("_f.o").alias(order), F.col("_f.p").alias(payload))


def fill_forward(df: DataFrame, value: Column, group: list[str], order: str, name: str, block: int = 100_000) -> DataFrame:
    """The nearest preceding value that is not NULL, by an integer order, within each group.

    Rows are filled in blocks of `block` order numbers; what a block starts with is the last value of the blocks before
    it. So a group that holds a third of all rows is spread over its blocks. Ties of the order take any of their rows.
    """
    rows = df.withColumn("_v", value).withColumn("_b", F.floor(F.col(order) / block))
    inner = Window.partitionBy(*group, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumn("_own", F.last("_v", ignorenulls=True).over(inner))
    ends = rows.groupBy(*group, "_b").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_end"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, "_b", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = filled.join(carried, [*group, "_b"])
    return joined.select(*df.columns, F.coalesce("_own", "_carried").alias(name))
