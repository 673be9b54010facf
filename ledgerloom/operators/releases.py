"""Release rules: presets, newest lines, ranges and exact labels, evaluated once per entry and set of rules."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.versions import bound, cut_to, line, line_label, listed, major, padded, version_key

PRESETS = ("latest", "latest-per-major", "latest-per-line", "first-per-line")


@dataclass(frozen=True)
class ReleaseRules:
    """Normalised rules. No rules at all take every release; no statement takes the latest ones."""

    everything: bool = False
    presets: tuple[str, ...] = ()
    newest: int = 0
    start: str = ""
    end: str = ""
    exact: tuple[str, ...] = field(default_factory=tuple)

    @property
    def empty(self) -> bool:
        return not (self.everything or self.presets or self.newest or self.start or self.end or self.exact)

    @property
    def numbered(self) -> bool:
        """Whether anything but the latest flag selects labels."""
        return bool(set(self.presets) - {"latest"} or self.newest or self.start or self.end or self.exact)


def release_rules(releases: object = None, until: object = None) -> ReleaseRules:
    """Rules from their written form: None, one rule or a list of all, presets, {newest, from, to} and exact labels."""
    rules = ReleaseRules()
    for rule in ["latest"] if releases is None else releases if isinstance(releases, list | tuple) else [releases]:
        if isinstance(rule, dict):
            start, end = rule.get("from"), rule.get("to")
            rules = replace(
                rules,
                newest=int(rule.get("newest") or rules.newest),
                start=rules.start if start is None else str(start),
                end=rules.end if end is None else str(end),
            )
        elif rule == "all":
            rules = replace(rules, everything=True)
        elif rule in PRESETS:
            rules = replace(rules, presets=(*rules.presets, str(rule)))
        elif rule is not None:
            rules = replace(rules, exact=(*rules.exact, str(rule)))
    return replace(rules, everything=False, end=str(until)) if until else rules


def best_per(labels: DataFrame, entry: str, label: str, group: Column, order: str, newest: bool) -> DataFrame:
    """entry, label: the highest (or lowest) numbered label of each group in padded order; the earlier one among equals.

    An extreme of an ordered struct, so it is aggregated before the shuffle.
    """
    key = version_key(F.col(label))
    rows = labels.select(F.col(entry), F.col(label), F.col(order).alias("_at"), key.alias("_k")).where(F.col("_k").isNotNull())
    rows = rows.withColumn("_g", group(F.col("_k")) if callable(group) else group)
    at = (-F.col("_at")) if newest else F.col("_at")
    pick = (F.max if newest else F.min)(F.struct(padded(F.col("_k")).alias("k"), at.alias("at"), F.col(label).alias("label")))
    return rows.groupBy(entry, "_g").agg(pick.alias("_best")).select(entry, F.col("_best.label").alias(label))


def newest_lines(labels: DataFrame, entry: str, label: str, n: int) -> DataFrame:
    """entry, label: every label on the entry's n newest major.minor lines. Lines are distinct before they are ranked."""
    rows = labels.select(entry, label, line(version_key(F.col(label))).alias("_line")).where(F.col("_line").isNotNull())
    lines = rows.select(entry, "_line").distinct()
    top = lines.withColumn("_r", F.row_number().over(Window.partitionBy(entry).orderBy(F.desc("_line")))).where(F.col("_r") <= n).select(entry, "_line")
    return rows.join(top, [entry, "_line"]).select(entry, label).distinct()


def in_range(label: Column, start: str, end: str) -> Column:
    """Whether a numbered label lies between two bounds, each compared at its own length."""

    def inside(key: Column) -> Column:
        holds = key.isNotNull()
        for written, ok in ((start, lambda c, b: c >= b), (end, lambda c, b: c <= b)):
            if written:
                limit = version_key(F.lit(written))
                holds = holds & F.coalesce(ok(cut_to(key, limit), padded(limit)), F.lit(True))
        return holds

    return F.coalesce(bound(version_key(label), inside), F.lit(False))


def release_set(labels: DataFrame, rules: ReleaseRules, entry: str = "entry", label: str = "release", order: str = "pos") -> DataFrame:
    """entry, label: what the numbered rules take of each entry's labels; the union of all rules, each pair once."""
    parts = []
    if "latest-per-major" in rules.presets:
        parts.append(best_per(labels, entry, label, major, order, True))
    if "latest-per-line" in rules.presets:
        parts.append(best_per(labels, entry, label, line, order, True))
    if "first-per-line" in rules.presets:
        parts.append(best_per(labels, entry, label, line, order, False))
    if rules.newest:
        parts.append(newest_lines(labels, entry, label, rules.newest))
    if rules.start or rules.end:
        parts.append(labels.where(in_range(F.col(label), rules.start, rules.end)).select(entry, label))
    if rules.exact:
        parts.append(labels.where(F.col(label).isin(*rules.exact)).select(entry, label))
    union = labels.select(entry, label).limit(0)
    for i, part in enumerate(parts):
        union = part if i == 0 else union.unionByName(part)
    return union.distinct()


def with_release_ok(docs: DataFrame, rules: ReleaseRules, name: str, entry: str = "entry", label: str = "release", latest: str = "is_latest", order: str = "pos") -> DataFrame:
    """docs with a boolean column: whether the rules take the document's release. Sets are computed once, not per document."""
    if rules.empty or (rules.everything and not rules.start and not rules.end):
        return docs.withColumn(name, F.lit(True))
    by_flag = F.col(latest) if "latest" in rules.presets else F.lit(False)
    if not rules.numbered:
        return docs.withColumn(name, F.coalesce(by_flag, F.lit(False)))
    taken = release_set(docs.select(entry, label, F.col(order)), rules, entry, label, order).withColumn("_in", F.lit(True))
    return docs.join(taken, [entry, label], "left").withColumn(name, F.coalesce(by_flag, F.lit(False)) | F.col("_in").isNotNull()).drop("_in")


def latest_line(options: DataFrame, entry: str = "entry", label: str = "label", pos: str = "pos") -> DataFrame:
    """Options on the same major.minor as the entry's first numbered label in menu order."""
    named = options.withColumn("_line", line_label(F.col(label))).where(F.col("_line").isNotNull())
    first = named.groupBy(entry).agg(F.min(F.struct(F.col(pos).alias("p"), F.col("_line").alias("l"))).alias("_f")).select(entry, F.col("_f.l").alias("_line"))
    return named.join(first, [entry, "_line"], "left_semi").select(*options.columns)


def in_release_order(labels: DataFrame, entry: str = "entry", label: str = "release") -> DataFrame:
    """entry, release, place: each entry's distinct labels, highest first in list order, then by label; the blank one last."""
    rows = labels.select(entry, F.coalesce(F.col(label), F.lit("")).alias(label)).distinct()
    order = Window.partitionBy(entry).orderBy(F.col(label) == "", F.desc(listed(version_key(F.col(label)))), F.desc(label))
    return rows.select(entry, label, F.row_number().over(order).alias("place"))
