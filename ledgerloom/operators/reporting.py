"""Reports over the catalog: numbers, things to check, matrix, search, recommendation dates, and their text."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import stated_date
from ledgerloom.functions.rules import ProductRules, TypeRules
from ledgerloom.functions.text import escape_bars, text_or_empty

NUMBERS = "section string, name string, n bigint, first_ord bigint"


def counted(df: DataFrame, section: str, name: Column, order: str) -> DataFrame:
    """section, name, n, first_ord: how often each value occurs, and where it occurs first."""
    return df.groupBy(name.cast("string").alias("name")).agg(F.count("*").alias("n"), F.min(order).cast("bigint").alias("first_ord")).select(F.lit(section).alias("section"), "name", "n", "first_ord")


def most_common(numbers: DataFrame, n: int | None = None) -> DataFrame:
    """By count, highest first, equal counts in order of first occurrence; with n, only so many."""
    ordered = numbers.orderBy(F.desc("n"), "first_ord", "name")
    return ordered.limit(n) if n is not None else ordered


def format_label(fmt: Column, via: Column) -> Column:
    """The format, with the way it is reached unless that is direct."""
    return F.when(text_or_empty(via).isin("", "direct"), fmt).otherwise(F.concat(fmt, F.lit(" via "), via))


def catalog_numbers(listings: DataFrame, pages: DataFrame, datasheets: DataFrame, health: DataFrame, rules: TypeRules) -> DataFrame:
    """All grouped counts of the catalog as one long table: section, name, n, first_ord.

    listings: heading, format, via, host, title, ord. pages: role, area, ord. datasheets: url, ord. health: check, ord.
    """
    total = lambda df, section, name: df.agg(F.count("*").alias("n"), F.min("ord").cast("bigint").alias("first_ord")).select(F.lit(section).alias("section"), F.lit(name).alias("name"), "n", "first_ord")
    sheets = datasheets.select(F.split_part("url", F.lit("?"), F.lit(1)).alias("bare"), "ord").groupBy("bare").agg(F.min("ord").alias("ord"))
    parts = [
        counted(listings, "heading", F.col("heading"), "ord"),
        counted(listings, "format", format_label(F.col("format"), F.col("via")), "ord"),
        counted(listings, "host", F.col("host"), "ord"),
        counted(listings, "type", rules.document_type(F.col("title"), F.col("format")), "ord"),
        counted(pages, "role", F.col("role"), "ord"),
        counted(pages, "area", F.col("area"), "ord"),
        counted(health, "check", F.col("check"), "ord"),
        total(sheets, "total", "datasheets"),
        total(listings.where(rules.is_translation(F.col("title"))), "total", "translations"),
        total(listings.where(rules.is_quick_reference(F.col("title"))), "total", "quick references"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def matrix(docs: DataFrame, types: Sequence[str], entry: str = "entry", kind: str = "type") -> DataFrame:
    """One row per entry, one column per type with the number of its documents, 0 where there are none."""
    wide = docs.groupBy(entry).pivot(kind, list(types)).agg(F.count(F.lit(1)))
    return wide.select(entry, *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).alias(t) for t in types])


def search(docs: DataFrame, text: str = "", order: Sequence[str] = ("entry", "title", "url"), **equal: object) -> DataFrame:
    """Documents whose title holds every word of the text, with the given field values, in order."""
    found = docs
    for word in text.lower().split():
        found = found.where(F.lower(text_or_empty(F.col("title"))).contains(word))
    for name, value in equal.items():
        found = found.where(F.col(name).isin(*value) if isinstance(value, list | tuple) else F.col(name) == value)
    return found.orderBy(*order)


def by_product(docs: DataFrame, products: ProductRules, entry: str = "entry") -> DataFrame:
    """kind, family, documents, entries: the catalog by product family; entries no family takes come under NULL."""
    placed = docs.withColumn("_p", products.place(F.col(entry)))
    return placed.groupBy(F.col("_p.kind").alias("kind"), F.col("_p.family").alias("family")).agg(F.count("*").alias("documents"), F.count_distinct(entry).alias("entries"))


def unplaced(entries: DataFrame, products: ProductRules, entry: str = "entry") -> DataFrame:
    return entries.where(products.place(F.col(entry)).isNull()).select(entry).distinct()


def release_places(docs: DataFrame, order: DataFrame, types: Sequence[str], entry: str = "entry") -> DataFrame:
    """docs with rel_no and type_no: the place of its release in the entry's list and of its type in the type list, from 0.

    Unknown releases have place 0, unknown types the last place. order: entry, release, place (from 1).
    """
    at = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("type"))
    joined = docs.join(order.select(entry, "release", "place"), [entry, "release"], "left")
    return joined.withColumn("rel_no", F.coalesce(F.col("place") - 1, F.lit(0))).withColumn("type_no", F.when(at > 0, at - 1).otherwise(len(types) - 1)).drop("place")


def explorer_rows(docs: DataFrame, entry: str = "entry", most: int = 1000) -> DataFrame:
    """entry, part, json: each entry's documents as JSON texts of about `most` documents, newest month first, then by title.

    An entry with many documents has several parts, so none grows with the table. '</' is escaped for script tags.
    """
    sizes = docs.groupBy(entry).agg(F.ceil(F.count("*") / most).cast("int").alias("_parts"))
    placed = docs.join(sizes, entry).withColumn("part", F.pmod(F.xxhash64("url"), F.col("_parts")).cast("int"))
    item = F.struct("month", "title", "url", "release", "type", "format", "via")
    packed = placed.groupBy(entry, "part").agg(F.reverse(F.array_sort(F.collect_list(item))).alias("d"))
    return packed.select(entry, "part", F.replace(F.to_json(F.struct(F.col(entry).alias("n"), "d")), F.lit("</"), F.lit("<\\/")).alias("json"))


def recommendation_dates(pages: DataFrame, sites: tuple[str, str] = ("docs-site", "main-site")) -> DataFrame:
    """key, title, and the stated date of each site's page, a dash where it states none; the first site's title wins.

    pages: key, site, title, text.
    """
    said = pages.withColumn("said", stated_date(F.col("text")))
    wide = said.groupBy("key").pivot("site", list(sites)).agg(F.max("title").alias("title"), F.max("said").alias("said"), F.count(F.lit(1)).alias("n"))
    a, b = sites
    shown = lambda s: F.when(F.col(f"`{s}_n`").isNotNull(), F.coalesce(F.col(f"`{s}_said`"), F.lit("–"))).otherwise("–")
    return wide.select("key", F.coalesce(F.col(f"`{a}_title`"), F.col(f"`{b}_title`")).alias("title"), shown(a).alias("first_date"), shown(b).alias("second_date"))


def slow_steps(now: DataFrame, before: DataFrame, share: float = 0.5) -> DataFrame:
    """step, rate, before: steps whose rate fell below a share of the last scan's. Both: step, pages, seconds."""
    rate = lambda df, name: df.where(F.col("seconds") > 0).select("step", (F.col("pages") / F.col("seconds")).alias(name))
    return rate(now, "rate").join(rate(before, "before"), "step").where(F.col("rate") < share * F.col("before"))


def to_check(parts: dict[str, tuple[DataFrame, str, int]]) -> DataFrame:
    """check, n, sample: for each check its rows counted, and the first few names in order. parts: (table, name column, preview)."""
    union = None
    for check, (df, name, preview) in parts.items():
        named = df.select(F.col(name).cast("string").alias("name"))
        n = named.agg(F.lit(check).alias("check"), F.count("*").alias("n"))
        few = named.where("name IS NOT NULL").distinct().orderBy("name").limit(preview).agg(F.lit(check).alias("check"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("sample"))
        row = n.join(few, "check").where("n > 0")
        union = row if union is None else union.unionByName(row)
    return union


#: What a person should look at after a scan, in the order it is shown: the check and how many names are shown of it.
CHECKS = {
    "scanner version changed": 1, "recommendation pages changed": 12, "other snapshots changed": 6, "new latest documents": 12, "rows no longer listed": 4, "guides redirect elsewhere": 4,
    "datasheets changed": 4, "health changed": 6, "new entries": 12, "profiles name unknown entries": 6, "unread labels": 4, "slow steps": 6, "unmapped names": 6, "unplaced products": 6,
}


def scan_checks(
    changes: dict[str, DataFrame], snapshots: DataFrame, health: DataFrame, pages: DataFrame, named: DataFrame, unread: DataFrame, slow: DataFrame, unmapped: DataFrame, unplaced_: DataFrame,
    scanner: tuple[str, str] = ("", ""), recommending: str = "recommend",
) -> DataFrame:
    """check, n, sample of CHECKS that found something.

    changes: ledger -> change, name, latest (flag). snapshots: name. health: name of what changed. pages: entry, first_seen,
    last_seen of the entries' own pages. named: entry that a profile names. The others have a name each. An entry is new if
    it was first seen on the newest day, unless every entry was. scanner: its version before and now.
    """
    one = lambda df, c="name": df.select(F.col(c).cast("string").alias("name"))
    listings, guides, sheets = (changes.get(k) for k in ("listings", "documents", "datasheets"))
    about = F.coalesce(F.col("name").rlike(recommending), F.lit(False))
    days = pages.agg(F.max("last_seen").alias("_today"), F.min("first_seen").alias("_begun"))
    fresh = pages.join(F.broadcast(days), (F.col("first_seen") == F.col("_today")) & (F.col("_today") != F.col("_begun"))).select(F.col("entry").alias("name")).distinct()
    spark = pages.sparkSession
    parts: dict[str, DataFrame | None] = {
        "scanner version changed": spark.range(1).select(F.lit(f"{scanner[0]} to {scanner[1]}").alias("name")) if scanner[0] and scanner[0] != scanner[1] else None,
        "recommendation pages changed": one(snapshots.where(about)),
        "other snapshots changed": one(snapshots.where(~about)),
        "new latest documents": one(listings.where("change = 'new' AND latest")) if listings is not None else None,
        "rows no longer listed": _union([one(df.where("change = 'no_longer_listed'")) for df in changes.values()]),
        "guides redirect elsewhere": one(guides.where("change = 'changed'")) if guides is not None else None,
        "datasheets changed": one(sheets.where("change IN ('new', 'no_longer_listed')")) if sheets is not None else None,
        "health changed": one(health),
        "new entries": fresh,
        "profiles name unknown entries": one(named.select("entry").distinct().join(pages.select("entry"), "entry", "left_anti"), "entry"),
        "unread labels": one(unread), "slow steps": one(slow), "unmapped names": one(unmapped), "unplaced products": one(unplaced_),
    }
    return to_check({check: (parts[check], "name", shown) for check, shown in CHECKS.items() if parts[check] is not None})


def _union(parts: Sequence[DataFrame]) -> DataFrame | None:
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    return found


def table_markdown(df: DataFrame, limit: int = 300) -> str:
    """A small result as a Markdown table, with how many rows are not shown."""
    total, head = df.count(), df.columns
    rows = df.select(*[escape_bars(F.col(c).cast("string")).alias(c) for c in head]).limit(limit).collect()
    lines = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(r) + " |" for r in rows)]
    return "\n".join([*lines, *([f"… {total - limit} more"] if total > limit else [])]) + "\n"


def replace_block(path: str | Path, name: str, body: str) -> bool:
    """Replaces what stands between a file's markers for `name`; False without file or markers; writes only on change."""
    file = Path(path)
    if not file.exists():
        return False
    text = file.read_text(encoding="utf-8")
    begin, end = f"<!-- {name}:begin -->", f"<!-- {name}:end -->"
    if begin not in text or end not in text:
        return False
    head, _, rest = text.partition(begin)
    tail = rest.partition(end)[2]
    new = f"{head}{begin}\n{body.strip()}\n{end}{tail}"
    if new != text:
        file.write_text(new, encoding="utf-8", newline="\n")
    return True


def carry_notes(previous: str | Path, target: str | Path) -> bool:
    """Copies the notes of the last report once, without their heading and status line; False if there is nothing to do."""
    source, goal = Path(previous), Path(target)
    if goal.exists() or not source.exists():
        return False
    lines = source.read_text(encoding="utf-8").splitlines()
    kept = [x for i, x in enumerate(lines) if not (i == 0 and x.startswith("# ")) and not x.lower().startswith("status:")]
    goal.parent.mkdir(parents=True, exist_ok=True)
    goal.write_text(f"# Notes {goal.parent.name}\n\n" + "\n".join(kept).strip() + "\n", encoding="utf-8")
    return True


def latest_report(folder: str | Path) -> str | None:
    """The newest report folder, which is named by its date."""
    names = [p.name for p in Path(folder).iterdir() if re.fullmatch(r"\d{4}-\d{2}-\d{2}", p.name)] if Path(folder).is_dir() else []
    return max(names, default=None)


def change_document(summary: DataFrame, checks: DataFrame, catalog: DataFrame, limit: int = 1000) -> dict:
    """The readable change document of a scan as nested lists; long lists are cut with the numbers left out told.

    `write_changes` puts every row beside it.
    """
    flat = catalog.withColumn("changed", F.to_json("changed")) if "changed" in catalog.columns else catalog
    total = catalog.count()
    return {
        "summary": [r.asDict() for r in summary.orderBy(*summary.columns[:2]).limit(limit).collect()],
        "to_check": [r.asDict() for r in checks.orderBy("check").limit(limit).collect()],
        "catalog": [{**r.asDict(), **({"changed": json.loads(r["changed"])} if "changed" in flat.columns and r["changed"] else {})} for r in flat.orderBy(*flat.columns[:3]).limit(limit).collect()],
        "left_out": max(0, total - limit),
        "left_out_summary": max(0, summary.count() - limit),
        "left_out_to_check": max(0, checks.count() - limit),
    }


def write_rows(df: DataFrame, path: str) -> None:
    """All rows of a table as parquet, sorted by every column that can be."""
    df.orderBy(*[c for c, kind in df.dtypes if "map<" not in kind]).write.mode("overwrite").parquet(path)


def write_changes(folder: str | Path, summary: DataFrame, checks: DataFrame, catalog: DataFrame, limit: int = 1000) -> dict:
    """changes.json, the readable document, and beside it the whole tables changes/summary, changes/to_check and changes/catalog."""
    for name, df in (("summary", summary), ("to_check", checks), ("catalog", catalog)):
        write_rows(df, f"{folder}/changes/{name}")
    document = change_document(summary, checks, catalog, limit)
    (Path(folder) / "changes.json").write_text(json.dumps(document, indent=1, ensure_ascii=False), encoding="utf-8")
    return document


def render_report(document: dict, day: str, numbers: DataFrame | None = None) -> str:
    """The report of a scan in Markdown."""
    out = [f"# Scan of {day}", "", "## What changed", ""]
    out += [f"* {r['ledger']}: {r['n']} {r['change']}" for r in document["summary"]] or ["Nothing."]
    out += ["", "## To check", ""]
    out += [f"* {r['check']}: {r['n']}" + (f" ({r['sample']})" if r.get("sample") else "") for r in document["to_check"]] or ["Nothing."]
    if numbers is not None:
        out += ["", "## Numbers", "", table_markdown(most_common(numbers).select("section", "name", "n"))]
    return "\n".join(out) + "\n"


def render_last_scan(meta: dict) -> str:
    """The block about the last scan: dates, counts and slowest steps."""
    out = [f"* {site}: scanned {day}" + "".join(f", {n:,} {name}" for name, n in sorted((meta.get("counts") or {}).get(site, {}).items()) if isinstance(n, int)) for site, day in sorted((meta.get("scanned") or {}).items())]
    steps = sorted((meta.get("timing") or {}).get("steps") or [], key=lambda s: -s.get("seconds", 0))[:6]
    out += [f"* {s['step']}: {s.get('pages', 0):,} pages in {s.get('seconds', 0):.1f} s" for s in steps]
    return "\n".join(out) or "No scan yet."
