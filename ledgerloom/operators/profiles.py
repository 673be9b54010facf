"""Profiles: declarative selections compiled into one CASE expression over documents, and the file plan they give."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import safe_name, text_or_empty
from ledgerloom.functions.urls import decoded, last_segment
from ledgerloom.operators.ledger import first_wins
from ledgerloom.operators.releases import ReleaseRules, release_rules, with_release_ok

KNOWN_EXTENSIONS = r"(?i)\.(?:pdf|zip|xlsx?|csv|html?|gz)$"
FOLDERS, NAMES = "{entry}/{type}", "title"


@dataclass(frozen=True)
class Filter:
    """One selection of a profile. A list of addresses decides alone; otherwise all stated conditions must hold."""

    origin: str = ""
    entries: tuple[str, ...] = ()
    types: tuple[str, ...] = ()
    formats: tuple[str, ...] = ()
    urls: tuple[str, ...] = ()
    releases: ReleaseRules = field(default_factory=release_rules)
    translations: bool = False
    into: str = ""


@dataclass(frozen=True)
class Profile:
    filters: tuple[Filter, ...] = ()
    skip: tuple[str, ...] = ()
    snapshots: tuple[str, ...] = ()
    folders: str = FOLDERS
    names: str = NAMES
    replaced: str = "archive"
    dropped: str = "archive"
    details: bool = False


def _texts(value: object) -> tuple[str, ...]:
    if value is None:
        return ()
    return tuple(str(v) for v in value) if isinstance(value, list | tuple) else (str(value),)


def load_profile(written: dict, starters: dict[str, dict] | None = None) -> Profile:
    """A profile from its written form, with the starters it uses folded in before its own filters, in order."""
    chain: list[tuple[str, dict]] = []
    for name in _texts(written.get("use")):
        if name not in (starters or {}):
            raise LookupError(f"no starter profile named {name}")
        chain.append((name, starters[name]))
    chain.append(("", written))
    filters, snapshots = [], {}
    for origin, part in chain:
        for f in part.get("filters") or []:
            filters.append(
                Filter(
                    origin, _texts(f.get("entries")), _texts(f.get("types")), _texts(f.get("format")), _texts(f.get("url")),
                    release_rules(f.get("releases"), f.get("until")), bool(f.get("translations")), str(f.get("into") or ""),
                )
            )
        snapshots.update(dict.fromkeys(_texts(part.get("snapshots"))))
    return Profile(
        tuple(filters), _texts(written.get("skip")), tuple(snapshots), written.get("folders") or FOLDERS, written.get("names") or NAMES,
        written.get("replaced") or "archive", written.get("dropped") or "archive", written.get("details") in (True, "on"),
    )


def condition(f: Filter, release_ok: Column) -> Column:
    """A filter as a predicate over docs(entry, ents, url, type, format, is_translation)."""
    if f.urls:
        return F.col("url").isin(*f.urls)
    holds = F.lit(True)
    if f.entries:
        wanted = F.array(*[F.lit(e) for e in f.entries])
        belongs = F.concat(F.array("entry"), F.coalesce(F.col("ents"), F.array().cast("array<string>")))
        holds = holds & F.coalesce(F.arrays_overlap(belongs, wanted), F.lit(False))
    if f.types:
        holds = holds & F.col("type").isin(*f.types)
    if f.formats:
        holds = holds & F.col("format").isin(*f.formats)
    if not f.translations:
        holds = holds & ~F.coalesce(F.col("is_translation"), F.lit(False))
    return F.coalesce(holds & release_ok, F.lit(False))


def matched(docs: DataFrame, profile: Profile) -> DataFrame:
    """docs with `filter`: the number of the first filter that takes the document, NULL for none.

    The filters are one COALESCE over predicates, so no join of documents with filters is planned; release sets are
    joined once per distinct set of rules.
    """
    rules: list[ReleaseRules] = []
    for f in profile.filters:
        if not f.urls and f.releases not in rules:
            rules.append(f.releases)
    for i, r in enumerate(rules):
        docs = with_release_ok(docs, r, f"_ok{i}")
    first = [F.when(condition(f, F.col(f"_ok{rules.index(f.releases)}") if not f.urls else F.lit(True)), F.lit(n)) for n, f in enumerate(profile.filters)]
    return docs.withColumn("filter", F.coalesce(*first, F.lit(None).cast("int"))).drop(*[f"_ok{i}" for i in range(len(rules))])


def folder_of(template: Column, entry: Column, kind: Column, release: Column, origin: Column) -> Column:
    """A folder template with its fields filled in as file names; empty parts vanish."""
    path = template
    for name, value in (("entry", entry), ("type", kind), ("release", release), ("profile", origin)):
        filled = F.when(text_or_empty(value) == "", F.lit("")).otherwise(safe_name(value))
        path = F.replace(path, F.lit("{" + name + "}"), filled)
    return F.regexp_replace(F.regexp_replace(path, "/+", "/"), "^/|/$", "")


def base_name(title: Column, url: Column, names: str) -> Column:
    """The file's name without a known extension: its title, or the name in its address."""
    raw = F.coalesce(F.nullif(text_or_empty(title), F.lit("")), decoded(last_segment(url))) if names == "title" else decoded(last_segment(url))
    return safe_name(F.regexp_replace(raw, KNOWN_EXTENSIONS, ""))


def plan_files(docs: DataFrame, profile: Profile, order: list[str]) -> DataFrame:
    """The files a profile takes: url, title, entry, type, release, filter, path (without extension); one row per address.

    An address listed by several entries counts where it comes first in `order`. Addresses to skip are left out.
    """
    taken = matched(docs, profile).where(F.col("filter").isNotNull())
    if profile.skip:
        taken = taken.where(~F.col("url").isin(*profile.skip))
    once = first_wins(taken.select("url", "title", "entry", "type", "release", "filter", *order), ["url"], [F.col(c) for c in order])
    chain = lambda pick: F.get(F.array(*[F.lit(pick(f)) for f in profile.filters]), F.col("filter"))
    template = chain(lambda f: f.into or profile.folders) if profile.filters else F.lit(profile.folders)
    origin = chain(lambda f: f.origin) if profile.filters else F.lit("")
    folder = folder_of(template, F.col("entry"), F.col("type"), F.col("release"), origin)
    return once.select("url", "title", "entry", "type", "release", "filter", F.concat_ws("/", F.nullif(folder, F.lit("")), base_name(F.col("title"), F.col("url"), profile.names)).alias("path"))


def path_collisions(plan: DataFrame) -> DataFrame:
    """Paths that more than one address of a plan would be written to."""
    return plan.groupBy("path").agg(F.count("*").alias("n"), F.min("url").alias("first_url")).where(F.col("n") > 1)
