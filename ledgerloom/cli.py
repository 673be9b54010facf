"""Command line: scan, crawl, due, compare, refresh, plan, update, check over a versioned catalog."""

from __future__ import annotations

import argparse
import datetime as dt
import json
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import library, profiles, runs
from ledgerloom.operators.ledger import VersionStore, catalog_changes, change_summary, guard, merge_ledger, merge_meta, scan_due
from ledgerloom.operators.reporting import render_report, write_rows
from ledgerloom.session import build_session
from ledgerloom.sources.fetch import Fetcher, Patient, network_fetcher
from ledgerloom.sources.files import library_files, load_lock, load_yaml, starter_profiles

META = "last-scan.json"


def read_meta(root: str, store: VersionStore | None = None) -> dict:
    """What the last scans left. A root on another file system needs a session, which is started if none is given."""
    if store is None and "://" in root:
        store = VersionStore(build_session(), root)
    if store is not None:
        return store.read_json(META, {})
    file = Path(root) / META
    return json.loads(file.read_text(encoding="utf-8")) if file.exists() else {}


def due(root: str, today: str, sites: list[str], after: int) -> tuple[bool, str]:
    return scan_due(today, read_meta(root).get("scanned") or {}, sites, after)


def publish_scan(store: VersionStore, today: str, deliveries: dict, keys: dict[str, list[str]], site: str, allow_shrink: bool = False, watched: dict | None = None, timing: dict | None = None) -> dict[str, int]:
    """All deliveries of a scan merged and published together; every guard is asked before anything is written.

    deliveries: table name -> rows with an `ord` column. watched: name -> pages with their status, which are guarded and
    counted but not written. Returns how many rows each ledger and how many pages each watched table has.
    """
    spark, merged, counts = store.spark, {}, {}
    last = (read_meta(store.root, store).get("counts") or {}).get(site) or {}
    for name, pages in (watched or {}).items():
        counts[name], failed = pages.agg(F.count("*"), F.count_if(F.col("status") != 200)).head()
        guard(name, counts[name], last.get(name), failed, allow=allow_shrink)
    for name, new in deliveries.items():
        values = [c for c in new.columns if c not in ("ord", "first_seen", "last_seen")]
        schema = ", ".join(f"`{c}` {new.schema[c].dataType.simpleString()}" for c in values) + ", first_seen string, last_seen string"
        try:
            old = store.read(name)
        except (LookupError, KeyError):
            old = spark.createDataFrame([], schema)
        newest = old.agg(F.max("last_seen")).head()[0]
        before = old.where(F.col("last_seen") == newest).count() if newest else None
        guard(name, new.count(), before, allow=allow_shrink)
        merged[name] = merge_ledger(old, new, keys[name], today, [F.col("ord")])
    store.publish(today, merged)
    for name in merged:
        counts[name] = store.read(name).count()
    store.write_json(META, merge_meta(read_meta(store.root, store), {site: counts}, [site], today, timing))
    return counts


def compare(store: VersionStore, a: str, b: str, keys: dict[str, list[str]], shown: dict[str, list[str]]):  # noqa: ANN201
    """ledger, change, n between two versions."""
    union = None
    for name, key in keys.items():
        rows = catalog_changes(store.read(name, a), store.read(name, b), key, shown[name], a, b).select(F.lit(name).alias("ledger"), "change")
        union = rows if union is None else union.unionByName(rows)
    return change_summary(union)


def crawl(spark: SparkSession, args: argparse.Namespace, fetcher: Callable[[], Fetcher]) -> dict[str, int]:
    """A crawl's tables, guarded, merged and published; the page store is emptied once the version stands."""
    tables, steps = runs.crawl_docs(spark, args.pages, args.index_url, args.wanted, json.loads(args.hosts), fetcher)
    keys = {"pages": ["page"], "listings": ["url", "page"], "release-notes": ["archive_page", "url"]}
    found = {"pages": tables["pages"].withColumn("ord", F.lit(0)), "listings": tables["listings"], "release-notes": tables["release-notes"]}
    watched = {"docs_pages": tables["pages"].select("page", "status"), "archive_pages": tables["archive_pages"]}
    counts = publish_scan(VersionStore(spark, args.root), args.today, found, keys, args.site, args.allow_shrink, watched, {"steps": steps})
    runs.finish_crawl(spark, args.pages)
    return counts


def main(argv: Sequence[str] | None = None, fetcher: Callable[[], Fetcher] = lambda: Patient(network_fetcher()), server: Callable[[], runs.FileServer] = runs.network_files) -> int:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("due", help="whether another scan is due")
    p.add_argument("root")
    p.add_argument("--sites", nargs="+", required=True)
    p.add_argument("--after", type=int, default=30)
    p.add_argument("--today", default=dt.date.today().isoformat())
    p = commands.add_parser("scan", help="merge deliveries (parquet files named by ledger) and publish a version")
    p.add_argument("root")
    p.add_argument("deliveries")
    p.add_argument("--site", required=True)
    p.add_argument("--keys", required=True, help='JSON: {"listings": ["url", "page"]}')
    p.add_argument("--watched", nargs="*", default=[], help="deliveries with a status that are only guarded and counted: archive_pages")
    p.add_argument("--today", default=dt.date.today().isoformat())
    p.add_argument("--if-due", action="store_true")
    p.add_argument("--after", type=int, default=30)
    p.add_argument("--allow-shrink", action="store_true")
    p = commands.add_parser("compare", help="what changed between two versions")
    p.add_argument("root")
    p.add_argument("a")
    p.add_argument("b")
    p.add_argument("--keys", required=True)
    p.add_argument("--shown", required=True)
    p.add_argument("--report", help="write a Markdown report here")
    p.add_argument("--changes", help="write every changed row here, a table per ledger")
    p = commands.add_parser("plan", help="the files a profile takes from a document table")
    p.add_argument("documents")
    p.add_argument("profile")
    p.add_argument("--starters")
    p.add_argument("--out")
    p = commands.add_parser("crawl", help="fetch a documentation site, scan it and publish a version")
    p.add_argument("root")
    p.add_argument("pages", help="folder of fetched pages, from which a crawl that broke off goes on")
    p.add_argument("--site", required=True)
    p.add_argument("--index-url", required=True)
    p.add_argument("--wanted", required=True, help="pattern of documentation pages' addresses")
    p.add_argument("--hosts", required=True, help='JSON: {"own_hosts": [], "portal_hosts": [], "hub_hosts": []}')
    p.add_argument("--today", default=dt.date.today().isoformat())
    p.add_argument("--allow-shrink", action="store_true")
    p = commands.add_parser("refresh", help="build the report, the block about the last scan and the explorer's rows anew")
    p.add_argument("root")
    p.add_argument("out")
    p.add_argument("--keys", required=True)
    p.add_argument("--shown", required=True)
    p.add_argument("--readme")
    p.add_argument("--documents")
    p = commands.add_parser("update", help="bring a library in step with what a profile takes")
    p.add_argument("documents")
    p.add_argument("profile")
    p.add_argument("library")
    p.add_argument("--starters")
    p.add_argument("--today", default=dt.date.today().isoformat())
    p.add_argument("--superseded", choices=("archive", "keep", "delete"), default="archive")
    p.add_argument("--keep-dropped", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p = commands.add_parser("check", help="a library folder against its lock")
    p.add_argument("library")
    p.add_argument("lock")
    p.add_argument("--out", help="write every verdict here")
    p.add_argument("--remote", action="store_true", help="ask the servers whether locked files have changed there")
    args = parser.parse_args(argv)

    if args.command == "due":
        is_due, why = due(args.root, args.today, args.sites, args.after)
        print(why)
        return 0 if is_due else 1
    spark = build_session()
    if args.command == "scan":
        if args.if_due and not due(args.root, args.today, [args.site], args.after)[0]:
            print("not due")
            return 0
        keys = json.loads(args.keys)
        found = {n: spark.read.parquet(f"{args.deliveries}/{n}.parquet") for n in keys}
        watched = {n: spark.read.parquet(f"{args.deliveries}/{n}.parquet") for n in args.watched}
        print(json.dumps(publish_scan(VersionStore(spark, args.root), args.today, found, keys, args.site, args.allow_shrink, watched)))
        return 0
    if args.command == "compare":
        summary = compare(VersionStore(spark, args.root), args.a, args.b, json.loads(args.keys), json.loads(args.shown))
        if args.changes:
            store, shown = VersionStore(spark, args.root), json.loads(args.shown)
            for name, key in json.loads(args.keys).items():
                write_rows(catalog_changes(store.read(name, args.a), store.read(name, args.b), key, shown[name], args.a, args.b), f"{args.changes}/{name}")
        rows = [r.asDict() for r in summary.orderBy("ledger", "change").collect()]
        print(json.dumps(rows))
        if args.report:
            Path(args.report).write_text(render_report({"summary": rows, "to_check": [], "catalog": []}, args.b), encoding="utf-8")
        return 0
    if args.command == "plan":
        profile = profiles.load_profile(load_yaml(args.profile, {}), starter_profiles(args.starters) if args.starters else {})
        plan = profiles.plan_files(spark.read.parquet(args.documents), profile, ["pos"])
        if args.out:
            plan.write.mode("overwrite").parquet(args.out)
        else:
            plan.orderBy("path", "url").show(100, truncate=False)
        return 0
    if args.command == "crawl":
        print(json.dumps(crawl(spark, args, fetcher)))
        return 0
    if args.command == "refresh":
        documents = spark.read.parquet(args.documents) if args.documents else None
        print(json.dumps(runs.refresh(VersionStore(spark, args.root), read_meta(args.root), json.loads(args.keys), json.loads(args.shown), args.out, args.readme, documents)))
        return 0
    if args.command == "update":
        profile = profiles.load_profile(load_yaml(args.profile, {}), starter_profiles(args.starters) if args.starters else {})
        docs = spark.read.parquet(args.documents)
        if args.dry_run:
            for r in runs.planned(docs, profile, load_lock(spark, f"{args.library}/{runs.OWN}/lock", runs.LOCK), ["pos"]).orderBy("path", "url").toLocalIterator():
                print(f"{r['decision']}: {r['path']}")
            return 0
        tally = runs.update_library(spark, docs, profile, args.library, server, args.today, ["pos"], args.superseded, args.keep_dropped)
        print(", ".join(f"{n} {d}" for d, n in sorted(tally.items())) or "nothing to do")
        return 1 if tally.get("failed") else 0
    if args.remote:
        verdicts = runs.check_remote(load_lock(spark, args.lock, runs.LOCK), server).withColumnRenamed("url", "path")
        if args.out:
            write_rows(verdicts, args.out)
            verdicts = spark.read.parquet(args.out)
        for r in verdicts.where("verdict <> 'ok'").orderBy("path").toLocalIterator():
            print(f"{r['verdict']}: {r['path']}")
        return 1 if verdicts.where("verdict = 'upstream'").count() else 0
    verdicts = library.check_files(spark.read.parquet(args.lock), library_files(spark, args.library))
    if args.out:
        write_rows(verdicts, args.out)
        verdicts = spark.read.parquet(args.out)
    n = {r["verdict"]: r["n"] for r in verdicts.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    print("files: " + ", ".join(f"{n.get(v, 0)} {v}" for v in ("ok", "missing", "changed", "new")))
    for r in verdicts.where("verdict <> 'ok'").orderBy("path").toLocalIterator():
        print(f"{r['verdict']}: {r['path']}")
    return 1 if set(n) - {"ok"} else 0


if __name__ == "__main__":
    raise SystemExit(main())
