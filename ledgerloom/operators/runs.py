"""Whole runs over the single operators: crawling a site into a published scan, updating a library, rebuilding what is shown."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import file_extension
from ledgerloom.functions.urls import canonical, extension
from ledgerloom.operators import library, profiles
from ledgerloom.operators.ledger import VersionStore
from ledgerloom.operators.reporting import explorer_rows, render_last_scan, render_report, replace_block
from ledgerloom.operators.scan import scan_docs
from ledgerloom.session import cut_lineage
from ledgerloom.sources.fetch import Fetcher, clear_store, fetch_missing, network_counters
from ledgerloom.sources.files import file_cards, load_lock, save_lock
from ledgerloom.sources.html import read_archive, read_docs_pages, read_index

LOCK = (
    "url string, path string, sha256 string, bytes bigint, title string, etag string, last_modified string, fetched string, "
    "earlier array<struct<sha256:string,bytes:bigint,last_modified:string,fetched:string>>"
)
HEADS = "url string, head_status int, etag string, last_modified string, content_length bigint"
FETCHED = "url string, status int, content_type string, etag string, last_modified string, sha256 string, bytes bigint, start binary"
OWN = ".library"


class Reply(NamedTuple):
    """What a server says of a file, and the file itself where it was asked for; status 0 is a connection that failed."""

    status: int
    content: bytes = b""
    content_type: str = ""
    etag: str = ""
    last_modified: str = ""
    length: int = -1


class FileServer(Protocol):
    def __call__(self, url: str, head: bool = False) -> Reply: ...


def network_files(timeout: float = 120.0) -> FileServer:
    """The live server of files, over urllib."""
    import urllib.error
    import urllib.request

    def ask(url: str, head: bool = False) -> Reply:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, method="HEAD" if head else "GET"), timeout=timeout) as r:  # noqa: S310
                h = r.headers
                return Reply(r.status, b"" if head else r.read(), h.get("Content-Type", ""), h.get("ETag", ""), h.get("Last-Modified", ""), int(h.get("Content-Length") or -1))
        except urllib.error.HTTPError as e:
            return Reply(e.code)
        except OSError:
            return Reply(0)

    return ask


def heads_of(urls: DataFrame, server: Callable[[], FileServer], workers: int = 3) -> DataFrame:
    """url, head_status, etag, last_modified, content_length of distinct addresses; `server` makes the server in each worker."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = server()
        for batch in batches:
            said = [(u, ask(u, head=True)) for u in batch["url"]]
            yield pd.DataFrame([(u, r.status, r.etag, r.last_modified, r.length) for u, r in said], columns=["url", "head_status", "etag", "last_modified", "content_length"])

    return urls.select("url").where("url IS NOT NULL").distinct().repartition(workers).mapInPandas(run, HEADS)


def incoming(root: str | Path, url: str) -> Path:
    return Path(root) / OWN / "incoming" / hashlib.sha1(url.encode(), usedforsecurity=False).hexdigest()


def downloads(urls: DataFrame, server: Callable[[], FileServer], root: str | Path, workers: int = 3) -> DataFrame:
    """What came of each distinct address; good files are put into the library's incoming folder, which all workers share.

    A task that runs again writes the same names again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = server()
        for batch in batches:
            rows = []
            for u in batch["url"]:
                r = ask(u)
                if r.status == 200:
                    place = incoming(root, u)
                    place.parent.mkdir(parents=True, exist_ok=True)
                    draft = place.with_suffix(f".{os.getpid()}")
                    draft.write_bytes(r.content)
                    draft.replace(place)
                digest = hashlib.sha256(r.content).hexdigest() if r.status == 200 else None
                rows.append((u, r.status, r.content_type, r.etag, r.last_modified, digest, len(r.content), r.content[:8]))
            yield pd.DataFrame(rows, columns=[f.split(" ")[0] for f in FETCHED.split(", ")])

    return urls.select("url").where("url IS NOT NULL").distinct().repartition(workers).mapInPandas(run, FETCHED)


def _on_disk(root: str | Path):  # noqa: ANN202
    return F.pandas_udf(lambda paths: paths.map(lambda p: p is not None and (Path(root) / p).is_file()), "boolean")


def _content(root: str | Path):  # noqa: ANN202
    return F.pandas_udf(lambda paths: paths.map(lambda p: (Path(root) / p).read_bytes() if p and (Path(root) / p).is_file() else None), "binary")


def put_in_place(root: str | Path, decisions: DataFrame) -> int:
    """Moves fetched files from the incoming folder to their paths, by the workers; how many there were."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = 0
            for url, path in zip(batch["url"], batch["path"]):
                goal = Path(root) / path
                goal.parent.mkdir(parents=True, exist_ok=True)
                if incoming(root, url).exists():
                    shutil.move(incoming(root, url), goal)
                done += goal.exists()
            yield pd.DataFrame({"n": [done]})

    return decisions.select("url", "path").mapInPandas(run, "n int").agg(F.sum("n")).head()[0] or 0


def planned(docs: DataFrame, profile: profiles.Profile, lock: DataFrame, order: list[str]) -> DataFrame:
    """url, path, decision of a dry run: what is locked already, what would be new, and what would be dropped."""
    plan = profiles.plan_files(docs, profile, order)
    held = plan.join(lock.select("url", F.col("path").alias("_locked")), "url", "left")
    kept = held.select("url", F.coalesce("_locked", "path").alias("path"), F.when(F.col("_locked").isNotNull(), "locked").otherwise("new").alias("decision"))
    return kept.unionByName(lock.select("url", "path").join(plan.select("url"), "url", "left_anti").withColumn("decision", F.lit("dropped")))


def update_library(
    spark: SparkSession, docs: DataFrame, profile: profiles.Profile, root: str | Path, server: Callable[[], FileServer], today: str, order: list[str], superseded: str = "archive", keep_dropped: bool = False
) -> dict[str, int]:
    """Brings a library in step with what a profile takes: how many files came out as same, new, updated, failed and dropped.

    Files the servers say are unchanged are not fetched. Superseded and dropped copies go aside as `superseded` says before
    new ones take their place; with keep_dropped=True dropped files stay locked. The lock is written last, so a run that
    breaks off is simply run again. Cards are made of changed files only, and the history gets one row per change.
    """
    lock_path, details_path = f"{root}/{OWN}/lock", f"{root}/{OWN}/details"
    lock = cut_lineage(load_lock(spark, lock_path, LOCK))
    plan = cut_lineage(profiles.plan_files(docs, profile, order).select("url", "path", "title"))
    held = cut_lineage(lock.select("url", _on_disk(root)("path").alias("on_disk")))
    heads = cut_lineage(heads_of(plan.join(lock.select("url"), "url", "left_semi"), server))
    calm = heads.alias("o").join(lock.alias("k"), F.col("o.url") == F.col("k.url")).where(library.unchanged_upstream("o", "k")).select(F.col("o.url").alias("url"))
    calm = calm.join(held.where("on_disk").select("url"), "url", "left_semi")
    got = cut_lineage(downloads(plan.join(calm, "url", "left_anti"), server, root))
    observed = plan.select("url").join(heads, "url", "left").join(got.select("url", "status", "sha256"), "url", "left").join(held, "url", "left")
    ext = file_extension(F.col("content_type"), F.col("start"), extension(F.col("url")))
    files = plan.join(got.select("url", "content_type", "start"), "url", "left").select("url", F.concat("path", ext).alias("path"))
    decisions = cut_lineage(library.sync_decisions(files, lock, observed))
    if keep_dropped:
        decisions = decisions.withColumn("decision", F.when(F.col("decision") == "dropped", "same").otherwise(F.col("decision")))
    library.set_aside(root, library.moved_aside(decisions, superseded, today))
    put_in_place(root, decisions.where("decision IN ('new', 'updated')"))
    after = cut_lineage(library.next_lock(lock, decisions, got.join(plan.select("url", "title"), "url"), today))
    details = cut_lineage(load_lock(spark, details_path, "path string, sha256 string, card string"))
    stale = library.stale_details(after, details)
    cards = file_cards(stale.withColumn("content", _content(root)("path"))).select("path", F.to_json(F.struct("card", "features")).alias("card"))
    kept = details.join(after.select("path", "sha256"), ["path", "sha256"], "left_semi")
    save_lock(cut_lineage(kept.unionByName(stale.select("path", "sha256").join(cards, "path"))), details_path)
    changed = library.history_entry(decisions.where("decision <> 'failed'"), today)
    if not changed.isEmpty():
        changed.orderBy("path").write.mode("append").json(f"{root}/{OWN}/history/{today}")
    save_lock(after, lock_path)
    shutil.rmtree(Path(root) / OWN / "incoming", ignore_errors=True)
    return {r["decision"]: r["n"] for r in library.tally(decisions).collect()}


def check_remote(lock: DataFrame, server: Callable[[], FileServer]) -> DataFrame:
    """url, verdict of every locked file against its server: ok, upstream or unreachable."""
    heads = heads_of(lock, server).select("url", "head_status", "etag", "last_modified", "content_length")
    return library.remote_verdicts(lock, heads)


def crawl_docs(
    spark: SparkSession, pages: str, index_url: str, wanted: str, hosts: dict[str, list[str]], fetcher: Callable[[], Fetcher], site_suffix: str = "",
    archive_url: str = "/support/release-notes/", archive_wanted: str = "/release-notes/product/", clock: Callable[[], float] = time.time,
) -> tuple[dict[str, DataFrame], list[dict]]:
    """The tables of a documentation site's scan, fetched by way of the page store `pages`, and what each step took.

    Steps: the index with the archive's menu, the pages it names, the pages their release menus name, the archive pages. A
    step's row has step, seconds and the network's counters.
    """
    from urllib.parse import urljoin

    steps, menu_url = [], urljoin(index_url, archive_url)

    def step(name: str, urls: DataFrame) -> DataFrame:
        began = clock()
        asked = urls.select("url").where("url IS NOT NULL").distinct()
        got = cut_lineage(fetch_missing(spark, pages, asked, fetcher))
        steps.append({"step": name, **network_counters(got), "seconds": round(clock() - began, 3)})
        lost = asked.join(got.select("url"), "url", "left_anti").select("url", F.lit(0).alias("status"), F.lit(None).cast("string").alias("body"))
        steps[-1]["failed"] = lost.count()
        steps[-1]["pages"] += steps[-1]["failed"]
        return got.select("url", "status", "body").unionByName(lost)

    first = step("index", spark.createDataFrame([(index_url,), (menu_url,)], "url string"))
    entries = read_index(first.where(F.col("url") == index_url), wanted).select(canonical(F.col("url")).alias("url")).distinct()
    homes = step("entries", entries)
    options = read_docs_pages(homes.where("status = 200"), wanted, site_suffix).select(F.explode("doc.options").alias("o")).select(canonical(F.col("o.url")).alias("url")).distinct()
    releases = step("releases", options.join(entries, "url", "left_anti"))
    archive = step("archive", read_archive(first.where(F.col("url") == menu_url), archive_wanted).select(canonical(F.col("url")).alias("url")).distinct())
    raw = first.where((F.col("url") != menu_url) | (F.col("status") == 200)).unionByName(homes).unionByName(releases).unionByName(archive)
    return scan_docs(raw, index_url, wanted, hosts, site_suffix, archive_url, archive_wanted), steps


def finish_crawl(spark: SparkSession, pages: str) -> None:
    """Empties the page store after its scan has been published; a crawl that broke off finds its pages there again."""
    clear_store(spark, pages)


def refresh(store: VersionStore, meta: dict, keys: dict[str, list[str]], shown: dict[str, list[str]], out: str | Path, readme: str | Path | None = None, documents: DataFrame | None = None) -> dict[str, bool]:
    """Everything that is generated, built anew from the newest stored version: the report, the block about the last scan, the explorer's rows.

    Which of them were written. The report says what changed since the version before.
    """
    from ledgerloom.operators.ledger import catalog_changes, change_summary

    folder, versions, done = Path(out), store.versions(), {}
    folder.mkdir(parents=True, exist_ok=True)
    summary: list[dict] = []
    if len(versions) > 1:
        for name, key in keys.items():
            rows = catalog_changes(store.read(name, versions[-2]), store.read(name, versions[-1]), key, shown[name], versions[-2], versions[-1])
            summary += [r.asDict() for r in change_summary(rows.select(F.lit(name).alias("ledger"), "change")).orderBy("ledger", "change").collect()]
    if versions:
        (folder / "report.md").write_text(render_report({"summary": summary, "to_check": [], "catalog": []}, versions[-1]), encoding="utf-8")
    done["report"] = bool(versions)
    done["last scan"] = replace_block(readme, "last-scan", render_last_scan(meta)) if readme else False
    if documents is not None:
        explorer_rows(documents).write.mode("overwrite").json(str(folder / "explorer"))
    done["explorer"] = documents is not None
    (folder / "refreshed.json").write_text(json.dumps(done, indent=1), encoding="utf-8")
    return done
