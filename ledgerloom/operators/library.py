"""A local library: plan against lock, observed files against lock, what to do with each file, details and history."""

from __future__ import annotations

import shutil
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty


def check_files(lock: DataFrame, disk: DataFrame) -> DataFrame:
    """path, verdict: ok, changed, missing (locked, not there) or new (there, not locked). Both: path, sha256."""
    a, b = lock.select("path", F.col("sha256").alias("locked")), disk.select("path", F.col("sha256").alias("found"))
    joined = a.withColumn("_l", F.lit(True)).join(b.withColumn("_f", F.lit(True)), "path", "full_outer")
    verdict = F.when(F.col("_l").isNull(), "new").when(F.col("_f").isNull(), "missing").when(F.col("locked").eqNullSafe(F.col("found")), "ok").otherwise("changed")
    return joined.select("path", verdict.alias("verdict"))


def unchanged_upstream(head: str, lock: str) -> Column:
    """Whether the headers of a HEAD request say that nothing changed: same etag, else same date and size."""
    h, k = (lambda c: F.col(f"{head}.{c}")), (lambda c: F.col(f"{lock}.{c}"))
    etag = (text_or_empty(k("etag")) != "") & (text_or_empty(h("etag")) == text_or_empty(k("etag")))
    dated = (text_or_empty(k("last_modified")) != "") & (h("last_modified") == k("last_modified")) & (h("content_length") == k("bytes"))
    return F.coalesce((h("head_status") == 200) & (etag | dated), F.lit(False))


def sync_decisions(plan: DataFrame, lock: DataFrame, observed: DataFrame) -> DataFrame:
    """url, path, decision for each planned file, and for each locked file that no plan takes any more.

    same: the server says unchanged and the file is there, or the content is the locked one. failed: the fetch didn't
    answer 200. updated: locked with other content. new: not locked. dropped: locked, no longer planned. A file keeps the
    path it was locked with. plan: url, path. lock: url, path, sha256, bytes, etag, last_modified. observed: url,
    head_status, etag, last_modified, content_length, status, sha256, on_disk.
    """
    p, k, o = plan.select("url", "path").alias("p"), lock.alias("k"), observed.alias("o")
    joined = p.join(k, F.col("p.url") == F.col("k.url"), "left").join(o, F.col("p.url") == F.col("o.url"), "left")
    locked = F.col("k.url").isNotNull()
    same_content = locked & (F.col("o.sha256") == F.col("k.sha256")) & F.coalesce(F.col("o.on_disk"), F.lit(False))
    decision = (
        F.when(locked & F.coalesce(F.col("o.on_disk"), F.lit(False)) & unchanged_upstream("o", "k"), "same")
        .when(~F.coalesce(F.col("o.status") == 200, F.lit(False)), "failed")
        .when(F.coalesce(same_content, F.lit(False)), "same")
        .when(locked, "updated")
        .otherwise("new")
    )
    kept = joined.select(F.col("p.url").alias("url"), F.coalesce(F.col("k.path"), F.col("p.path")).alias("path"), decision.alias("decision"))
    dropped = lock.select("url", "path").join(plan.select("url"), "url", "left_anti").select("url", "path", F.lit("dropped").alias("decision"))
    return kept.unionByName(dropped)


def tally(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count("*").alias("n")).orderBy("decision")


def next_lock(lock: DataFrame, decisions: DataFrame, fetched: DataFrame, today: str) -> DataFrame:
    """The lock after an update: new and updated files take what was fetched, an updated one keeps its earlier versions.

    lock: url, path, sha256, bytes, title, last_modified, fetched, earlier (array of struct(sha256, bytes,
    last_modified, fetched)), and etag if both tables have it. fetched: url, sha256, bytes, title, last_modified. Dropped files leave; failed and same
    files stay as they were.
    """
    d = decisions.where("decision <> 'dropped'").select("url", "path", "decision")
    joined = d.alias("d").join(lock.alias("k"), F.col("d.url") == F.col("k.url"), "left").join(fetched.alias("f"), F.col("d.url") == F.col("f.url"), "left")
    fresh = F.col("d.decision").isin("new", "updated")
    pick = lambda c: F.when(fresh, F.col(f"f.{c}")).otherwise(F.col(f"k.{c}")).alias(c)
    was = F.array(F.struct(F.col("k.sha256").alias("sha256"), F.col("k.bytes").alias("bytes"), F.col("k.last_modified").alias("last_modified"), F.col("k.fetched").alias("fetched")))
    none = F.array().cast("array<struct<sha256:string,bytes:bigint,last_modified:string,fetched:string>>")
    earlier = F.when(F.col("d.decision") == "updated", F.concat(F.coalesce(F.col("k.earlier"), none), was)).otherwise(F.coalesce(F.col("k.earlier"), none))
    return joined.where(fresh | F.col("k.url").isNotNull()).select(
        F.col("d.url").alias("url"), F.col("d.path").alias("path"), *[pick(c) for c in ("sha256", "bytes", "title", "etag", "last_modified") if c in lock.columns and c in fetched.columns],
        F.when(fresh, F.lit(today)).otherwise(F.col("k.fetched")).alias("fetched"), earlier.alias("earlier"),
    )


def remote_verdicts(lock: DataFrame, heads: DataFrame) -> DataFrame:
    """url, verdict: ok, upstream (changed there) or unreachable, which doesn't fail a check."""
    joined = lock.alias("k").join(heads.alias("o"), F.col("k.url") == F.col("o.url"), "left")
    verdict = F.when(~F.coalesce(F.col("o.head_status") == 200, F.lit(False)), "unreachable").when(unchanged_upstream("o", "k"), "ok").otherwise("upstream")
    return joined.select(F.col("k.url").alias("url"), verdict.alias("verdict"))


def stale_details(lock: DataFrame, details: DataFrame) -> DataFrame:
    """Locked files whose card is missing or of another content: the only ones to be read again."""
    return lock.select("path", "sha256").join(details.select("path", "sha256"), ["path", "sha256"], "left_anti")


def history_entry(decisions: DataFrame, today: str, notes: str = "") -> DataFrame:
    """One history row per file that changed: day, path, what, notes; files that stayed the same leave none."""
    return decisions.where("decision <> 'same'").select(F.lit(today).alias("day"), "path", F.col("decision").alias("what"), F.lit(notes).alias("notes"))


def moved_aside(decisions: DataFrame, how: str, today: str) -> DataFrame:
    """Where the superseded copies go: archive folder, beside the file, or nowhere (deleted): path, target."""
    stem, ext = F.regexp_replace("path", r"\.[^./]*$", ""), F.regexp_extract("path", r"(\.[^./]*)$", 1)
    dated = F.concat(stem, F.lit(f" ({today})"), ext)
    target = {"archive": F.concat(F.lit(".library/archive/"), dated), "keep": dated, "delete": F.lit(None).cast("string")}[how]
    return decisions.where("decision IN ('updated', 'dropped')").select("path", target.alias("target"))


def set_aside(root: str | Path, moves: DataFrame) -> int:
    """Moves or deletes a library's superseded files as `moved_aside` says, by the workers; returns how many were there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = 0
            for path, target in zip(batch["path"], batch["target"]):
                file = Path(root) / path
                if not file.exists():
                    continue
                done += 1
                if target is None:
                    file.unlink()
                else:
                    goal = Path(root) / target
                    goal.parent.mkdir(parents=True, exist_ok=True)
                    shutil.move(file, goal)
            yield pd.DataFrame({"n": [done]})

    return moves.select("path", "target").mapInPandas(run, "n int").agg(F.sum("n")).head()[0] or 0


def copy_snapshots(pages: DataFrame, names: list[str], default_site: str = "docs-site") -> DataFrame:
    """The snapshot pages a profile names, with or without their site; names that don't exist are passed over."""
    wanted = [n if "/" in n else f"{default_site}/{n}" for n in names]
    return pages.where(F.col("name").isin(*wanted)) if wanted else pages.limit(0)
