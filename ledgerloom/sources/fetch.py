"""Fetching pages behind a small interface, with retries, pacing, a page store and bounded redirects."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.links import join_url, refresh_target

RAW = "url string, status int, final_url string, content_type string, etag string, last_modified string, body string, tries int, throttled boolean"


class Answer(NamedTuple):
    """What came of a request; status 0 is a connection that failed."""

    status: int
    final_url: str = ""
    content_type: str = ""
    etag: str = ""
    last_modified: str = ""
    body: str = ""
    retry_after: str = ""
    tries: int = 1
    throttled: bool = False


class Fetcher(Protocol):
    def __call__(self, url: str) -> Answer: ...


class FixtureFetcher:
    """Answers from a mapping; 404 for what it doesn't hold. Needs no network."""

    def __init__(self, pages: dict[str, Answer | str]) -> None:
        self.pages = pages

    def __call__(self, url: str) -> Answer:
        page = self.pages.get(url)
        return Answer(404, url) if page is None else page if isinstance(page, Answer) else Answer(200, url, "text/html", body=page)


def network_fetcher(timeout: float = 60.0) -> Fetcher:
    """The live fetcher, over urllib."""
    import urllib.error
    import urllib.request

    def fetch(url: str) -> Answer:
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                h = r.headers
                return Answer(r.status, r.url, h.get("Content-Type", ""), h.get("ETag", ""), h.get("Last-Modified", ""), r.read().decode("utf-8", "replace"))
        except urllib.error.HTTPError as e:
            return Answer(e.code, url, retry_after=e.headers.get("Retry-After", ""))
        except OSError:
            return Answer(0, url)

    return fetch


@dataclass
class Pace:
    """The wait between requests: doubled when a site pushes back, eased after a run of answers, gone when small."""

    delay: float = 0.0
    calm: int = 0
    least: float = 0.5
    most: float = 15.0
    eased_after: int = 20

    def pushed_back(self) -> None:
        self.delay, self.calm = min(self.most, max(self.least, self.delay * 2)), 0

    def answered(self) -> None:
        self.calm += 1
        if self.calm >= self.eased_after:
            self.calm, self.delay = 0, self.delay * 0.7
            if self.delay < 0.1:
                self.delay = 0.0


@dataclass
class Patient:
    """A fetcher that tries again on 429, 5xx and lost connections; other 4xx are answers. It never raises."""

    fetch: Fetcher
    tries: int = 4
    sleep: Callable[[float], None] = time.sleep
    pace: Pace = field(default_factory=Pace)

    def __call__(self, url: str) -> Answer:
        answer, throttled = Answer(0, url), False
        for attempt in range(self.tries):
            if self.pace.delay:
                self.sleep(self.pace.delay)
            try:
                answer = self.fetch(url)
            except Exception:  # noqa: BLE001
                answer = Answer(0, url)
            if answer.status and answer.status != 429 and answer.status < 500:
                self.pace.answered()
                return answer._replace(tries=attempt + 1, throttled=throttled)
            self.pace.pushed_back()
            throttled = throttled or answer.status == 429
            if attempt + 1 < self.tries:
                wait = float(answer.retry_after) if answer.retry_after.isdigit() else 5.0 * 2**attempt
                self.sleep(min(120.0, wait))
        return answer._replace(tries=self.tries, throttled=throttled)


def fetch_all(urls: DataFrame, fetcher: Callable[[], Fetcher], workers: int = 3, url: str = "url") -> DataFrame:
    """Raw pages of distinct addresses, at most `workers` requests at a time; one more pass over those that failed.

    `fetcher` makes the fetcher in each worker.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = fetcher()
        for batch in batches:
            rows = []
            for u in batch["url"]:
                a = get(u)
                rows.append((u, a.status, a.final_url or u, a.content_type, a.etag, a.last_modified, a.body, a.tries, a.throttled))
            yield pd.DataFrame(rows, columns=[f.split(" ")[0] for f in RAW.split(", ")])

    wanted = urls.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    return wanted.repartition(workers).mapInPandas(run, RAW)


def fetch_missing(spark: SparkSession, store: str, urls: DataFrame, fetcher: Callable[[], Fetcher], workers: int = 3) -> DataFrame:
    """Pages by way of a store: only addresses it holds no good page of are fetched, and good pages are added to it.

    A run that broke off goes on from what was stored.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    held = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    kept = spark.read.schema(RAW).parquet(store) if held else spark.createDataFrame([], RAW)
    wanted = urls.select("url").distinct()
    fresh = fetch_all(wanted.join(kept.select("url"), "url", "left_anti"), fetcher, workers)
    for again in (False, True):
        part = fresh if not again else fetch_all(wanted.join(spark.read.schema(RAW).parquet(store).select("url"), "url", "left_anti"), fetcher, 1)
        part.where((F.col("status") == 200) & (F.col("body") != "")).write.mode("append").parquet(store)
    return spark.read.schema(RAW).parquet(store).join(wanted, "url", "left_semi")


def clear_store(spark: SparkSession, store: str) -> None:
    """Forgets the stored pages, once their scan has been published."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def network_counters(raw: DataFrame) -> dict[str, int]:
    """pages, failed, retried and throttled of raw pages."""
    n = raw.agg(
        F.count("*").alias("pages"), F.count_if(F.col("status") != 200).alias("failed"), F.count_if(F.col("tries") > 1).alias("retried"), F.count_if(F.col("throttled")).alias("throttled")
    )
    return n.head().asDict()


def sitemap_urls(raw: DataFrame, body: str = "body") -> DataFrame:
    """Every <loc> of sitemap bodies; an empty result is an error, since the scan would lose everything."""
    found = raw.select(F.explode(F.regexp_extract_all(F.col(body), F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("url")).distinct()
    if found.isEmpty():
        raise ValueError("the sitemap lists nothing")
    return found


def resolve_guides(urls: DataFrame, raw: DataFrame, hops: int = 4, wanted: str = r"/downloads/[^/]+\.pdf") -> DataFrame:
    """url, target: where guides lead over at most `hops` refresh redirects and the first download link; else themselves.

    A fixed number of joins with the page table; raw: url, body.
    """
    pages = raw.select(F.col("url").alias("at"), "body")
    now = urls.select("url", F.col("url").alias("at"), F.lit(None).cast("string").alias("target"))
    for _ in range(hops):
        seen = now.join(pages, "at", "left")
        link = F.regexp_extract(F.coalesce("body", F.lit("")), rf"""href=["']([^"']*{wanted})["']""", 1)
        base = F.when(F.col("at").endswith("/"), F.col("at")).otherwise(F.concat("at", F.lit("/")))
        moved = refresh_target(F.col("body"))
        now = seen.select(
            "url",
            F.when(F.col("target").isNull() & (moved != ""), join_url(base, moved)).otherwise(F.col("at")).alias("at"),
            F.coalesce("target", F.when(link != "", join_url(base, link))).alias("target"),
        )
    return now.select("url", F.coalesce("target", "url").alias("target"))
