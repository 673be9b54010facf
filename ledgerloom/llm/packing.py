"""Filling fixed-capacity containers with texts measured in tokens: fixed counts per length class, filled independently."""

from __future__ import annotations

import base64
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import cut_lineage

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splitting pattern that goes with the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Rows of one length that a task numbers at most, about.
NUMBERED_ROWS = 200_000


@lru_cache(maxsize=2)
def encoder(path: str):  # noqa: ANN201
    """The tokenizer of a rank file, built once per worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_lengths(documents: DataFrame, doc_id: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, tokens: the number of tokens of each whole text; 0 for NULL and empty ones."""
    id_type = documents.schema[doc_id].dataType.simpleString()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": [len(encode(t)) if t else 0 for t in batch["text"]]})

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(measure, f"doc_id {id_type}, tokens int")


def plan_containers(counts: dict[int, int], capacity: int, harmonic: bool = False) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns of containers, each a list of (slot length, count), with how many containers follow each.

    A pattern takes the longest slots that still fit, as many as fit, and is repeated until one of its lengths runs out;
    so there are at most about two patterns per length, however many texts there are. Harmonic patterns hold one slot
    length only, as many as fit.
    """
    left, lengths, patterns = dict(counts), sorted(n for n in counts if counts[n]), []
    if harmonic:
        for slot in lengths:
            fit = capacity // slot
            if whole := left[slot] // fit:
                patterns.append(([(slot, fit)], whole))
            if rest := left[slot] % fit:
                patterns.append(([(slot, rest)], 1))
        return patterns
    while lengths:
        room, pattern, at = capacity, [], len(lengths) - 1
        while at >= 0 and room > 0:
            slot = lengths[at]
            if taken := min(room // slot, left[slot]):
                pattern.append((slot, taken))
                room -= taken * slot
            at = min(at - 1, bisect_right(lengths, room) - 1)
        times = min(left[slot] // taken for slot, taken in pattern)
        patterns.append((pattern, times))
        for slot, taken in pattern:
            left[slot] -= taken * times
            if not left[slot]:
                lengths.pop(bisect_left(lengths, slot))
    return patterns


def segments_of(patterns: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """For each slot length, rows of (first rank, first container, count per container, offset in the container)."""
    used: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    first = 0
    for pattern, times in patterns:
        offset = 0
        for slot, taken in pattern:
            rank = used.get(slot, 0)
            rows.setdefault(slot, []).append((rank, first, taken, offset))
            used[slot] = rank + taken * times
            offset += taken * slot
        first += times
    return {slot: np.array(r, dtype=np.int64) for slot, r in rows.items()}


def _slot(tokens: Column, capacity: int, harmonic: bool) -> Column:
    return F.floor(capacity / F.floor(capacity / tokens)).cast("int") if harmonic else tokens


def pack(lengths: DataFrame, capacity: int = CAPACITY, harmonic: bool = False) -> DataFrame:
    """lengths(doc_id, tokens) -> doc_id, piece, first_token, tokens, container, offset.

    A text longer than the capacity is cut into full pieces and a rest; no other text is divided. Equal lengths are
    numbered across all workers (in buckets, whose counts are summed, so a length that a third of all texts share is
    spread), and number and pattern give the container. Only the counts per length reach the driver, at most one for
    each length up to the capacity. Texts without tokens need no room and get container NULL. Repeated ids are packed as
    often as they occur. An empty table gives no rows. harmonic=True uses reciprocal-capacity classes alone.
    """
    pieces = lengths.select("doc_id", F.col("tokens").alias("all")).where(F.col("all") > 0).select(
        "doc_id", "all", F.explode(F.sequence(F.lit(0), F.floor((F.col("all") - 1) / capacity).cast("int"))).alias("piece")
    )
    first = F.col("piece") * capacity
    pieces = pieces.select("doc_id", "piece", first.alias("first_token"), F.least(F.lit(capacity), F.col("all") - first).alias("tokens"))
    pieces = pieces.withColumn("slot", _slot(F.col("tokens"), capacity, harmonic))
    counts = {r["slot"]: r["n"] for r in pieces.groupBy("slot").agg(F.count("*").alias("n")).collect()}
    buckets = 8 + sum(counts.values()) // NUMBERED_ROWS
    segments = segments_of(plan_containers(counts, capacity, harmonic))

    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    sizes = pieces.groupBy("slot", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("slot").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("slot", "bucket", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("slot", "bucket").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("within", within).join(starts, ["slot", "bucket"]).withColumn("rank", F.col("start") + F.col("within"))

    @F.pandas_udf("container long, offset int")
    def placed(slot: pd.Series, rank: pd.Series) -> pd.DataFrame:
        container, offset = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        slots, ranks = slot.to_numpy(), rank.to_numpy()
        order = np.argsort(slots, kind="stable")
        cuts = np.flatnonzero(np.diff(slots[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows):
                table = segments[int(slots[rows[0]])]
                hit = table[np.searchsorted(table[:, 0], ranks[rows], side="right") - 1]
                behind = ranks[rows] - hit[:, 0]
                container[rows] = hit[:, 1] + behind // hit[:, 2]
                offset[rows] = hit[:, 3] + behind % hit[:, 2] * slots[rows]
        return pd.DataFrame({"container": container, "offset": offset})

    packed = ranked.withColumn("at", placed("slot", "rank")).select("doc_id", "piece", "first_token", "tokens", "at.container", "at.offset")
    bare = lengths.where(F.col("tokens") <= 0).select("doc_id", F.lit(0).alias("piece"), F.lit(0).alias("first_token"), F.lit(0).alias("tokens"), F.lit(None).cast("long").alias("container"), F.lit(0).alias("offset"))
    return packed.unionByName(bare)


def pack_texts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, harmonic: bool = False) -> DataFrame:
    """Texts of a table packed into containers; lengths are measured once and written to the checkpoint folder."""
    return pack(cut_lineage(token_lengths(documents, doc_id, text, tokenizer)), capacity, harmonic)
