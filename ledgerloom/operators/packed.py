"""Several values packed in one field: infer the delimiters of each source, then split and explode with position."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Candidate delimiters: name, pattern, and how likely a delimiter it is before anything was seen.
CANDIDATES: list[tuple[str, str, float]] = [
    ("comma", ",", 0.9),
    ("semicolon", ";", 0.9),
    ("bar", r"\|", 0.9),
    ("line", r"[\r\n\u2028\u2029\x0b\x0c\x85]+", 0.9),
    ("tab", r"\t", 0.9),
    ("spaced slash", r"\s/(?=\s|$)", 0.9),
    ("and", r"(?:\s|^)(?:and|or|&)(?=\s|$)", 0.8),
    ("bullet", "[•·]", 0.5),
    ("slash", r"(?<=\S)/(?=\S)", 0.1),
    ("hyphen", r"(?<=\S)-(?=\S)", 0.05),
    ("point", r"(?<=\w)\.(?=\w)", 0.05),
    ("colon", r":", 0.05),
    ("blank", r"(?<=\S)[ \xa0]+(?=\S)", 0.05),
]
PATTERNS = {name: re.compile(p, re.I) for name, p, _ in CANDIDATES}
PRIORS = {name: prior for name, _, prior in CANDIDATES}
#: Score from which a likely and an unlikely delimiter are accepted.
LIKELY_SCORE, UNLIKELY_SCORE = 0.5, 0.8
STRONG = [name for name, _, prior in CANDIDATES if prior >= 0.5]

_EDGE_BEFORE, _EDGE_AFTER = r"(?<![^\s,;|/&•·])", r"(?=$|[\s,;|/&•·])"
_QUOTED = (
    r'"(?:[^"]|"")*"(?!")'
    r"|'(?:[^']|''|'(?=\w))*'(?!')"
    r"|“[^”]*”|„[^“”]*[“”]|«[^»]*»|‘[^’]*’"
)
_PROTECTED = re.compile(rf"{_EDGE_BEFORE}(?:{_QUOTED}){_EDGE_AFTER}|\([^()]*(?:\([^()]*\)[^()]*)*\)|\[[^\[\]]*\]")
_WHOLE_QUOTED = re.compile(rf"(?:{_QUOTED})\Z", re.S)
_JOINING = re.compile(r"^(?:and|or|&)\s+|\s+(?:and|or|&)$", re.I)
_NOTHING = {"", "n/a", "-", "–", "—"}
_QUOTE_PLACE, _BRACKET_PLACE = "\ue000", "\ue001"


def masked(cell: str) -> str:
    """The cell with quoted and bracketed text blotted out, of the same length."""
    return _PROTECTED.sub(lambda m: (_BRACKET_PLACE if m[0][0] in "([" else _QUOTE_PLACE) * len(m[0]), cell)


def tidy(piece: str) -> str:
    """A piece as a value: trimmed, without enclosing quotes (a doubled quote is one), inner white space as one blank."""
    piece = piece.strip()
    if len(piece) > 1 and _WHOLE_QUOTED.match(piece):
        quote, piece = piece[0], piece[1:-1]
        if quote in "\"'":
            piece = piece.replace(quote * 2, quote)
    return " ".join(piece.split())


def split_cell(cell: str | None, delimiters: list[str]) -> list[str]:
    """The values of one cell in order. NULL, blank, N/A and - hold none; empty pieces are passed over."""
    if cell is None or " ".join(cell.split()).lower() in _NOTHING:
        return []
    cover, cuts = masked(cell), [(0, 0)]
    if delimiters:
        either = re.compile("|".join(f"(?:{PATTERNS[d].pattern})" for d in delimiters), re.I)
        cuts += [m.span() for m in either.finditer(cover)]
    cuts.append((len(cell), len(cell)))
    pieces = [cell[a[1] : b[0]].strip() for a, b in zip(cuts, cuts[1:])]
    if "and" in delimiters:
        pieces = [_JOINING.sub("", p) for p in pieces]
    return [v for v in map(tidy, pieces) if v]


def signature(piece: str) -> str:
    """The piece's type: runs of letters as A, of digits as 9; of more than twelve words, these and a hash of the whole."""
    words = re.sub(r"\d+", "9", re.sub(r"[^\W\d_]+", "A", piece)).split()
    if len(words) <= 12:
        return " ".join(words)
    return " ".join([*words[:12], hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()])


def _evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of piece types by source and candidate; '' stands for cells that no strong candidate divides."""
    for batch in batches:
        pieces, cells = Counter(), Counter()
        for source, cell in zip(batch["source"], batch["cell"]):
            if cell is None or " ".join(cell.split()).lower() in _NOTHING:
                continue
            cover = masked(cell)
            found = [n for n, p in PATTERNS.items() if p.search(cover)]
            strong = [n for n in found if n in STRONG]
            if not strong:
                pieces[source, "", signature(cover)] += 1
            for name in strong or found:  # beside a likely delimiter, an unlikely one proves nothing
                kinds = [signature(p) for p in PATTERNS[name].split(cover) if p.strip()]
                if len(kinds) > 1:
                    for kind in kinds:
                        pieces[source, name, kind] += 1
                    cells[source, name, len(kinds)] += 1
        rows = [(*k, n, 0, 0, 0) for k, n in pieces.items()] + [(s, c, "", 0, n, n * k, n * k * k) for (s, c, k), n in cells.items()]
        yield pd.DataFrame(rows, columns=["source", "candidate", "kind", "pieces", "cells", "total", "squares"])


def delimiter_scores(cells: DataFrame) -> DataFrame:
    """cells(source, cell) -> source, candidate, regularity, consistency, score, accepted.

    regularity: share of a candidate's pieces whose type also occurs as a whole cell of the source (or is quoted), for
    likely delimiters at least the share of the commonest type; drawn towards the prior while few pieces were seen. consistency: 1 / (1 + variation of the piece count).
    Types are counted on the map side; what is shuffled grows with distinct types, not with cells.
    """
    schema = "source string, candidate string, kind string, pieces long, cells long, total long, squares long"
    counts = cells.mapInPandas(_evidence, schema).groupBy("source", "candidate", "kind").agg(
        *[F.sum(c).alias(c) for c in ("pieces", "cells", "total", "squares")]
    )
    whole = counts.where("candidate = ''").select("source", "kind", F.lit(True).alias("known"))
    prior = F.try_element_at(F.create_map(*[F.lit(x) for name, _, p in CANDIDATES for x in (name, p)]), F.col("candidate"))
    regular = F.col("known") | F.col("kind").rlike(f"^{_QUOTE_PLACE}+$")
    scored = (
        counts.where("candidate <> ''")
        .join(whole, ["source", "kind"], "left")
        .groupBy("source", "candidate")
        .agg(
            F.sum(F.when(regular, F.col("pieces")).otherwise(0)).alias("known"),
            F.max("pieces").alias("commonest"),
            *[F.sum(c).alias(c) for c in ("pieces", "cells", "total", "squares")],
        )
    )
    mean = F.col("total") / F.col("cells")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / F.col("cells") - mean * mean))
    return scored.select(
        "source",
        "candidate",
        ((F.when(prior >= 0.5, F.greatest("known", "commonest")).otherwise(F.col("known")) + 5 * prior) / (F.col("pieces") + 5)).alias("regularity"),
        (1 / (1 + spread / mean)).alias("consistency"),
    ).select(
        "*", (F.col("regularity") * (0.5 + 0.5 * F.col("consistency"))).alias("score")
    ).withColumn("accepted", F.col("score") >= F.when(prior >= 0.5, LIKELY_SCORE).otherwise(UNLIKELY_SCORE))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _pieces(cell: pd.Series, delimiters: pd.Series) -> pd.Series:
    return pd.Series([split_cell(c, list(d) if d is not None else []) for c, d in zip(cell, delimiters)], dtype="object")


def unpack(df: DataFrame, source: Column, cell: str, keep: list[str]) -> DataFrame:
    """One row per value: source, the columns in `keep`, pos (from 1 over non-empty values), val.

    Delimiters are inferred per source over all of its cells, then each cell is divided at those of them that stand
    outside quotes and brackets. Cells that are NULL, blank, N/A or - give no rows; single values come out with pos 1;
    repeated rows stay repeated; an empty table gives no rows. Columns other than `keep` are ignored, so names may clash.
    """
    cells = df.select(source.cast("string").alias("source"), F.col(cell).cast("string").alias("cell"), *keep).where(
        F.col("cell").isNotNull() & (F.length(F.trim("cell")) > 0)
    )
    accepted = delimiter_scores(cells.select("source", "cell")).where("accepted").groupBy("source").agg(
        F.array_sort(F.collect_set("candidate")).alias("delimiters")
    )
    split = cells.join(accepted, "source", "left").select("source", *keep, F.posexplode(_pieces("cell", "delimiters")).alias("pos", "val"))
    return split.select("source", *keep, (F.col("pos") + 1).alias("pos"), "val")
