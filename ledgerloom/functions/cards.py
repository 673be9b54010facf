"""Features of a document's text for its file card."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import text_sha256
from ledgerloom.functions.text import first_capture, text_or_empty, words

# The two forms of a part number.
PART_NUMBER = r"\b(9\d{6}-\d{2}|NN\d{5}-\d{3})\b"
#: Two capitals after the word for a revision; a month and year, with or without a day, after the word for a publication.
REVISION = r"\bRev(?:ision)?\b[.:\s]*([A-Z]{2})\b"
PUBLISHED = r"\bPublished\b[:\s]*((?:\d{1,2} )?[A-Z][a-z]+ \d{4})"
#: A version is a dotted number after a word that announces one, or one of three or more parts that stands alone.
_PARTS = r"\d{1,2}[.]\d{1,2}(?:[.]\d{1,4}){%s}"
ANNOUNCED, ALONE = r"\b(?:v|(?:version|release)\s+)(" + _PARTS % "0,2" + r")\b", r"\b(" + _PARTS % "1,2" + r")\b"
VERSION = f"(?i){ANNOUNCED}|{ALONE}"
#: Pages a card's identifying fields are read from, and versions it keeps.
FIRST_PAGES, MOST_VERSIONS = 4, 8


def version_mentions(c: Column, most: int = MOST_VERSIONS) -> Column:
    """Versions a text names, in order, each once."""
    announced, alone = (F.regexp_extract_all(text_or_empty(c), F.lit(VERSION), F.lit(i)) for i in (1, 2))
    return F.slice(F.array_distinct(F.zip_with(announced, alone, lambda a, b: F.concat(a, b))), F.lit(1), F.lit(most))


def page_card(pages: Column) -> Column:
    """struct(pages, words, part_number, revision, published, versions, text_sha256) of a text given page by page.

    Words and the hash are of all pages, the other fields of the first FIRST_PAGES. NULL counts as no pages.
    """
    held = F.coalesce(pages, F.array().cast("array<string>"))
    whole, head = F.array_join(held, "\n"), F.array_join(F.slice(held, F.lit(1), F.lit(FIRST_PAGES)), "\n")
    return F.struct(
        F.size(held).alias("pages"),
        words(whole).alias("words"),
        first_capture(head, PART_NUMBER).alias("part_number"),
        first_capture(head, REVISION).alias("revision"),
        first_capture(head, PUBLISHED).alias("published"),
        version_mentions(head).alias("versions"),
        text_sha256(whole).alias("text_sha256"),
    )


def text_card(c: Column) -> Column:
    """struct(words, part_number, revision, published, versions, text_sha256) of a text."""
    return F.struct(
        words(c).alias("words"),
        first_capture(c, PART_NUMBER).alias("part_number"),
        first_capture(c, REVISION).alias("revision"),
        first_capture(c, PUBLISHED).alias("published"),
        version_mentions(c).alias("versions"),
        text_sha256(c).alias("text_sha256"),
    )


def extension_counts(names: Column) -> Column:
    """map<extension, count> over file names, sorted by extension; '(none)' for names without one."""
    exts = F.transform(names, lambda n: F.coalesce(F.nullif(F.lower(F.regexp_extract(n, r"[^/](\.[^./]+)$", 1)), F.lit("")), F.lit("(none)")))
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(exts)), lambda e: F.struct(e.alias("key"), F.size(F.filter(exts, lambda x: x == e)).alias("value"))))
