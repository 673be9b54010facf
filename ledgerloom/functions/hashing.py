"""Hashes and file kinds as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty

# First bytes of file kinds; content types and their extensions.
MAGIC = [("25504446", ".pdf"), ("504B0304", ".zip"), ("1F8B", ".gz")]
CONTENT_TYPES = {
    "application/pdf": ".pdf",
    "application/zip": ".zip",
    "application/x-zip-compressed": ".zip",
    "application/gzip": ".gz",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "text/csv": ".csv",
    "text/html": ".html",
}
GENERATED = r"\A<!-- Generated by[^\n]*\n?"


def sniff(body: Column) -> Column:
    """The extension that a file's first bytes tell; '' for others."""
    found = F.lit("")
    for magic, ext in reversed(MAGIC):
        found = F.when(F.hex(F.substring(body, 1, len(magic) // 2)) == magic, ext).otherwise(found)
    return F.when(body.isNull(), "").otherwise(found)


def content_extension(content_type: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(F.split_part(text_or_empty(content_type), F.lit(";"), F.lit(1))))), F.lit(""))


def file_extension(content_type: Column, body: Column, url_ext: Column) -> Column:
    """By content type, else first bytes, else the URL, else .bin."""
    blank = F.lit("")
    return F.coalesce(F.nullif(content_extension(content_type), blank), F.nullif(sniff(body), blank), F.nullif(url_ext, blank), F.lit(".bin"))


def text_sha256(c: Column) -> Column:
    """SHA-256 of a text; NULL for empty text."""
    return F.when(text_or_empty(c) != "", F.sha2(c.cast("binary"), 256))


def page_hash(c: Column) -> Column:
    """SHA-1 of a snapshot page, blind to line ends and to the first line's generator note."""
    unix = F.replace(text_or_empty(c), F.lit("\r\n"), F.lit("\n"))
    return F.sha1(F.regexp_replace(unix, GENERATED, "").cast("binary"))


def cache_key(url: Column) -> Column:
    return F.sha1(url.cast("binary"))
