"""Text functions as Column expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, format characters (zero width, soft hyphen, marks), controls and the two marks.
BLANKS_AND_MARKS = r"(?U)[\s\p{Z}\p{Cf}\p{Cc}\u2122\u00AE]+"
INVISIBLE_AND_MARKS = r"[\u200B-\u200D\uFEFF\u2122\u00AE]"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean(c: Column) -> Column:
    """Without zero-width characters and trade marks, white space as one blank, trimmed; NULL becomes ''."""
    bare = F.regexp_replace(text_or_empty(c), INVISIBLE_AND_MARKS, "")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def squeeze(c: Column) -> Column:
    """The text without any blank, invisible character or mark: equal for titles that differ in these only."""
    return F.regexp_replace(text_or_empty(c), BLANKS_AND_MARKS, "")


def slug(c: Column, n: int = 80) -> Column:
    """Lower case, runs of other characters as '-', at most n characters, 'untitled' if nothing is left."""
    dashed = F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", "-")
    cut = F.regexp_replace(F.substring(F.regexp_replace(dashed, "^-+|-+$", ""), 1, n), "^-+|-+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("untitled"))


def safe_name(c: Column, n: int = 120) -> Column:
    """A file name for any system: forbidden characters as blanks, blanks collapsed, no blank or dot at either end."""
    spaced = F.regexp_replace(text_or_empty(c), r'[\\/:*?"<>|\x00-\x1f]', " ")
    tidy = F.regexp_replace(F.regexp_replace(spaced, r"(?U)\s+", " "), r"^[ .]+|[ .]+$", "")
    cut = F.regexp_replace(F.substring(tidy, 1, n), r"^[ .]+|[ .]+$", "")
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit("untitled"))


def escape_bars(c: Column) -> Column:
    return F.replace(text_or_empty(c), F.lit("|"), F.lit("\\|"))


def words(c: Column) -> Column:
    """Number of words; 0 for blank text."""
    trimmed = F.regexp_replace(text_or_empty(c), r"(?U)^\s+|\s+$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"(?U)\s+")))


def first_capture(c: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, NULL without a match."""
    return F.nullif(F.regexp_extract(text_or_empty(c), pattern, group), F.lit(""))


def thousands(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)
