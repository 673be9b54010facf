"""Date functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import first_capture, text_or_empty

# English month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
STATED = r"(?i)(?:current as of|as of|updated on|last updated:?)\s+([A-Za-z]+\.? \d{1,2},? \d{4}|\d{1,2}[ -][A-Za-z]+[ -]\d{4}|[A-Za-z]+ \d{4}|\d{4}-\d{2}-\d{2})"


def month_iso(c: Column) -> Column:
    """The first 'Month YYYY' in a text as YYYY-MM; '' if there is none or its name is no month."""
    pattern = r"([A-Za-z]{3})[a-z]*\.? (\d{4})"
    text = text_or_empty(c)
    names = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")])
    number = F.try_element_at(names, F.lower(F.regexp_extract(text, pattern, 1)))
    return F.coalesce(F.concat(F.regexp_extract(text, pattern, 2), F.lit("-"), number), F.lit(""))


def stated_date(c: Column) -> Column:
    """The date a text says it is current as of, as written; NULL if it says none."""
    return first_capture(c, STATED)


def iso_date(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def due_on(last: Column, days: int) -> Column:
    """The day from which another scan is due."""
    return F.date_add(iso_date(last), days)
