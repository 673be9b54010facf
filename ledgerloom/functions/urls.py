"""URL functions as Column expressions, on patterns rather than parse_url: odd hosts and blanks must not give NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty


def listing_key(c: Column) -> Column:
    """A listing's identity: no fragment, no trailing slashes, scheme and host in lower case."""
    bare = F.regexp_replace(text_or_empty(c), r"(?s)/*(?:#.*)?\z", "")
    head = F.regexp_extract(bare, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.concat(F.lower(head), F.substring(bare, F.length(head) + 1, F.length(bare)))


def canonical(c: Column) -> Column:
    """No fragment and exactly one trailing slash; empty stays as it is."""
    bare = F.regexp_replace(F.split_part(c, F.lit("#"), F.lit(1)), "/+$", "")
    return F.when(c.isNull() | (c == ""), c).otherwise(F.concat(bare, F.lit("/")))


def host(c: Column) -> Column:
    """Host with port, in lower case; '' for relative addresses."""
    return F.lower(F.regexp_extract(text_or_empty(c), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def path(c: Column) -> Column:
    rest = F.regexp_replace(text_or_empty(c), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "")
    return F.regexp_extract(rest, "^([^?#]*)", 1)


def decoded(c: Column) -> Column:
    """Percent-decoded text; '+' stays a plus and malformed escapes stay as they are."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def last_segment(c: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(path(c), "/+$", ""), "([^/]*)$", 1)


def extension(c: Column) -> Column:
    """'.pdf' for a path that ends in a short alphanumeric extension, else ''."""
    return F.regexp_extract(F.lower(decoded(path(c))), r"[^/](\.[a-z0-9]{1,5})\z", 1)


def area_of(c: Column) -> Column:
    """First path segment, with the second one below resources and support."""
    segments = F.filter(F.split(path(c), "/"), lambda s: s != "")
    first, second = F.coalesce(F.get(segments, F.lit(0)), F.lit("")), F.get(segments, F.lit(1))
    return F.when(first.isin("resources", "support") & second.isNotNull(), F.concat_ws("/", first, second)).otherwise(first)
