"""Release numbers as arrays of integers, with the two orders the catalog uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import text_or_empty

#: Parts of a release number that take part in a padded comparison.
WIDTH = 8


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value evaluated once, however often it is used inside."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def version_key(c: Column) -> Column:
    """The leading dotted number (after an optional v) as array<bigint>; NULL where a label has none."""
    digits = F.get(F.regexp_extract_all(text_or_empty(c), F.lit(r"^v?([0-9]+(?:[.][0-9]+)*)"), F.lit(1)), F.lit(0))
    return F.transform(F.split(digits, "[.]"), lambda x: x.try_cast("bigint"))


def _filled(key: Column) -> Column:
    places = F.sequence(F.lit(0), F.lit(WIDTH - 1))
    return F.when(key.isNotNull(), F.transform(places, lambda i: F.coalesce(F.get(key, i), F.lit(0).cast("bigint"))))


def padded(key: Column) -> Column:
    """The key with missing parts as 0, so that 9.4 equals 9.4.0; NULL stays NULL."""
    return bound(key, _filled)


def listed(key: Column) -> Column:
    """The key for plain list order, where 9.4 comes before 9.4.0 and labels without a number come first."""
    return F.coalesce(key, F.array(F.lit(-1).cast("bigint")))


def compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 in padded order."""
    both = F.struct(padded(a).alias("x"), padded(b).alias("y"))
    return bound(both, lambda p: F.when(p["x"] < p["y"], -1).when(p["x"] > p["y"], 1).when(p["x"].isNotNull() & p["y"].isNotNull(), 0))


def cut_to(key: Column, limit: Column) -> Column:
    """The key cut to the length of a bound, padded: with it, up to 33.6 includes 33.6.2."""
    return padded(F.slice(key, F.lit(1), F.size(limit)))


def major(key: Column) -> Column:
    return F.get(key, F.lit(0))


def line(key: Column) -> Column:
    """Major and minor (0 where missing) as one comparable array."""
    return bound(key, lambda k: F.when(k.isNotNull(), F.array(F.get(k, F.lit(0)), F.coalesce(F.get(k, F.lit(1)), F.lit(0).cast("bigint")))))


def line_label(c: Column) -> Column:
    """major.minor of a label that starts with it, else NULL."""
    return F.nullif(F.regexp_extract(text_or_empty(c), r"^v?([0-9]+\.[0-9]+)", 1), F.lit(""))
