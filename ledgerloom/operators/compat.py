"""Which platforms run which software, from published tables: stated ranges and recommended releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.rules import longest_prefix
from ledgerloom.functions.text import text_or_empty
from ledgerloom.functions.versions import version_key

#: What stands for the open last part of a release such as 9.x while releases are compared.
OPEN_PART = 999
# Fixed value: the usual endings of range tables' file names.
TABLE_ENDING = r"-(?:switches|port-extenders|series-routers)-software-support$"
RELATION = "platform string, software array<string>, kind string, min string, max string, releases array<string>, source string"


@dataclass(frozen=True)
class RangeSource:
    """Tables that state a first and a last supported release, one platform per table."""

    source: str
    software: Sequence[str]
    platforms: Mapping[str, str]
    no_entry: Sequence[str] = ()
    suffix: str = TABLE_ENDING
    prefixes: str = ""
    last_heading: str = "last supported"


@dataclass(frozen=True)
class RecommendedSource:
    """Tables that recommend releases, one platform per row, with the software named in each cell."""

    source: str
    platforms: Mapping[str, str]
    software_by_prefix: Mapping[str, str] = field(default_factory=dict)


def table_key(name: Column, suffix: str) -> Column:
    """A table's platform key: its file name without extension, number and the usual ending."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text_or_empty(name)), r"\.csv$", ""), r"^\d+-", "")
    return F.regexp_replace(bare, suffix, "")


def _mapped(platforms: Mapping[str, str], key: Column) -> Column:
    if not platforms:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in platforms.items() for x in (str(k).lower(), v)]), key)


def range_end(cell: Column) -> Column:
    """A last supported release as a key, with .x as an open last part; NULL for none."""
    return version_key(F.replace(F.lower(F.trim(text_or_empty(cell))), F.lit(".x"), F.lit(f".{OPEN_PART}")))


def ranges(bounds: DataFrame, group: list[str]) -> DataFrame:
    """bounds(group, first, last) -> group, lo, hi, is_open: extremes in list order over rows that state a first release.

    `last` beginning with 'latest' leaves the end open. Groups that don't state both ends give no row.
    """
    rows = bounds.select(
        *group,
        version_key(F.trim(text_or_empty(F.col("first")))).alias("v"),
        F.lower(F.trim(text_or_empty(F.col("last")))).startswith("latest").alias("latest"),
        range_end(F.col("last")).alias("end"),
    ).where(F.col("v").isNotNull())
    return (
        rows.groupBy(*group)
        .agg(F.min("v").alias("lo"), F.max(F.when(~F.col("latest"), F.col("end"))).alias("hi"), F.max("latest").alias("is_open"))
        .where(F.col("is_open") | F.col("hi").isNotNull())
    )


def _written(key: Column) -> Column:
    return F.array_join(F.transform(key, lambda p: p.cast("string")), ".")


def range_relations(cells: DataFrame, source: RangeSource) -> tuple[DataFrame, DataFrame]:
    """cells(table_name, row_no, col_no, header, value) -> (relations, tables without a known platform).

    The first release stands in the second column, the last one under the first heading that names it.
    """
    keyed = cells.withColumn("key", table_key(F.col("table_name"), source.suffix)).withColumn("platform", _mapped(source.platforms, F.col("key")))
    silent = F.col("key").isin(*[str(x).lower() for x in source.no_entry]) if source.no_entry else F.lit(False)
    unmapped = keyed.where(F.col("platform").isNull() & ~silent).select(F.lit(source.source).alias("source"), F.col("table_name").alias("name")).distinct()
    known = keyed.where(F.col("platform").isNotNull())
    is_last = F.lower(text_or_empty(F.col("header"))).contains(source.last_heading)
    last_col = known.where(is_last).groupBy("table_name").agg(F.min("col_no").alias("last_col"))
    placed = known.join(last_col, "table_name")
    first = F.regexp_replace(F.trim(text_or_empty(F.col("value"))), f"(?i)^(?:{source.prefixes})\\s+", "") if source.prefixes else F.col("value")
    bounds = placed.groupBy("table_name", "platform", "row_no").agg(
        F.max(F.when(F.col("col_no") == 1, first)).alias("first"), F.max(F.when(F.col("col_no") == F.col("last_col"), F.col("value"))).alias("last")
    )
    found = ranges(bounds, ["table_name", "platform"])
    end = F.when(~F.col("is_open"), F.replace(_written(F.col("hi")), F.lit(f".{OPEN_PART}"), F.lit(".x")))
    none = F.array().cast("array<string>")
    return found.select(
        "platform", F.array(*[F.lit(s) for s in source.software]).alias("software"), F.lit("range").alias("kind"),
        _written(F.col("lo")).alias("min"), end.alias("max"), none.alias("releases"), F.lit(source.source).alias("source"),
    ), unmapped


def recommended_relations(cells: DataFrame, source: RecommendedSource) -> tuple[DataFrame, DataFrame]:
    """cells(table_name, row_no, col_no, header, value) -> (relations, platforms that no entry is known for).

    Release columns are those whose heading names a release and no date; several cells keep their column order.
    """
    row = ["table_name", "row_no"]
    named = cells.where("col_no = 0").select(*row, F.trim(text_or_empty(F.col("value"))).alias("name"))
    named = named.withColumn("platform", _mapped(source.platforms, F.lower("name")))
    unmapped = named.where("platform IS NULL AND name <> ''").select(F.lit(source.source).alias("source"), "name").distinct()
    heading = F.lower(text_or_empty(F.col("header")))
    release = cells.where(heading.contains("release") & ~heading.contains("date"))
    said = release.select(*row, "col_no", longest_prefix(F.col("value"), source.software_by_prefix).alias("said")).where("said IS NOT NULL")
    joined = said.join(named.where("platform IS NOT NULL"), row)
    found = joined.groupBy(*row, "platform", F.col("said.name").alias("software")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("col_no", F.col("said.rest").alias("rest")))), lambda x: x["rest"]).alias("releases")
    )
    none = F.lit(None).cast("string")
    return found.select(
        "platform", F.array("software").alias("software"), F.lit("recommended").alias("kind"), none.alias("min"), none.alias("max"), "releases", F.lit(source.source).alias("source")
    ), unmapped


def compatibility(tables: Mapping[str, DataFrame], sources: Sequence[RangeSource | RecommendedSource]) -> tuple[DataFrame, DataFrame]:
    """All relations of all sources, and everything no entry is known for."""
    found = [(range_relations if isinstance(s, RangeSource) else recommended_relations)(tables[s.source], s) for s in sources if s.source in tables]
    relations, unmapped = found[0]
    for more, missed in found[1:]:
        relations, unmapped = relations.unionByName(more), unmapped.unionByName(missed)
    return relations, unmapped
