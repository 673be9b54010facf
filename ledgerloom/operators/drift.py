"""Schemas that drift between files: column profiles, rename detection by bipartite matching, one unified table."""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.versions import bound
from ledgerloom.session import cut_lineage

#: Share of the components with a value in both files whose value must be carried over for a rename.
CARRIED = 0.8
#: Rows from which a file may count as large.
LARGE = 100_000
#: Distinct values from which two columns are compared as sets, where no column tells which rows belong together.
ALIKE = 4
#: What equal kinds of values and the similarity of two names can add to a match; they only decide between equally carried columns.
KIND_WEIGHT, NAME_WEIGHT = 0.02, 0.05


#: White space of any kind.
_BLANKS = "\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def heading(c: Column) -> Column:
    """A heading's normal form: trimmed, lower case, white space as one blank. Patterns are used only where blanks stand together."""
    even = F.trim(F.translate(F.lower(c), _BLANKS, " " * len(_BLANKS)))
    return bound(even, lambda e: F.when(e.contains("  "), F.regexp_replace(e, " +", " ")).otherwise(e))


def json_kind(schema: Column) -> Column:
    """text, number, true/false, list or object of a variant's schema; NULL for null."""
    return (
        F.when(schema == "VOID", None)
        .when(schema == "STRING", "text")
        .when(schema == "BOOLEAN", "true/false")
        .when(schema.startswith("ARRAY"), "list")
        .when(schema.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def fields_of(record: Column) -> Column:
    """The fields of one JSON record as an array of (name, kind, val); NULL for what is no JSON object.

    Values of kind NULL are kept, since any row with a heading makes it a field of the file. Of headings with the same
    normal form in one record, the first with a value counts.
    """
    entries = F.map_entries(F.from_json(record, "map<string, variant>"))

    def field(entry: Column) -> Column:
        def typed(schema: Column) -> Column:
            text = F.when(schema == "STRING", entry["value"].cast("string")).when(schema != "VOID", F.to_json(entry["value"]))
            return F.struct(heading(entry["key"]).alias("name"), json_kind(schema).alias("kind"), text.alias("val"))

        return bound(F.schema_of_variant(entry["value"]), typed)

    return F.transform(entries, field)


def hashed_fields(record: Column) -> Column:
    """`fields_of` with values as 64-bit hashes, sorted: what comparing files needs, at eight bytes a value."""
    slim = F.transform(fields_of(record), lambda f: F.struct(f["name"].alias("name"), f["kind"].alias("kind"), F.when(f["val"].isNotNull(), F.xxhash64(f["val"])).alias("val")))
    return F.array_sort(slim)


def value_of(fields: Column, name: Column) -> Column:
    return F.get(F.filter(fields, lambda f: (f["name"] == name) & f["val"].isNotNull()), F.lit(0))["val"]


_PAIRS = T.ArrayType(T.StructType([T.StructField("old_name", T.StringType()), T.StructField("new_name", T.StringType())]))


@F.pandas_udf(_PAIRS)
def _matched(candidates: pd.Series) -> pd.Series:
    """Maximum-weight one-to-one matching of the gone and come columns of each file, over the pairs that qualify."""
    return pd.Series([match_columns([(c["old_name"], c["new_name"], c["carried"] + KIND_WEIGHT * c["kept"]) for c in some]) for some in candidates], dtype="object")


def match_columns(candidates: list[tuple[str, str, float]]) -> list[dict]:
    weight = {(g, c): carried + NAME_WEIGHT * SequenceMatcher(None, g, c).ratio() for g, c, carried in candidates}
    gone, come = sorted({g for g, _ in weight}), sorted({c for _, c in weight})
    n, big = max(len(gone), len(come)), 10.0
    cost = [[big - weight.get((gone[i], come[j]), 0.0) if i < len(gone) and j < len(come) else big for j in range(n)] for i in range(n)]
    pairs = [(gone[i], come[j]) for i, j in enumerate(assignment(cost)) if i < len(gone) and j < len(come)]
    return [{"old_name": g, "new_name": c} for g, c in pairs if (g, c) in weight]


def assignment(cost: list[list[float]]) -> list[int]:
    """Cheapest column for each row of a square cost matrix, by successive shortest paths with potentials."""
    n = len(cost)
    row_price, col_price, holder = [0.0] * n, [0.0] * n, [-1] * n
    for start in range(n):
        reach, came, done = [math.inf] * n, [-1] * n, [False] * n
        row, col = start, -1
        while True:
            best, step = math.inf, -1
            for j in range(n):
                if done[j]:
                    continue
                slack = cost[row][j] - row_price[row] - col_price[j]
                if slack < reach[j]:
                    reach[j], came[j] = slack, col
                if reach[j] < best:
                    best, step = reach[j], j
            row_price[start] += best
            for j in range(n):
                if done[j]:
                    row_price[holder[j]] += best
                    col_price[j] -= best
                else:
                    reach[j] -= best
            done[step], col = True, step
            if holder[step] < 0:
                break
            row = holder[step]
        while col >= 0:
            back = came[col]
            holder[col] = holder[back] if back >= 0 else start
            col = back
    chosen = [-1] * n
    for j, i in enumerate(holder):
        chosen[i] = j
    return chosen


def _files(found: DataFrame) -> DataFrame:
    """Each file with the file before and after it in its series. found: file, series, scan."""
    in_time = Window.partitionBy("series").orderBy("scan", "file")
    return found.select("file", F.lag("file").over(in_time).alias("before"), F.lead("file").over(in_time).alias("next"))


def distinct_lines(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """file, fields: the distinct records of each file, those of a file together.

    A file with more than LARGE rows and more than a 10,000th of all has its rows spread instead, and its copies are
    dropped before they travel; there are fewer than 10,000 such files, so their names may reach the driver. sizes: file, n.
    """
    most, total = sizes.agg(F.max("n"), F.sum("n")).head()
    limit = max(LARGE, (total or 0) // 10_000)
    large = [r[0] for r in sizes.where(F.col("n") > limit).select("file").collect()] if (most or 0) > limit else []
    fields = hashed_fields(F.col("record")).alias("fields")
    if not large:
        return rows.select("file", fields).repartition("file").distinct()
    is_large = F.col("file").isin(large)
    return rows.where(~is_large).select("file", fields).repartition("file").distinct().unionByName(rows.where(is_large).select("file", fields).distinct())


def column_profiles(lines: DataFrame) -> DataFrame:
    """lines(file, fields) -> file, name, profile(kinds, identifies, values), by one aggregation.

    values is a theta sketch of the column's distinct values, which is exact up to 4,096 of them. A column identifies rows
    if it has as many distinct values as lines with a value (within twice the error a sketch has beyond that number), and
    at least nine tenths of the lines have one.
    """
    cells = lines.select("file", F.explode("fields").alias("f")).select("file", "f.*")
    counted = cells.groupBy("file", "name").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"), F.count("kind").alias("filled"), F.count("*").alias("lines"), F.theta_sketch_agg("val").alias("values")
    )
    apart = F.col("filled") - F.theta_sketch_estimate("values")
    unique = F.abs(apart) <= F.when(F.col("filled") <= 4096, 0).otherwise(0.03 * F.col("filled"))
    identifies = (F.col("filled") > 0) & unique & (F.col("filled") >= 0.9 * F.col("lines"))
    return counted.select("file", "name", F.struct("kinds", identifies.alias("identifies"), "values").alias("profile"))


def _alike(gone: Column, come: Column) -> Column:
    """Gone and come columns of the same kinds that hold nearly the same values by their sketches: array of (old_name, new_name, carried, kept).

    carried is the common share of the larger set of values; sets of fewer than ALIKE values say nothing.
    """

    def link(a: Column, b: Column) -> Column:
        x, y = a["profile"]["values"], b["profile"]["values"]
        most = F.greatest(F.theta_sketch_estimate(x), F.theta_sketch_estimate(y))
        share = F.when(most >= ALIKE, F.theta_sketch_estimate(F.theta_intersection(x, y)) / most)
        same = a["profile"]["kinds"] == b["profile"]["kinds"]
        return F.struct(a["name"].alias("old_name"), b["name"].alias("new_name"), F.when(same, share).alias("carried"), F.lit(1.0).alias("kept"))

    return F.filter(F.flatten(F.transform(gone, lambda g: F.transform(come, lambda c: link(g, c)))), lambda p: p["carried"] >= CARRIED)


def _anchor(same: Column, gone: Column, come: Column) -> Column:
    """The pair of identifying columns with the most common values by their sketches: struct(n, kept, old_name, new_name)."""

    def link(a: Column, b: Column, kept: bool) -> Column:
        common = F.theta_sketch_estimate(F.theta_intersection(a["profile"]["values"], b["profile"]["values"]))
        return F.struct(common.alias("n"), F.lit(kept).alias("kept"), a["name"].alias("old_name"), b["name"].alias("new_name"))

    known = lambda column: F.filter(column, lambda c: c["profile"]["identifies"])
    stayed = F.transform(
        F.filter(same, lambda c: c["was"]["identifies"] & c["now"]["identifies"]),
        lambda c: link(F.struct(c["name"].alias("name"), c["was"].alias("profile")), F.struct(c["name"].alias("name"), c["now"].alias("profile")), True),
    )
    moved = F.flatten(F.transform(known(gone), lambda g: F.transform(known(come), lambda c: link(g, c, False))))
    return F.array_max(F.concat(stayed, moved))


def schema_changes(records: DataFrame, file: str = "file_id", series: str = "table_name", scan: str = "scan_no", record: str = "record") -> DataFrame:
    """Changes of each file against the file of its series at the nearest earlier scan: file, change, old_name, new_name.

    Each column is profiled by kinds, by whether it identifies rows, and by a sketch of its values. Where columns are
    gone and others have come, rows of the two files are aligned on the identifying pair of columns that shares most
    values; a gone and a come column qualify as a rename if nearly all aligned rows with both values carry them over,
    which is counted over all rows. Where no pair of columns identifies rows, those of the same kinds qualify whose sets
    of values are nearly the same by their sketches. Qualified pairs are matched one to one with the highest sum of
    carried shares, kinds and names deciding between equals. Values are compared by 64-bit hashes.

    Rows meet on (file, identifying value), so neither a large file nor a series that holds a third of all rows ends in
    one task; what is gathered per file is its columns. Repeated
    rows count once; rows without a file or a scan are left out; records that are no JSON object have no fields; files
    without fields are compared like others; an empty table gives no rows; keys of a record may clash with column names.
    """
    rows = records.select(F.col(file).alias("file"), F.col(series).alias("series"), F.col(scan).alias("scan"), F.col(record).alias("record")).where(
        F.col("file").isNotNull() & F.col("scan").isNotNull()
    )
    found = cut_lineage(rows.groupBy("file").agg(F.min("series").alias("series"), F.min("scan").alias("scan"), F.count("*").alias("n")))
    lines = cut_lineage(distinct_lines(rows, found))
    files = cut_lineage(_files(found))

    placed = column_profiles(lines).join(files.hint("merge"), "file")
    none = F.lit(None)
    kind = "struct<kinds:array<string>,identifies:boolean,values:binary>"
    ends = F.array(
        F.struct(F.when(F.col("before").isNotNull(), F.col("file")).alias("file"), none.cast(kind).alias("was"), F.col("profile").alias("now")),
        F.struct(F.col("next").alias("file"), F.col("profile").alias("was"), none.cast(kind).alias("now")),
    )
    sides = placed.select("name", F.explode(ends).alias("end")).select("end.file", "name", "end.was", "end.now").where(F.col("file").isNotNull())
    sides = sides.groupBy("file", "name").agg(F.max("was").alias("was"), F.max("now").alias("now"))
    is_gone, is_come = F.col("now").isNull(), F.col("was").isNull()
    other = (F.size("was.kinds") > 0) & (F.size("now.kinds") > 0) & (F.col("was.kinds") != F.col("now.kinds"))
    pairs = cut_lineage(
        sides.groupBy("file")
        .agg(
            F.collect_list(F.when(is_gone, F.struct("name", F.col("was").alias("profile")))).alias("gone"),
            F.collect_list(F.when(is_come, F.struct("name", F.col("now").alias("profile")))).alias("come"),
            F.collect_list(F.when(~is_gone & ~is_come, F.struct("name", "was", "now"))).alias("same"),
            F.collect_list(F.when(other, F.col("name"))).alias("retyped"),
        )
        .join(files.where("before IS NOT NULL").select("file", "before").hint("merge"), "file")
        .withColumn("anchor", F.when((F.size("gone") > 0) & (F.size("come") > 0), _anchor(F.col("same"), F.col("gone"), F.col("come"))))
        .withColumn("alike", F.when(F.col("anchor").isNull() | (F.col("anchor.n") < 1), _alike(F.col("gone"), F.col("come"))))
        .select("file", "before", F.col("gone.name").alias("gone"), F.col("come.name").alias("come"), "retyped", "anchor", "alike")
    )

    torn = pairs.where("anchor IS NOT NULL AND anchor.n >= 1").select("file", "before", "gone", "come", "anchor")
    # A line has at most two roles: in the comparison of its own file, and in that of the file after it.
    role = lambda at, name, taken, is_old: torn.select(F.col(at).alias("at"), F.struct("file", F.col(f"anchor.{name}").alias("name"), F.col(taken).alias("taken"), F.lit(is_old).alias("is_old")).alias("role"))
    roles = role("before", "old_name", "gone", True).unionByName(role("file", "new_name", "come", False)).groupBy("at").agg(F.collect_list("role").alias("roles"))
    played = lines.withColumnRenamed("file", "at").join(roles.hint("merge"), "at").select("fields", F.explode("roles").alias("r")).select(
        "r.file", "r.is_old", value_of(F.col("fields"), F.col("r.name")).alias("met"), F.filter("fields", lambda f: f["val"].isNotNull() & F.array_contains("r.taken", f["name"])).alias("held")
    )
    sides_of = [F.max(F.when(F.col("is_old") == is_old, F.col("held"))).alias(name) for name, is_old in (("old", True), ("new", False))]
    aligned = played.where(F.col("met").isNotNull()).groupBy("file", "met").agg(*sides_of).where("old IS NOT NULL AND new IS NOT NULL")
    held = aligned.select("file", F.explode("old").alias("o"), "new").select("file", "o", F.explode("new").alias("n"))
    carried = held.groupBy("file", F.col("o.name").alias("old_name"), F.col("n.name").alias("new_name")).agg(
        F.avg((F.col("o.val") == F.col("n.val")).cast("int")).alias("carried"), F.avg((F.col("o.kind") == F.col("n.kind")).cast("int")).alias("kept")
    )
    qualified = carried.where(F.col("carried") >= CARRIED).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("old_name", "new_name", "carried", "kept"))).alias("candidates"))
    by_sets = pairs.where(F.size("alike") > 0).select("file", F.array_sort("alike").alias("candidates"))
    renamed = qualified.unionByName(by_sets).select("file", _matched("candidates").alias("renamed"))

    told = pairs.join(renamed.hint("merge"), "file", "left").withColumn("renamed", F.coalesce("renamed", F.array().cast("array<struct<old_name:string,new_name:string>>")))

    def report(change: str, old: Column, new: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), old.alias("old_name"), new.alias("new_name"))

    blank = F.lit("")
    changes = F.concat(
        F.transform("renamed", lambda r: report("renamed", r["old_name"], r["new_name"])),
        F.transform(F.array_except("come", F.col("renamed.new_name")), lambda c: report("added", blank, c)),
        F.transform(F.array_except("gone", F.col("renamed.old_name")), lambda g: report("removed", g, blank)),
        F.transform("retyped", lambda k: report("retyped", k, k)),
    )
    return told.select("file", F.explode(changes).alias("c")).select("file", "c.*")


def _lineages(pdf: pd.DataFrame) -> pd.DataFrame:
    """The unified name of every heading of one series: the first name of its chain of renames.

    A heading that comes anew takes its own name, so a field that was left out for some files goes on; if an earlier
    heading's chain holds that name in the same file, it is numbered.
    """
    out, current = [], {}
    for (_, file), rows in pdf.sort_values(["scan", "file", "name"], kind="stable").groupby(["scan", "file"], sort=False):
        before, current = current, {}
        for name, old in zip(rows["name"], rows["old_name"]):
            field = before.get(old if isinstance(old, str) and old else name)
            if field is not None:
                current[name] = field
        for name in rows["name"]:
            if name not in current:
                n, field = 1, name
                while field in current.values():
                    n, field = n + 1, f"{name} ({n + 1})"
                current[name] = field
        out += [(file, name, field) for name, field in current.items()]
    return pd.DataFrame(out, columns=["file", "name", "field"])


def unified(records: DataFrame, changes: DataFrame, keep: list[str], file: str = "file_id", series: str = "table_name", scan: str = "scan_no", record: str = "record") -> DataFrame:
    """All files as one table in long form: file, the columns in `keep`, field (the unified name), name, kind, val.

    A field keeps one name through all of its renames within a series. What is gathered per series is its headings, not
    its rows.
    """
    rows = records.where(F.col(file).isNotNull() & F.col(scan).isNotNull())
    filled = rows.select(F.col(file).alias("file"), F.coalesce(F.col(series), F.lit("")).alias("series"), F.col(scan).alias("scan"), *keep, F.explode(fields_of(F.col(record))).alias("f"))
    heads = filled.groupBy("file", F.col("f.name").alias("name")).agg(F.min("series").alias("series"), F.min("scan").alias("scan"))
    moved = changes.where("change = 'renamed'").select("file", "old_name", F.col("new_name").alias("name"))
    kind = records.schema[file].dataType.simpleString()
    names = heads.join(moved.hint("merge"), ["file", "name"], "left").groupBy("series").applyInPandas(_lineages, f"file {kind}, name string, field string")
    return filled.select("file", *keep, "f.*").join(names.hint("merge"), ["file", "name"]).select("file", *keep, "field", "name", "kind", "val")
