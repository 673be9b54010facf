"""The pN_ queries of the general problems over the driver's tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ledgerloom.operators.drift import schema_changes, unified
from ledgerloom.operators.history import listing_versions
from ledgerloom.operators.moments import normalise_moments
from ledgerloom.operators.packed import delimiter_scores, unpack
from ledgerloom.operators.snapshot_diff import ledger_changes
from ledgerloom.session import table


def _packed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    firmware = table(spark, sf_dir, "ap_firmware").select("row_id", F.lit("ap_firmware").alias("name"), F.col("supported_fw_versions").alias("cell"))
    notices = table(spark, sf_dir, "eos_notices").select("row_id", F.lit("eos_notices").alias("name"), F.col("replacement_product").alias("cell"))
    return firmware.unionByName(notices)


def p1_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delimiters inferred for each source, with their scores."""
    return delimiter_scores(_packed_cells(spark, sf_dir).select(F.col("name").alias("source"), "cell"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unpack(_packed_cells(spark, sf_dir), F.col("name"), "cell", ["row_id"])
    return found.select(F.col("source").alias("source_table"), "row_id", F.col("pos").cast("int").alias("pos"), "val")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = table(spark, sf_dir, "listings")
    newest = listings.agg(F.max("scan_no")).head()[0]
    dated = [
        listings.where(F.col("scan_no") == newest).select(F.lit("listings").alias("name"), "row_id", F.col("page").alias("source"), F.col("date").alias("value"), F.lit("UTC").alias("zone")),
        *[
            table(spark, sf_dir, name).select(F.lit(name).alias("name"), "row_id", F.col("publisher_zone").alias("source"), F.col(field).alias("value"), F.col("publisher_zone").alias("zone"))
            for name, field in (("recommendations", "recommendation_effective_date"), ("eos_notices", "end_of_sale"))
        ],
    ]
    return dated[0].unionByName(dated[1]).unionByName(dated[2])


def _moments(rows: DataFrame, stated: bool = True) -> DataFrame:
    return normalise_moments(rows, F.col("name"), F.col("source"), F.col("row_id"), F.col("value"), F.col("zone"), ["row_id"], stated)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moments(_dated(spark, sf_dir))


def p2_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without any convention: every order of day, month and year is found from the record order alone."""
    return _moments(_dated(spark, sf_dir), stated=False)


def p2_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the record order alone finds what the conventions say, over the values whose order it has to find.

    source_table, settled (slashed, pointed or named days read under the conventions), agree, agree_share.
    """
    rows = _dated(spark, sf_dir)
    open_form = F.col("value").rlike(r"^\s*\d{1,2}([/.])\d{1,2}\1\d{2,4}|^\s*\d{1,2}[ -][A-Za-z]+[ -]\d{2}\b")
    known = _moments(rows.where(open_form)).withColumnRenamed("moment", "said")
    both = known.join(p2_inferred(spark, sf_dir).hint("merge"), ["source_table", "row_id"], "left")
    counts = both.groupBy("source_table").agg(F.count("*").alias("settled"), F.count_if(F.col("said") == F.col("moment")).alias("agree"))
    return counts.withColumn("agree_share", F.round(F.col("agree") / F.col("settled"), 4))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_versions(table(spark, sf_dir, "listings"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_changes(table(spark, sf_dir, "listings"), table(spark, sf_dir, "snapshots"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_changes(table(spark, sf_dir, "support_rows")).withColumnRenamed("file", "file_id")


def p6_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "support_rows")
    return unified(rows, schema_changes(rows), ["row_id"]).withColumnRenamed("file", "file_id")


def queries() -> dict:
    return {"p1_found": p1_found, "p1_delimiters": p1_delimiters, "p2_found": p2_found, "p2_inferred": p2_inferred, "p2_agreement": p2_agreement, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p6_unified": p6_unified}


_KEYED = """
keyed AS (
  SELECT regexp_replace(bare, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*).*$', '\\1', 's') AS head, bare, l.* EXCLUDE (bare)
  FROM (SELECT *, rtrim(regexp_replace(coalesce(url, ''), '#.*$', '', 's'), '/') AS bare FROM listings) l
),
rows_ AS (
  SELECT CASE WHEN regexp_matches(bare, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN lower(head) || substr(bare, length(head) + 1) ELSE bare END AS k_url,
         coalesce(page, '') AS k_page, scan_no, scan_date, loaded_at, row_id, first_seen, title,
         coalesce(last_seen = scan_date, false) AS listed,
         coalesce(regexp_matches(lower(latest), '^\\s*(yes|y|true)\\s*$'), false) AS is_latest
  FROM keyed WHERE scan_no IS NOT NULL
)"""

_SQUEEZE = "regexp_replace(coalesce({0}, ''), '[\\s\\p{{Z}}\\p{{Cf}}\\p{{Cc}}™®]+', '', 'g')"

P3_SQL = (
    "WITH "
    + _KEYED
    + """,
kept AS (
  SELECT * FROM rows_ QUALIFY row_number() OVER (PARTITION BY k_url, k_page, scan_no ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1
),
units AS (
  SELECT *, scan_no - row_number() OVER (PARTITION BY k_url, k_page, is_latest ORDER BY scan_no) AS island FROM kept WHERE listed
),
runs AS (
  SELECT k_url, k_page, is_latest, min(scan_no) AS lo, max(scan_no) AS hi, min(scan_date) AS d_lo, max(scan_date) AS d_hi,
         arg_min(coalesce(trim(first_seen), ''), scan_no) AS opened
  FROM units GROUP BY k_url, k_page, is_latest, island
)
SELECT k_url AS url, k_page AS page, CASE WHEN is_latest THEN 'yes' ELSE 'no' END AS latest,
       CASE WHEN lo = (SELECT min(scan_no) FROM listings) AND opened <> '' THEN opened ELSE d_lo END AS valid_from,
       CASE WHEN hi = (SELECT max(scan_no) FROM listings) THEN '' ELSE d_hi END AS valid_to
FROM runs"""
)

P4_SQL = (
    "WITH "
    + _KEYED
    + f""",
docs AS (
  SELECT 'listings' AS ledger, k_url AS key_a, k_page AS key_b, scan_no, listed, {_SQUEEZE.format('title')} AS body
  FROM rows_ QUALIFY row_number() OVER (PARTITION BY k_url, k_page, scan_no ORDER BY loaded_at DESC NULLS LAST, row_id DESC) = 1
),
pages AS (
  SELECT 'snapshots' AS ledger, coalesce(name, '') AS key_a, coalesce(site, '') AS key_b, scan_no, true AS listed,
         concat_ws('|', {_SQUEEZE.format('title')}, coalesce(status::varchar, '?'), coalesce(tables::varchar, '?'), coalesce("rows"::varchar, '?')) AS body
  FROM snapshots WHERE scan_no IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY coalesce(name, ''), coalesce(site, ''), scan_no ORDER BY loaded_at DESC NULLS LAST) = 1
),
units AS (SELECT * FROM docs WHERE listed UNION ALL SELECT * FROM pages),
joined AS (
  SELECT coalesce(a.ledger, b.ledger) AS ledger, coalesce(a.scan_no, b.scan_no + 1) AS scan_no,
         coalesce(a.key_a, b.key_a) AS key_a, coalesce(a.key_b, b.key_b) AS key_b, a.body AS now_, b.body AS was_
  FROM units a FULL JOIN units b ON a.ledger = b.ledger AND a.key_a = b.key_a AND a.key_b = b.key_b AND a.scan_no = b.scan_no + 1
)
SELECT ledger, scan_no::INTEGER AS scan_no, key_a, key_b,
       CASE WHEN was_ IS NULL THEN 'added' WHEN now_ IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM joined
WHERE scan_no BETWEEN 2 AND (SELECT max(scan_no) FROM listings) AND (was_ IS NULL OR now_ IS NULL OR was_ <> now_)"""
)


_BLANK = "[\\s\\p{Z}\\x{85}]"
_DIVIDES = f"{_BLANK}+(?:and|or|&){_BLANK}+|{_BLANK}+/{_BLANK}+|[,;|\\t\\r\\n]"
#: Quoted and bracketed parts, delimiters and single characters of a cell in turn; delimiters become chr(1), on which it is split.
P1_SQL = f"""WITH c AS (SELECT 'ap_firmware' AS source_table, row_id, supported_fw_versions AS cell FROM ap_firmware UNION ALL SELECT 'eos_notices', row_id, replacement_product FROM eos_notices),
f AS (SELECT source_table, row_id, cell || ' ' AS cell FROM c WHERE cell IS NOT NULL AND lower(regexp_replace(cell, '{_BLANK}+', '', 'g')) NOT IN ('', 'n/a', '-')),
t AS (SELECT *, regexp_extract_all(cell, '"(?:[^"]|"")*"|''[^'']*''|“[^”]*”|\\([^()]*\\)|{_DIVIDES}|[\\s\\S]') AS parts FROM f),
p AS (SELECT source_table, row_id, string_split(array_to_string(list_transform(parts, lambda x: CASE WHEN regexp_full_match(x, '{_DIVIDES}') THEN chr(1) ELSE x END), ''), chr(1)) AS pieces FROM t),
q AS (SELECT source_table, row_id, list_transform(pieces, lambda x: regexp_replace(x, '^{_BLANK}+|{_BLANK}+$', '', 'g')) AS pieces FROM p),
u AS (SELECT source_table, row_id, list_transform(pieces, lambda x: CASE WHEN regexp_full_match(x, '"(?:[^"]|"")*"') THEN replace(substr(x, 2, length(x) - 2), '""', '"')
  WHEN regexp_full_match(x, '''[^'']*''|“[^”]*”') THEN substr(x, 2, length(x) - 2) ELSE x END) AS pieces FROM q),
v AS (SELECT source_table, row_id, list_filter(list_transform(pieces, lambda x: trim(regexp_replace(x, '{_BLANK}+', ' ', 'g'), ' ')), lambda x: x <> '') AS vals FROM u)
SELECT source_table, row_id, unnest(range(1, len(vals) + 1))::INTEGER AS pos, unnest(vals) AS val FROM v"""

P6_SQL = """WITH r AS (SELECT DISTINCT file_id, record FROM support_rows), f AS (SELECT file_id, min(table_name) AS t, min(scan_no) AS s FROM support_rows GROUP BY file_id),
p AS (SELECT * FROM (SELECT file_id, lag(file_id) OVER (PARTITION BY t ORDER BY s, file_id) AS prev FROM f) WHERE prev IS NOT NULL),
c AS (SELECT r.file_id, r.record AS line, trim(regexp_replace(lower(e.key), '\\s+', ' ', 'g')) AS name,
  CASE WHEN e.type = 'VARCHAR' THEN 'text' WHEN e.type = 'BOOLEAN' THEN 'flag' WHEN e.type IN ('ARRAY', 'OBJECT') THEN lower(e.type) WHEN e.type <> 'NULL' THEN 'number' END AS kind,
  CASE WHEN e.type <> 'NULL' THEN e.value::VARCHAR END AS val FROM r, json_each(r.record) e),
n AS (SELECT file_id, count(*) AS lines FROM r GROUP BY file_id),
cols AS (SELECT file_id, name, list_sort(list(DISTINCT kind) FILTER (WHERE kind IS NOT NULL)) AS kinds, count(val) > 0 AND count(val) = count(DISTINCT val) AND count(val) >= 0.9 * min(lines) AS ident FROM c JOIN n USING (file_id) GROUP BY file_id, name),
was AS (SELECT p.file_id, cols.name, cols.kinds, cols.ident FROM p JOIN cols ON cols.file_id = p.prev), now_ AS (SELECT p.file_id, cols.name, cols.kinds, cols.ident FROM p JOIN cols ON cols.file_id = p.file_id),
gone AS (SELECT * FROM was ANTI JOIN now_ USING (file_id, name)), come AS (SELECT * FROM now_ ANTI JOIN was USING (file_id, name)),
torn AS (SELECT DISTINCT file_id FROM gone SEMI JOIN come USING (file_id)),
anchors AS (SELECT a.file_id, a.name AS x, b.name AS y FROM was a JOIN now_ b ON a.file_id = b.file_id AND a.name = b.name SEMI JOIN torn ON torn.file_id = a.file_id WHERE a.ident AND b.ident
  UNION ALL SELECT g.file_id, g.name, h.name FROM gone g JOIN come h ON g.file_id = h.file_id WHERE g.ident AND h.ident),
links AS (SELECT a.file_id, p.prev, a.x, a.y, o.line AS old_line, w.line AS new_line FROM anchors a JOIN p ON p.file_id = a.file_id
  JOIN c o ON o.file_id = p.prev AND o.name = a.x AND o.val IS NOT NULL JOIN c w ON w.file_id = a.file_id AND w.name = a.y AND w.val = o.val),
best AS (SELECT * FROM (SELECT file_id, x, y, count(*) AS n FROM links GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY n DESC, x = y DESC, x, y) = 1),
ren AS (SELECT l.file_id, g.name AS old_name, h.name AS new_name FROM links l SEMI JOIN best b ON b.file_id = l.file_id AND b.x = l.x AND b.y = l.y
  JOIN gone g ON g.file_id = l.file_id JOIN come h ON h.file_id = l.file_id
  JOIN c o ON o.file_id = l.prev AND o.name = g.name AND o.line = l.old_line AND o.val IS NOT NULL JOIN c w ON w.file_id = l.file_id AND w.name = h.name AND w.line = l.new_line AND w.val IS NOT NULL
  GROUP BY ALL HAVING avg((o.val = w.val)::INTEGER) >= 0.8)
SELECT file_id, 'renamed' AS change, old_name, new_name FROM ren
UNION ALL SELECT file_id, 'added', '', name FROM come WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.file_id = come.file_id AND ren.new_name = come.name)
UNION ALL SELECT file_id, 'removed', name, '' FROM gone WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.file_id = gone.file_id AND ren.old_name = gone.name)
UNION ALL SELECT a.file_id, 'retyped', a.name, a.name FROM was a JOIN now_ b ON a.file_id = b.file_id AND a.name = b.name WHERE len(a.kinds) > 0 AND len(b.kinds) > 0 AND a.kinds <> b.kinds"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_SQL, "p3_found": P3_SQL, "p4_found": P4_SQL, "p6_found": P6_SQL}
