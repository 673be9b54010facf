"""The pN_ queries of the problems for training data, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.canonical import map_to_entries
from ledgerloom.llm.leaks import find_leaks, remove_leaks
from ledgerloom.llm.packing import CAPACITY, pack_texts, token_lengths
from ledgerloom.llm.subjects import subjects_of
from ledgerloom.session import cut_lineage, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_mapped(spark, sf_dir).select("source_table", "row_id", "entry_id")


def p5_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = [
        table(spark, sf_dir, name).select(F.lit(name).alias("source_table"), "row_id", F.col(field).alias("value"))
        for name, field in (("recommendations", "platform"), ("datasheets", "product"))
    ]
    return map_to_entries(typed[0].unionByName(typed[1]), table(spark, sf_dir, "entries"), ["source_table", "row_id"])


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(table(spark, sf_dir, "documents"))


def p7_harmonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(table(spark, sf_dir, "documents"), harmonic=True)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p8_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), every=True)


def p8_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test items that leaked, with how many documents hold them and how much of them at most."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that no entry was found for, with how often each is written."""
    return p5_mapped(spark, sf_dir).where("entry_id = 0").groupBy("value").agg(F.count("*").alias("n"))


def p5_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How rows of each table were decided: by an exact model number, by ranking entries, or not at all; and their share."""
    n = p5_mapped(spark, sf_dir).groupBy("source_table", "how").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source_table")), 4))


def p7_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What packing must never do, counted: tokens lost or doubled, texts divided that fit, containers overfull, texts that overlap.

    container places come from p7_packed; a text's tokens are counted anew.
    """
    documents = table(spark, sf_dir, "documents")
    held = cut_lineage(pack_texts(documents))
    measured = token_lengths(documents, "doc_id", "text").groupBy("doc_id").agg(F.sum("tokens").alias("all"))
    pieces = held.groupBy("doc_id").agg(F.sum("tokens").alias("packed"), F.count("*").alias("pieces"))
    met = measured.join(pieces.hint("merge"), "doc_id", "full_outer")
    texts = met.agg(
        F.count_if(~F.col("all").eqNullSafe(F.col("packed"))).alias("lost"), F.count_if((F.col("all") <= CAPACITY) & (F.col("pieces") > 1)).alias("divided")
    )
    sums = held.where("container IS NOT NULL").groupBy("container").agg(F.sum("tokens").alias("filled"), F.max(F.col("offset") + F.col("tokens")).alias("end"), F.count_distinct("offset").alias("places"), F.count("*").alias("n"))
    full = sums.agg(F.count_if(F.col("filled") > CAPACITY).alias("overfull"), F.count_if((F.col("places") < F.col("n")) | (F.col("end") > CAPACITY) | (F.col("end") < F.col("filled"))).alias("overlapping"))
    return texts.unpivot([], ["lost", "divided"], "fault", "n").unionByName(full.unpivot([], ["overfull", "overlapping"], "fault", "n"))


def p8_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks that p8_cleaned leaves, of which there must be none, and documents it loses or adds."""
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    clean = cut_lineage(remove_leaks(documents, items))
    left = find_leaks(clean, items).agg(F.count("*").alias("n")).select(F.lit("leaks left").alias("fault"), "n")
    ids = documents.groupBy("doc_id").agg(F.count("*").alias("a")).join(clean.groupBy("doc_id").agg(F.count("*").alias("b")).hint("merge"), "doc_id", "full_outer")
    return left.unionByName(ids.agg(F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n")).select(F.lit("documents lost or added").alias("fault"), "n"))


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by subject: documents, and the sum of their shares of sentences."""
    return p9_shares(spark, sf_dir).groupBy("subject_id").agg(F.count("*").alias("documents"), F.round(F.sum("share"), 6).alias("weight"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_shares(spark, sf_dir).select("doc_id", "subject_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subjects"), table(spark, sf_dir, "subject_labels"))


def queries() -> dict:
    return {
        "p5_found": p5_found,
        "p5_unmatched": p5_unmatched,
        "p5_decisions": p5_decisions,
        "p7_packed": p7_packed,
        "p7_harmonic": p7_harmonic,
        "p7_faults": p7_faults,
        "p8_found": p8_found,
        "p8_stretches": p8_stretches,
        "p8_cleaned": p8_cleaned,
        "p8_items": p8_items,
        "p8_remaining": p8_remaining,
        "p9_found": p9_found,
        "p9_shares": p9_shares,
        "p9_composition": p9_composition,
    }


#: The same matching by comparing every word with every word of the list.
P5_SQL = """WITH typed AS (SELECT 'recommendations' AS source_table, row_id, platform AS value FROM recommendations UNION ALL SELECT 'datasheets', row_id, product FROM datasheets),
filled AS (SELECT * FROM typed WHERE regexp_replace(coalesce(value, ''), '[\\s\\p{Z}\\p{Cf}]+', '', 'g') <> ''),
b AS (SELECT DISTINCT value, regexp_replace(value, '[\\x{200B}-\\x{200D}\\x{2060}\\x{FEFF}\\x{00AD}\\x{2122}\\x{00AE}]', '', 'g') AS bare FROM filled),
m AS (SELECT value, bare, lower(regexp_replace(regexp_extract(bare, '(?i)lp[\\s\\p{Z}-]*[0-9]{3}[\\s\\p{Z}-]*[a-z]{0,2}\\b'), '[\\s\\p{Z}-]', '', 'g')) AS lp, regexp_extract(bare, '(?:^|[^0-9])([0-9]{4})(?:[^0-9]|$)', 1) AS num FROM b),
models AS (SELECT min(entry_id) AS entry_id, lower(regexp_extract(entry, 'LP[0-9]+[A-Za-z]*|[0-9]{4}')) AS model FROM entries WHERE regexp_matches(entry, '[0-9]{3}') GROUP BY 2),
w AS (SELECT value, unnest(list_distinct(regexp_extract_all(lower(regexp_replace(bare, '([a-z])([A-Z])([a-zA-Z]{2})', '\\1 \\2\\3', 'g')), '\\p{L}+\\.?'))) AS word FROM m WHERE lp = '' AND num = ''),
named AS (SELECT entry_id, entry, unnest(list_distinct(string_split(lower(entry), ' '))) AS part FROM entries WHERE NOT regexp_matches(entry, '[0-9]{3}')),
near AS (SELECT DISTINCT w.value, v.part FROM w JOIN (SELECT DISTINCT part FROM named) v ON (levenshtein(rtrim(word, '.'), part) <= 1 AND length(part) >= 3)
  OR (levenshtein(rtrim(word, '.'), part) <= 2 AND (length(part) >= 5 OR list_sort(string_split(rtrim(word, '.'), '')) = list_sort(string_split(part, '')))) OR (ends_with(word, '.') AND starts_with(part, rtrim(word, '.')))),
whole AS (SELECT value, min(entry_id) AS entry_id FROM (SELECT near.value, named.entry_id FROM near JOIN named USING (part) GROUP BY near.value, named.entry_id, named.entry HAVING count(*) = len(list_distinct(string_split(lower(named.entry), ' ')))) GROUP BY value),
glued AS (SELECT w.value, min(e.entry_id) AS entry_id FROM w JOIN (SELECT DISTINCT entry_id, replace(lower(entry), ' ', '') AS run FROM named) e ON levenshtein(rtrim(w.word, '.'), e.run) <= 2 GROUP BY w.value)
SELECT f.source_table, f.row_id, coalesce(CASE WHEN m.lp <> '' OR m.num <> '' THEN models.entry_id ELSE coalesce(whole.entry_id, glued.entry_id) END, 0)::BIGINT AS entry_id
FROM filled f JOIN m ON m.value = f.value LEFT JOIN models ON models.model = CASE WHEN m.lp <> '' THEN m.lp ELSE m.num END LEFT JOIN whole ON whole.value = f.value LEFT JOIN glued ON glued.value = f.value"""


_P5_WITH, _P5_LAST = P5_SQL.rsplit("\nSELECT ", 1)
P5_UNMATCHED_SQL = f"{_P5_WITH}, mapped AS (SELECT f.value, {_P5_LAST}) SELECT value, count(*) AS n FROM mapped WHERE entry_id = 0 GROUP BY value"
P5_DECISIONS_SQL = f"""{_P5_WITH}, mapped AS (SELECT (m.lp <> '' OR m.num <> '') AS numbered, {_P5_LAST}),
told AS (SELECT source_table, CASE WHEN entry_id = 0 THEN 'none' WHEN numbered THEN 'model' ELSE 'ranking' END AS how FROM mapped)
SELECT source_table, how, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY source_table), 4) AS share FROM told GROUP BY source_table, how"""


def oracle_sql() -> dict[str, str]:
    none = lambda *faults: "SELECT unnest([" + ", ".join(f"'{f}'" for f in faults) + "]) AS fault, 0::BIGINT AS n"
    return {
        "p5_found": P5_SQL,
        "p5_unmatched": P5_UNMATCHED_SQL,
        "p5_decisions": P5_DECISIONS_SQL,
        "p7_faults": none("lost", "divided", "overfull", "overlapping"),
        "p8_remaining": none("leaks left", "documents lost or added"),
    }
