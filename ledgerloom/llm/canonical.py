"""Free-entered values to a canonical list: token repair by edit distance, soft TF-IDF over the repaired tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import cut_lineage

#: Digits in a row that make a token a model number. Model numbers are never repaired.
MODEL = r"\d{3,}"
#: Largest edit distance at which a token is repaired, and the word length from which it applies (one edit from three).
EDITS, LONG = 2, 5


def words_of(c: Column) -> Column:
    """Lower-case words. Camel case and words glued to a number are parted; marks, blanks and punctuation divide."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\u200B-\u200D\u2060\uFEFF\u00AD\u2122\u00AE]", "")
    parted = F.regexp_replace(bare, r"(\p{Ll})(\p{Lu})(?=\p{L}{2})", "$1 $2")
    lower = F.lower(F.regexp_replace(parted, r"(?U)[\W_&&[^.]]+", " "))
    glued = F.regexp_replace(lower, r"(?<=\p{L}{4})(?=\d)|(?<=\d{3})(?=\p{L}{3})", " ")  # only edges are matched, so long words cost no more
    return F.filter(F.split(F.regexp_replace(glued, r"\.(?=[^ ])", " "), r" +"), lambda w: (w != "") & (w != "."))


def _plain(word: Column) -> Column:
    return F.rtrim(word, F.lit("."))


def _without_one(word: Column) -> Column:
    places = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))


def deletions(word: Column) -> Column:
    """What two words that may be taken for one another share at least one of: the word with some characters left out.

    A word of up to two letters stands for itself, so that no variant is a single letter or empty. Below LONG one
    character is left out, and the sorted letters stand for exchanged ones; from LONG on up to EDITS are left out.
    """
    once = F.array_distinct(F.flatten(F.transform(F.array(word), _without_one)))
    twice = F.array_distinct(F.flatten(F.transform(once, _without_one)))
    jumbled = F.concat(F.lit("~"), F.array_join(F.array_sort(F.split(word, "")), ""))
    short, long = F.concat(F.array(word, jumbled), once), F.concat(F.array(word), once, twice)
    return F.array_distinct(F.when(F.length(word) < 3, F.array(word)).when(F.length(word) < LONG, short).otherwise(long))


def model_candidates(words: Column) -> Column:
    """Every run of up to three adjacent words that holds a model number, written together."""
    plain = F.transform(words, _plain)
    starts = F.sequence(F.lit(1), F.greatest(F.size(plain), F.lit(1)))


    def together(n: int) -> Column:
        return F.transform(starts, lambda i: F.array_join(F.slice(plain, i, F.lit(n)), ""))

    return F.filter(F.array_distinct(F.concat(together(1), together(2), together(3))), lambda w: w.rlike(MODEL))


def _squared(c: Column) -> Column:
    return c * c


def canonical_entries(values: DataFrame, entries: DataFrame, value: str = "value", entry_id: str = "entry_id", entry: str = "entry") -> DataFrame:
    """value -> entry_id for each distinct value that has one: value, entry_id, score, how (model: the check asked for a
    model number; ranking: for words).

    Every value goes the same way: its words are repaired to words of the list (up to EDITS edits, a prefix, or words run
    together), all entries that share one are ranked by soft TF-IDF, and the best one that passes an exact check is taken;
    of equal ones the smaller entry_id. A model number is a word that is never repaired, though it may be written apart
    or together. The check: an entry with a model number needs it and no other word, and is never compared with a value
    without one, nor other entries with a value that has one; these need every one of their words, in any order. Words
    of a value that belong to no entry don't count.
    Blank and NULL values have no entry; repeated values and repeated entries change nothing; a word longer than any
    entry allows cannot match and is passed over before its variants are made.

    Words meet the vocabulary through shared deletion variants, an equi-join; no pair is compared that shares none.
    """
    distinct = cut_lineage(values.select(F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct().select("value", words_of(F.col("value")).alias("words")))
    listed = entries.where(F.col(entry_id).isNotNull()).select(F.col(entry_id).cast("bigint").alias("entry_id"), F.transform(words_of(F.col(entry)), _plain).alias("words"))
    listed = listed.groupBy("words").agg(F.min("entry_id").alias("entry_id")).where(F.size("words") > 0)

    is_model = lambda w: w.rlike(MODEL)
    numbered = F.exists("words", is_model)

    # The vocabulary. Surfaces are the entries' words and their adjacent words run together; model numbers have none.
    size = listed.agg(F.count("*").alias("all"), F.max(F.length(F.array_join(F.filter("words", lambda w: ~is_model(w)), ""))).alias("longest")).head()  # of the reference list
    vocabulary = listed.select("entry_id", numbered.alias("numbered"), F.explode(F.array_distinct("words")).alias("word"))
    weights = vocabulary.groupBy("word").agg(F.count("*").alias("df")).select("word", F.log1p(F.lit(size["all"]) / F.col("df")).alias("idf"))
    entry = Window.partitionBy("entry_id")
    postings = vocabulary.join(weights, "word").withColumn("norm", F.sum(_squared(F.col("idf"))).over(entry)).withColumn("words", F.count("*").over(entry))
    starts = F.sequence(F.lit(1), F.size("words"))
    grams = F.flatten(F.transform(starts, lambda i: F.transform(starts, lambda n: F.slice("words", i, n))))
    surfaces = listed.select(numbered.alias("numbered"), F.explode(grams).alias("parts")).where(~F.exists("parts", is_model)).distinct().select("numbered", F.array_join("parts", "").alias("surface"), "parts")

    written = distinct.select("value", numbered.alias("numbered"), F.explode(F.array_distinct(F.filter("words", lambda w: ~is_model(w)))).alias("word"))
    tokens = written.select("numbered", "word").distinct().select("numbered", "word", _plain(F.col("word")).alias("plain")).where(F.length("plain").between(2, (size["longest"] or 0) + EDITS))
    apart = F.levenshtein(F.col("plain"), F.col("surface"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    near = (apart <= 1) & (F.length("surface") >= 3) | (apart <= EDITS) & ((F.length("surface") >= LONG) | (letters(F.col("plain")) == letters(F.col("surface"))))
    edited = (
        tokens.select("numbered", "word", "plain", F.explode(deletions(F.col("plain"))).alias("variant"))
        .join(surfaces.select("numbered", "surface", "parts", F.explode(deletions(F.col("surface"))).alias("variant")), ["numbered", "variant"])
        .select("numbered", "word", "plain", "surface", "parts")
        .distinct()
        .where(near | (apart == 0))
        .select("numbered", "word", "parts", apart.cast("double").alias("cost"), (1 - apart / F.greatest(F.length("plain"), F.length("surface"))).alias("likeness"))
    )
    heads = surfaces.where(F.size("parts") == 1).select("numbered", "parts", F.explode(F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.length("surface") - 1)), lambda n: F.substring(F.col("surface"), F.lit(1), n))).alias("plain"))
    lone = heads.groupBy("numbered", "plain").agg(F.count("*").alias("n"), F.first("parts").alias("parts")).where("n = 1")
    cut = tokens.where(F.col("word").endswith(".") | (F.length("plain") >= 4)).join(lone, ["numbered", "plain"]).select("numbered", "word", "parts", F.lit(EDITS + 0.5).alias("cost"), F.lit(0.8).alias("likeness"))
    repairs = edited.unionByName(cut).withColumn("_r", F.rank().over(Window.partitionBy("numbered", "word").orderBy("cost"))).where("_r = 1")
    repaired = repairs.select("numbered", "word", F.explode("parts").alias("part"), "likeness").groupBy("numbered", "word", "part").agg(F.max("likeness").alias("likeness"))

    # Model numbers of the list, exactly as written.
    models = weights.where(is_model(F.col("word"))).select("word")
    exact = distinct.where(numbered).select("value", F.lit(True).alias("numbered"), F.explode(model_candidates(F.col("words"))).alias("word")).join(models, "word").select("value", "numbered", "word", F.lit(1.0).alias("likeness"))

    held = written.join(repaired, ["numbered", "word"]).select("value", "numbered", F.col("part").alias("word"), "likeness").unionByName(exact)
    held = held.groupBy("value", "numbered", "word").agg(F.max("likeness").alias("likeness"))
    ranked = held.join(postings, ["numbered", "word"]).groupBy("value", "numbered", "entry_id").agg(
        F.round(F.sum(F.col("likeness") * _squared(F.col("idf"))) / F.sqrt(F.first("norm")), 9).alias("score"),
        F.count_if(is_model(F.col("word"))).alias("models"), F.count("*").alias("met"), F.first("words").alias("needs"),
    )
    checked = ranked.where(F.when(F.col("numbered"), F.col("models") > 0).otherwise(F.col("met") == F.col("needs")))
    best = checked.groupBy("value").agg(F.max(F.struct("score", (-F.col("entry_id")).alias("minus"), "numbered")).alias("top"))
    how = F.when(F.col("top.numbered"), "model").otherwise("ranking")
    return best.select("value", (-F.col("top.minus")).alias("entry_id"), F.col("top.score").alias("score"), how.alias("how"))


def map_to_entries(rows: DataFrame, entries: DataFrame, keep: list[str], value: str = "value") -> DataFrame:
    """Each row whose value is not blank, with its entry_id or 0: the columns in `keep`, value, entry_id, how (none if 0).

    Matching is done once per distinct value; rows are joined back on the value, where adaptive execution splits the
    partition of a value that holds many of them.
    """
    filled = rows.where(F.length(F.regexp_replace(F.coalesce(F.col(value), F.lit("")), r"(?U)[\s\p{Z}\p{Cf}]+", "")) > 0).select(*keep, F.col(value).alias("value"))
    found = canonical_entries(filled, entries)
    return filled.join(found.select("value", "entry_id", "how"), "value", "left").select(
        *keep, "value", F.coalesce("entry_id", F.lit(0)).cast("bigint").alias("entry_id"), F.coalesce("how", F.lit("none")).alias("how")
    )
