import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import subjects as module
from ledgerloom.llm.subjects import Lexicon, calibrated, curated_terms, fit_terms, learned_terms, plain_text, sentence_subjects, subjects_of
from ledgerloom.session import table

SUBJECTS = [(1, "switching and routing", ""), (3, "security", ""), (9, "sport and venues", ""), (50, "gardening", "Flowers, hedges and compost"), (None, "x", "")]
ROUTING = "The routing table learns the address on 3/4. "
PLAIN = "Table 7 lists the details. "


def test_sentences():
    text, ends = plain_text("## Heading\n\nOne  is\xa0here 5.1.8. Two\nis there!\n\nPage 2 of 8\n\nThree?")
    assert text == " one is here #. two is there!  three? " and len(ends) == 3
    terms = curated_terms(tuple(SUBJECTS[:4]))
    lexicon = Lexicon(terms)
    assert lexicon.sentences(None) == (0, []) and lexicon.sentences("no stop") == (0, [])
    n, sets = lexicon.sentences("With power users in mind, for a match of old and new builds, wait. Every spanning tree converges on another root.")
    about = [sentence_subjects(s, [t[0] for t in terms], [t[1] for t in terms]) for s in sets]
    assert n == 2 and [a for a in about if a] == [(1,)]
    assert Lexicon(()).sentences("One. Two.") == (2, []) and lexicon.sentences("VLAN, (vlan). " + "x " * 500_000 + "vlan.")[0] == 2


def test_terms_are_weighed_and_learned_from_labels():
    """A curated term that every document uses loses its weight; words of labelled documents' own sentences are learned."""
    terms = curated_terms(((1, "switching and routing", ""), (3, "security", "")))
    texts, labelled = [], []
    for i in range(120):
        subject = (1, 3)[i % 2]
        own = ["The blorb of site # rests." if subject == 1 else "A zindle stops the wump.", "Every vlan has a subnet." if subject == 1 else "The attacker guessed a password."]
        texts.append(" ".join([*own * 2, "Bring your own firewall paint.", f"Table {i} lists it all.", "Plain words stand here."] * 2))
        labelled.append({subject} if i % 10 else {1, 3})
    weight = {(s, t): w for s, w, t in fit_terms(texts, labelled, terms)}
    assert weight[1, " blorb "] == weight[3, " zindle "] == 2.0 and weight[1, " vlan"] == 2.0
    assert weight.get((3, " firewall"), 0) < 0.5 and not any(t.strip() in ("table", "plain", "lists") for _, t in weight)
    assert fit_terms([], [], terms) == list(terms) and fit_terms([None, "", "no stop"], [{1}, set(), {99}], terms) == list(terms)


def test_subjects(spark):
    docs = {
        1: ROUTING * 2 + PLAIN * 9, 2: ROUTING + PLAIN * 9, 3: ROUTING * 3 + "An attacker reads the session token. " * 3 + PLAIN * 3, 4: None, 5: "", 6: "vlan vlan vlan",
        7: PLAIN * 4, 8: "Compost the hedges and flowers. ", 9: (ROUTING + PLAIN * 3) * 3000, 10: "By design, nothing. On the way to the next goal.",
    }
    df = spark.createDataFrame([(i, t) for i, t in docs.items()] + [(1, docs[1])], "doc_id long, text string").withColumn("subject_id", F.lit("clash")).withColumn("sets", F.lit(1))
    subjects = spark.createDataFrame(SUBJECTS, "subject_id long, subject string, description string")
    labels = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (2, None, "b"), (None, 1, "c"), (3, 9, "d")], "doc_id long, subject_id long, labelled_by string")
    for known in (labels, labels.limit(0), None):
        got = sorted((r["doc_id"], r["subject_id"]) for r in subjects_of(df, subjects, known).collect())
        assert got == [(1, 1), (1, 1), (3, 1), (3, 3), (8, 50), (9, 1)]
    assert subjects_of(df.limit(0), subjects, labels).collect() == [] and subjects_of(df, subjects.limit(0), labels).collect() == []


def test_calibration_moves_only_with_evidence(spark):
    shares = spark.createDataFrame([(i, 1, 2, 0.155 if i % 2 else 0.18) for i in range(400)], "doc_id long, subject_id long, hits int, share double")
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, subject_id long")
    assert 0.15 < calibrated(shares, labels, "doc_id", "subject_id")[1] <= 0.155
    assert calibrated(shares, labels.where("doc_id % 2 = 0"), "doc_id", "subject_id") == {}


def test_held_out_labels(spark, sf_dir):
    """Hand labels are wrong now and then; most must be met and few subjects added."""
    found = {tuple(r) for r in subjects_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "subjects")).select("doc_id", "subject_id").collect()}
    labels = {tuple(r) for r in table(spark, sf_dir, "subject_labels").where("subject_id IS NOT NULL").select("doc_id", "subject_id").collect()}
    docs = {d for d, _ in labels}
    assert len(labels & found) >= 0.85 * len(labels)
    assert len({f for f in found if f[0] in docs} & labels) >= 0.85 * len({f for f in found if f[0] in docs})


def by_hash(spark, n):
    """Document ids in the order of their hash."""
    return [r[0] for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]


def test_terms_are_learned_from_every_labelled_document(spark):
    """A word that stands only in the labelled documents with the highest hashes is learned too, and rows may be spread in any way."""
    terms = curated_terms(((1, "switching and routing", ""), (3, "security", "")))
    docs = [(i, f"The {'blorb' if n >= 4_050 else 'plain'} of site 4 rests. Every vlan has a subnet. Table 7 lists it." if n % 2 else "The attacker guessed a password. Table 7 lists it.", 1 if n % 2 else 3) for n, i in enumerate(by_hash(spark, 4_100))]
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, s) for i, _, s in docs], "doc_id long, subject_id long")
    found = learned_terms(df.unionByName(df.limit(50)).repartition(5), labels, terms)
    assert (1, 2.0, " blorb ") in found
    inorder = sorted(docs)
    assert list(found) == sorted(fit_terms([t for _, t, _ in inorder], [{s} for _, _, s in inorder], terms))
    assert learned_terms(df, labels.limit(0), terms) == terms and learned_terms(df.limit(0), labels, terms) == terms


def test_thresholds_are_told_by_every_labelled_document(spark):
    """Only the labelled documents with the highest hashes say that the threshold is too high."""
    ids = by_hash(spark, 24_000)
    shares = spark.createDataFrame([(i, 1, 2, 0.155 if n >= 20_000 else 0.2) for n, i in enumerate(ids)], "doc_id long, subject_id long, hits int, share double")
    assert 0.15 < calibrated(shares, spark.createDataFrame([(i, 1) for i in ids], "doc_id long, subject_id long"), "doc_id", "subject_id")[1] <= 0.155


def slow_plain(text):
    """`plain_text` said with patterns alone."""
    text, parts, ends, at = re.sub("[\u00ad\u200b-\u200d\u2060\ufeff]", "", text), [], [], 0
    for paragraph in re.split(r"\n[ \t\r\xa0]*\n\s*", re.sub(r"\d+(?:[./:]\d+)*", "#", text.lower().replace("\r\n", "\n"))):
        line = f" {' '.join(paragraph.split())} "
        found = [at + m.end() for m in re.finditer(r"[.!?][\"'”»)]*(?= )", line)]
        if found:
            parts, ends, at = [*parts, line], ends + found, at + len(line)
    return "".join(parts), ends


def odd_texts(n):
    rng = random.Random(5)
    bits = ["vlan", "Firewall", "spanning tree", "spanning, tree", "3.4", "٣.5", "12:30/", "#", "x-y", "don't", "Ünïcode", "\u200b", "İ", ".", "!", "?”", ".)", ". ", ",", " ", "  ", "\n", "\n \n", "\r\n\r\n", "\t", "\xa0", "\x1f", "\x0c", "\u2003", "the", "attacker", "root."]
    return [None, "", "no stop", "One. Two left", "vlan", *("".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(n))]


def test_many_texts_at_once_are_read_as_each_alone(monkeypatch):
    """Sentences, terms, words and pairs, however texts are put together."""
    terms = (*curated_terms(((1, "switching and routing", ""), (3, "security", ""))), (1, 2.0, " the attacker "), (3, 0.6, " the attacker "), (3, 2.0, "ünï"))
    lexicon, texts = Lexicon(terms), odd_texts(400)
    sentences, hits, features = [], [], []
    for text in texts:
        plain, ends = plain_text(text or "")
        assert (plain, ends) == slow_plain(text or "")
        flat = re.sub("[.,;:!?()\\[\\]{}<>|*_\"'“”„‘’«»`~…–—•]", " ", plain)
        own = [flat[a:b] for a, b in zip([0, *ends], ends)]
        sentences.append(len(own))
        hits += [[t for t, (_, _, term) in enumerate(terms) if term in sentence + " "] for sentence in own]
        words = [[part.split() for part in sentence.split("  ")] for sentence in own]
        features += [{f" {w} " for part in parts for w in part} | {f" {a} {b} " for part in parts for a, b in zip(part, part[1:])} for parts in words]
    for most in (1, 500, 1 << 20):
        monkeypatch.setattr(module, "SLICE_CHARS", most)
        got = lexicon.read(texts)
        assert got.sentences.tolist() == sentences and sum(map(bool, hits)) > 100
        assert list(zip(got.sent.tolist(), got.term.tolist())) == [(i, t) for i, held in enumerate(hits) for t in held]
    chunk = module.chunk_of(texts, [{1}] * len(texts), lexicon)
    edges = np.cumsum(chunk["sizes"])[:-1]
    assert [{chunk["features"][f] for f in held} for held in np.split(chunk["feats"], edges)] == features and len(chunk["feats"]) == sum(map(len, features))
    assert len(set(chunk["features"])) == len(chunk["features"])


def test_work_on_a_chunk_does_not_grow_with_all_features():
    """Sums over sentences have a row for each feature of the chunk, in the order of their numbers."""
    lexicon, column = Lexicon(curated_terms(((1, "switching and routing", ""),))), {1: 1}
    chunk = module.chunk_of(["One vlan here. Two here."], [{1}], lexicon)
    number = np.array([{" here ": 70_000, " one ": 5}.get(f, -1) for f in chunk["features"]])
    read = module.read_of(module.numbered(chunk, number), column)
    assert read.places.tolist() == [5, 70_000] and module.by_feature(read, np.array([[0.25, 0.75], [1.0, 0.0]])).tolist() == [[0.25, 0.75], [1.25, 0.75]]


def test_sentences_are_scored_once(spark):
    """Calibration and result read the same written shares; ids may be of any type."""
    docs = spark.createDataFrame([("a", ROUTING * 2 + PLAIN * 9), ("b", PLAIN), ("a", ROUTING), (None, ROUTING)], "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1), ("b", 3)], "doc_id string, subject_id long")
    found = subjects_of(docs, spark.createDataFrame(SUBJECTS, "subject_id long, subject string, description string"), labels)
    assert "MapIn" not in found._jdf.queryExecution().toString()
    assert sorted((r["doc_id"] or "", r["subject_id"], round(r["share"], 6)) for r in found.collect()) == [("", 1, 1.0), ("a", 1, round(2 / 11, 6)), ("a", 1, 1.0)]


def test_slices():
    assert [(s.start, s.stop) for s in module._slices([3, 0, 4, 9, 0, 1, 1], 5)] == [(0, 2), (2, 3), (3, 4), (4, 7)] and not list(module._slices([], 5))
