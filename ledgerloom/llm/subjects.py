"""Subject areas of documents: weighted terms by a multi-pattern automaton, normalised by rarity and length, thresholds calibrated.

The terms are a curated lexicon of each field. Where hand labels are given, all labelled documents say how far each curated
term can be trusted in this corpus, and what further words and pairs of words tell a subject.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from math import log1p
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.subject_terms import TERMS, split_terms
from ledgerloom.session import cut_lineage

#: Share of the sentences that makes a subject, before calibration; what calibration may move it by.
SHARE, LATITUDE = 1 / 6, 0.03
#: Weighted terms that make a sentence be about a subject.
SENTENCE = 1.0
#: Rounds of expectation maximisation; how much curated terms weigh when sentences are shared out before the first and second.
ROUNDS, _SEEDING = 5, {0: 2.0, 1: 1.0}
#: Labelled documents that are held as one row of numbers.
CHUNK_DOCS = 500
#: Characters and sentences, about, that are worked on at a time.
SLICE_CHARS, SLICE_SENTENCES = 1 << 20, 1 << 17
#: Documents a learned term must occur in at least (a curated one thrice as many to be weighed anew); the share of its sentences that must be about its subject
#: for it to count alone and in company; weights of both kinds.
LEARN_LEAST, LEARN_ALONE, LEARN_COMPANY = 3, 0.95, 0.7
#: A curated term of which a smaller share of sentences is about its subject is dropped.
LEARN_TRUST = 0.3
ALONE, COMPANY = 2.0, 0.6

Term = tuple[int, float, str]
Subjects = tuple[tuple[int, str, str], ...]

_INVISIBLE = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]")
_PARAGRAPH = re.compile(r"\n[ \t\r\xa0]*\n\s*")
_DIGITS, _ASCII_DIGITS = re.compile(r"\d\d*(?:[./:]\d+)*"), "[0-9]+(?:[./:][0-9]+)*"
_STOP = re.compile("[.!?]")
_END = re.compile(r"[.!?][\"'”»)]*(?= )")
_MARKS = re.compile("[.,;:!?()\\[\\]{}<>|*_\"'“”„‘’«»`~…–—•]")
_ASCII_BLANKED = bytes(ord(" ") if _MARKS.match(chr(i)) else i for i in range(256))


def _lowered(texts: Iterable[str]) -> list[str]:
    """Lower-case texts with numbers as #; those in ASCII all at once by Arrow, where no other digits need to be told."""
    low = [(text if text.isascii() else _INVISIBLE.sub("", text)).lower().replace("\r\n", "\n") for text in texts]
    plain = [i for i, text in enumerate(low) if text.isascii()]
    for i, text in zip(plain, pc.replace_substring_regex(pa.array([low[i] for i in plain], pa.string()), _ASCII_DIGITS, "#").to_pylist()):
        low[i] = text
    return [text if text.isascii() else _DIGITS.sub("#", text) for text in low]


def _sentences(lowered: str) -> tuple[str, list[int]]:
    parts, ends, at = [], [], 0
    for paragraph in _PARAGRAPH.split(lowered):
        if not _STOP.search(paragraph):
            continue
        # what can be printed has no white space but blanks
        line = f" {paragraph.strip(' ')} " if paragraph.isprintable() and "  " not in paragraph else f" {' '.join(paragraph.split())} "
        found = [at + m.end() for m in _END.finditer(line)]
        if found:
            parts.append(line)
            ends += found
            at += len(line)
    return "".join(parts), ends


def plain_text(text: str) -> tuple[str, list[int]]:
    """Lower-case text with numbers as #, single blanks and paragraphs parted, and where each sentence ends in it.

    Paragraphs without a full stop, such as headings and page numbers, hold no sentence; their terms count nowhere.
    """
    return _sentences(_lowered([text])[0])


def _unmarked(plain: str) -> str:
    return plain.encode().translate(_ASCII_BLANKED).decode() if plain.isascii() else _MARKS.sub(" ", plain)


def curated_terms(subjects: Subjects) -> tuple[Term, ...]:
    """The lexicon's terms of the subjects; one without a curated list has the words of its own name and description."""
    found: list[Term] = []
    for subject_id, name, description in subjects:
        listed = TERMS.get(" ".join(name.lower().split()))
        if listed is None:
            listed = {2.0: ", ".join(re.findall(r"[^\W\d_]{5,}", f"{name} {description}".lower()))}
        for weight, terms in listed.items():
            found += [(subject_id, float(weight), _DIGITS.sub("#", term)) for term in split_terms(terms)]
    return tuple(dict.fromkeys(found))


def _ints(values: Sequence[int]) -> np.ndarray:
    return np.asarray(values, dtype=np.int64)


def _spread(sizes: Sequence[int]) -> np.ndarray:
    """The number of its group for each of the members, given the sizes of groups."""
    return np.repeat(np.arange(len(sizes)), _ints(sizes))


def _slices(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Slices of members that follow one another, of about `most` in all or a single member each."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def _distinct(values: np.ndarray) -> np.ndarray:
    """In order, each once; np.unique tells integers apart by a hash table, which takes far longer on these."""
    values = np.sort(values)
    return values[np.diff(values, prepend=values[:1] - 1) > 0]


def _lists(values: np.ndarray, sizes: Sequence[int]) -> pa.ListArray:
    """A column of lists of these sizes."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(_ints(sizes))]), pa.int32()), pa.array(values, pa.int32()))


def flat_texts(texts: Iterable[str | None]) -> tuple[str, np.ndarray, np.ndarray]:
    """Texts in one without marks, each up to the end of its last sentence; where sentences end; how many each text has.

    A sentence ends in a mark, now a blank, and the next begins with a blank, so what holds single blanks is within one.
    """
    parts, ends, counts = [], [], []
    for lowered in _lowered(text or "" for text in texts):
        plain, found = _sentences(lowered)
        if found:
            parts.append(_unmarked(plain[: found[-1]]))
            ends += found
        counts.append(len(found))
    number, length = _ints(counts), _ints([len(p) for p in parts])
    return "".join(parts), _ints(ends) + np.repeat(np.cumsum(length) - length, number[number > 0]), number


class Hits(NamedTuple):
    """The number of sentences of each text; by sentence and number the terms in them, each once a sentence."""

    sentences: np.ndarray
    sent: np.ndarray
    term: np.ndarray


class Lexicon:
    """Weighted terms of all subjects in one automaton."""

    def __init__(self, terms: tuple[Term, ...]) -> None:
        self.terms = terms
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[int]] = defaultdict(list)
        for number, (_, _, term) in enumerate(terms):
            places[term].append(number)
        self.sizes, self.numbers = _ints([len(n) for n in places.values()]), _ints([*chain.from_iterable(places.values())])
        self.firsts = np.cumsum(self.sizes) - self.sizes
        for place, term in enumerate(places):
            self.automaton.add_word(term, place)
        if places:
            self.automaton.make_automaton()

    def hits(self, flat: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sentence and number of each term in texts as `flat_texts` gives them, each once a sentence."""
        if not len(ends) or not self.terms:
            return _ints([]), _ints([])
        end, place = np.fromiter(chain.from_iterable(self.automaton.iter(flat)), dtype=np.int64).reshape(-1, 2).T
        size = self.sizes[place]
        number = self.numbers[np.arange(size.sum()) + np.repeat(self.firsts[place] - np.cumsum(size) + size, size)]
        return np.divmod(_distinct(np.repeat(np.searchsorted(ends, end, "right"), size) * len(self.terms) + number), len(self.terms))

    def read(self, texts: Sequence[str | None]) -> Hits:
        counts, sents, numbers, before = [_ints([])], [_ints([])], [_ints([])], 0
        for part in _slices([len(t or "") for t in texts], SLICE_CHARS):
            flat, ends, count = flat_texts(texts[part])
            sent, number = self.hits(flat, ends)
            counts.append(count)
            sents.append(sent + before)
            numbers.append(number)
            before += len(ends)
        return Hits(np.concatenate(counts), np.concatenate(sents), np.concatenate(numbers))

    def sentences(self, text: str | None) -> tuple[int, list[tuple[int, ...]]]:
        """The number of sentences, and for each sentence with terms their numbers, each once."""
        hits = self.read([text])
        return int(hits.sentences[0]), [tuple(s.tolist()) for s in np.split(hits.term, np.flatnonzero(np.diff(hits.sent)) + 1) if len(s)]


@lru_cache(maxsize=4)
def lexicon_of(terms: tuple[Term, ...]) -> Lexicon:
    return Lexicon(terms)


class Read(NamedTuple):
    """The sentences of documents as arrays: for each its document and that one's labels, its features and curated terms.

    Features go by their place among those of the documents at hand, so that work on them does not grow with all others.
    """

    doc: np.ndarray
    labels: np.ndarray  # one row per sentence: the number of labels, and 1 for each subject labelled
    places: np.ndarray  # numbers of the features, in order
    sent: np.ndarray  # sentence and place in `places` of each feature it holds, in order
    feat: np.ndarray
    hit_sent: np.ndarray  # the same for curated terms
    hit: np.ndarray


class Counted(NamedTuple):
    """Features of all labelled documents: in how many documents and sentences, and in how many documents of each label."""

    names: list[str]
    docs: np.ndarray
    uses: np.ndarray
    tagged: np.ndarray  # column 0, that of no subject, is not used; so in labelled
    documents: int
    sentences: int
    labelled: np.ndarray


def chunk_of(texts: Iterable[str | None], labelled: Iterable[Iterable[int]], lexicon: Lexicon) -> dict:
    """Documents as flat lists: `features` they hold, and by place in it those of each sentence; curated terms; labels.

    Features are the words and pairs of adjacent words of a sentence without marks; marks part pairs.
    """
    flat, ends, count = flat_texts(texts)
    tokens = flat.split(" ")  # an empty one stands for each blank beyond the first
    number: dict[str, int] = defaultdict()
    number.default_factory = number.__len__
    number[""] = 0
    word = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    sent = np.searchsorted(ends, np.cumsum(size + 1) - size - 1, "right")
    names, first = list(number), np.flatnonzero((word[:-1] > 0) & (word[1:] > 0))
    pairs, pair = np.unique(word[first] * len(names) + word[first + 1], return_inverse=True)
    features = [f" {w} " for w in names[1:]] + [f" {names[a]} {names[b]} " for a, b in zip(*(x.tolist() for x in np.divmod(pairs, len(names))))]
    held, width = np.flatnonzero(word), max(1, len(features))
    sent, feat = np.divmod(_distinct(np.concatenate([sent[held] * width + word[held] - 1, sent[first] * width + len(names) - 1 + pair])), width)
    hit_sent, hit = lexicon.hits(flat, ends)
    labels = [list(map(int, subjects)) for subjects in labelled]
    return {
        "features": features, "feats": feat, "sizes": np.bincount(sent, minlength=len(ends)), "hits": hit, "hit_sizes": np.bincount(hit_sent, minlength=len(ends)),
        "sentences": count, "labels": _ints([*chain.from_iterable(labels)]), "label_sizes": _ints([len(x) for x in labels]),
    }


def _packed(chunk: dict) -> pa.BinaryArray:
    """All arrays of a chunk as one value, which costs the JVM nothing; each as narrow as its numbers allow."""
    narrow = {name: x.astype(np.min_scalar_type(x.max(initial=0))) if x.min(initial=0) >= 0 else x for name, x in chunk.items() if name != "features"}
    return pa.array([pickle.dumps(narrow, protocol=pickle.HIGHEST_PROTOCOL)], pa.binary())


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The chunks of batches; features stay an Arrow array."""
    for batch in batches:
        for i in range(batch.num_rows):
            features = {"features": batch.column("features")[i].values} if "features" in batch.schema.names else {}
            yield {**features, **pickle.loads(batch.column("numbers")[i].as_py())}


def _tags(chunk: dict, column: dict[int, int]) -> np.ndarray:
    """For each document the number of its labels, and 1 for each subject it is labelled with."""
    tags = np.zeros((len(chunk["sentences"]), len(column) + 1))
    for doc, subject in zip(_spread(chunk["label_sizes"]), chunk["labels"]):
        if subject in column:
            tags[doc, column[subject]] = 1.0
    tags[:, 0] = chunk["label_sizes"]
    return tags


def tally(chunk: dict, column: dict[int, int]) -> np.ndarray:
    """For documents themselves, then each feature, the number of documents, of those with each label, and of sentences."""
    tags, feat, n, docs = _tags(chunk, column), _ints(chunk["feats"]), len(chunk["features"]), len(chunk["sentences"])
    tags[:, 0] = 1.0
    pair_feat, pair_doc = np.divmod(_distinct(feat * docs + _spread(chunk["sentences"])[_spread(chunk["sizes"])]), max(1, docs))
    rows = np.stack([*(np.bincount(pair_feat, tags[pair_doc, c], n) for c in range(tags.shape[1])), np.bincount(feat, minlength=n)], axis=1)
    return np.vstack([[*tags.sum(axis=0), len(chunk["sizes"])], rows])


def numbered(chunk: dict, number: np.ndarray) -> dict:
    """A chunk with those features only that are numbered, others have -1; `places` are their numbers, in order."""
    kept = np.flatnonzero(number >= 0)
    kept = kept[np.argsort(number[kept])]
    rank = np.full(len(number), -1)
    rank[kept] = np.arange(len(kept))
    feat, sent, size = rank[_ints(chunk["feats"])], _spread(chunk["sizes"]), max(1, len(kept))
    sent, feat = np.divmod(np.sort((sent * size + feat)[feat >= 0]), size)
    return {**{c: v for c, v in chunk.items() if c != "features"}, "places": number[kept], "feats": feat, "sizes": np.bincount(sent, minlength=len(chunk["sizes"]))}


def read_of(chunk: dict, column: dict[int, int]) -> Read:
    doc = _spread(chunk["sentences"])
    return Read(doc, _tags(chunk, column)[doc], _ints(chunk["places"]), _spread(chunk["sizes"]), _ints(chunk["feats"]), _spread(chunk["hit_sizes"]), _ints(chunk["hits"]))


def counted_of(features: list[str], sums: np.ndarray) -> Counted:
    total = sums[[i for i, f in enumerate(features) if not f]].sum(axis=0)
    order = sorted((i for i, f in enumerate(features) if f and sums[i, 0] >= LEARN_LEAST), key=features.__getitem__)
    rows = sums[order]
    return Counted([features[i] for i in order], rows[:, 0], rows[:, -1], rows[:, :-1], int(total[0]), int(total[-1]), total[:-1])


def first_lift(counted: Counted) -> np.ndarray:
    """To begin with: how much oftener a word's documents bear a label than all do. One row per class, none for no subject."""
    usual = counted.labelled / max(1, counted.documents) + 1e-6
    lift = np.log((counted.tagged + 2 * usual) / ((counted.docs[:, None] + 2) * usual)).T.copy()
    lift[0] = 0.0
    return lift


def next_lift(counts: np.ndarray, counted: Counted) -> np.ndarray:
    """How much likelier a word is in a sentence about each subject than in one about none."""
    base = (counted.uses + 1e-9) / max(counted.uses.sum(), 1.0)
    chance = (counts + 50.0 * base[:, None]) / (counts.sum(axis=0) + 50.0)
    return np.ascontiguousarray((np.log(chance) - np.log(chance[:, :1])).T)


def expected(read: Read, lift: np.ndarray, terms: tuple[Term, ...], place: np.ndarray, seeding: float) -> np.ndarray:
    """The share each sentence has in each class, in steps of 2^-20, so that sums over sentences are exact in any order."""
    n, width = read.labels.shape
    prior = 0.05 / max(1, width - 1) + read.labels * (0.4 / np.maximum(1.0, read.labels[:, :1]))
    prior[:, 0] = np.maximum(0.05, 1 - prior[:, 1:].sum(axis=1))
    score, near = np.log(prior), lift[:, read.places]
    if seeding:
        weights = np.array([w for _, w, _ in terms])
        seed = np.bincount(read.hit_sent * width + place[read.hit], weights[read.hit], n * width).reshape(n, width)
        score += seeding * ((seed >= SENTENCE) & (seed >= seed.max(axis=1, keepdims=True)))
    for c in range(1, width):
        score[:, c] += 0.5 * np.bincount(read.sent, near[c][read.feat], n)
    share = np.exp(score - score.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    return np.round(share * 2**20) / 2**20


def by_feature(read: Read, share: np.ndarray) -> np.ndarray:
    """For each feature of `read.places` how many of its sentences are in each class."""
    return np.stack([np.bincount(read.feat, share[:, c][read.sent], len(read.places)) for c in range(share.shape[1])], axis=1)


def _classes(terms: tuple[Term, ...]) -> tuple[list[int], dict[int, int], np.ndarray]:
    """Subjects of the terms, their columns (0 is no subject), and each term's column."""
    owners = sorted({s for s, _, _ in terms})
    column = {s: i + 1 for i, s in enumerate(owners)}
    return owners, column, np.array([column[s] for s, _, _ in terms], dtype=np.int64)


def fit_terms(texts: list[str | None], labelled: list[set[int]], terms: tuple[Term, ...], rounds: int = ROUNDS) -> list[Term]:
    """Terms as labelled documents support them: curated ones weighed anew, and learned ones. All in memory.

    Which sentences of a document are about its subjects is not labelled. It is estimated by expectation maximisation:
    each sentence belongs to a subject or to none, labels say which subjects a document's sentences are likely to have,
    curated terms start it off, and words and pairs of words are counted by the share each sentence has in a subject. A
    curated term seen often is weighed by the share of its sentences that are about its subject; words and pairs of which
    nearly all sentences are about one subject are added. Wrong labels only shift what is likely.
    """
    _, column, place = _classes(terms)
    chunk = chunk_of(texts, labelled, lexicon_of(terms))
    if not len(chunk["sizes"]):
        return list(terms)
    counted = counted_of(["", *chunk["features"]], tally(chunk, column))
    number = {f: i for i, f in enumerate(counted.names)}
    read = read_of(numbered(chunk, _ints([number.get(f, -1) for f in chunk["features"]])), column)
    lift, counts = first_lift(counted), np.zeros((len(counted.names), len(column) + 1))
    for turn in range(rounds + 1):
        share = expected(read, lift, terms, place, _SEEDING.get(turn, 0.0))
        counts[read.places] = by_feature(read, share)
        lift = next_lift(counts, counted)
    return supported(terms, counted, counts, *by_term(read, share, place).T)


def by_term(read: Read, share: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each curated term the sentences and documents that hold it, and how many of the sentences are about its subject."""
    seen = np.bincount(read.hit, minlength=len(place))
    about = np.bincount(read.hit, share[read.hit_sent, place[read.hit]], len(place))
    pairs = _distinct(read.doc[read.hit_sent] * max(1, len(place)) + read.hit)
    return np.stack([seen, np.bincount(pairs % max(1, len(place)), minlength=len(place)), about], axis=1)


def supported(terms: tuple[Term, ...], counted: Counted, counts: np.ndarray, seen: np.ndarray, in_docs_of: np.ndarray, about: np.ndarray) -> list[Term]:
    """Curated terms by the trust that the counts give them, and the words and pairs they support."""
    owners, _, _ = _classes(terms)
    weight_of: dict[tuple[int, str], float] = {}
    heads: dict[int, list[str]] = defaultdict(list)  # what of a subject begins so is counted already
    for t in sorted(range(len(terms)), key=lambda t: len(terms[t][2])):
        s, w, term = terms[t]
        trust = 1.0 if in_docs_of[t] < 3 * LEARN_LEAST else about[t] / seen[t]
        w = w if trust >= LEARN_ALONE else min(w, COMPANY) * trust
        if trust >= LEARN_TRUST and not any(term.startswith(h) and weight_of[s, h] >= w for h in heads[s]):
            weight_of[s, term] = float(w)
            heads[s].append(term)
    names = counted.names
    best = counts[:, 1:].argmax(axis=1) + 1 if owners else np.zeros(len(names), dtype=int)
    trusts = counts[np.arange(len(names)), best] / (counted.uses + 1.0)
    for f in sorted(np.flatnonzero(trusts >= LEARN_COMPANY), key=lambda f: (names[f].count(" "), names[f])):
        s = owners[best[f] - 1]
        w = ALONE if trusts[f] >= LEARN_ALONE else COMPANY
        parts = [f" {p} " for p in names[f].split()]
        known = [weight_of.get((s, p), 0.0) for p in parts] + [weight_of[s, h] for h in heads[s] if any(p.startswith(h) for p in parts)]
        if w > max(known):
            weight_of[s, names[f]] = w
    return [(s, w, term) for (s, term), w in weight_of.items()]


def learned_terms(documents: DataFrame, labels: DataFrame, terms: tuple[Term, ...], doc_id: str = "doc_id", text: str = "text", subject_id: str = "subject_id") -> tuple[Term, ...]:
    """`fit_terms` on all labelled documents, spread over the workers; a repeated doc_id counts once, with its first text.

    Features are told once; each round is one pass over the sentences as numbers. What reaches the driver, and is sent out again,
    are sums by feature: one row for each word and pair of words that stands in LEARN_LEAST labelled documents. All sums are
    exact, so the result does not depend on how rows are spread. Without labelled documents the terms stay as they are.
    """
    spark = documents.sparkSession
    owners, column, place = _classes(terms)
    width = len(owners) + 1
    clean = cut_lineage(labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.collect_set(F.col(subject_id).cast("long")).alias("subjects")))
    known = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(clean, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("subjects").alias("subjects"))

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of(terms)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_DOCS):
                part = batch.slice(at, CHUNK_DOCS)
                chunk = chunk_of(part.column("text").to_pylist(), part.column("subjects").to_pylist(), lexicon)
                yield pa.RecordBatch.from_arrays([pa.array([chunk["features"]], pa.list_(pa.string())), _packed(chunk)], names=["features", "numbers"])

    chunks = cut_lineage(known.select("text", "subjects").mapInArrow(parted, "features array<string>, numbers binary"))
    columns = ["docs", *(f"c{i}" for i in range(1, width)), "uses"]

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _unpacked(batches):
            features = pa.concat_arrays([pa.array([""]), chunk["features"]])
            yield pa.RecordBatch.from_arrays([*map(pa.array, tally(chunk, column).T), features], names=[*columns, "feature"])

    sums = chunks.mapInArrow(tallied, ", ".join(f"{c} double" for c in columns) + ", feature string").groupBy("feature")
    rows = sums.agg(*(F.sum(c).alias(c) for c in columns)).where((F.col("docs") >= LEARN_LEAST) | (F.col("feature") == "")).toArrow().to_pandas()
    counted = counted_of(list(rows["feature"]), rows[columns].to_numpy(dtype=float))
    if not counted.sentences:
        return terms
    vocabulary = spark.sparkContext.broadcast(pa.array(counted.names, pa.string()))

    def renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column("features")
            number, last = pc.fill_null(pc.index_in(features.flatten(), vocabulary.value), -1).to_numpy(), np.cumsum(_ints(features.value_lengths()))
            for chunk, end in zip(_unpacked([batch]), last):
                yield pa.RecordBatch.from_arrays([_packed(numbered(chunk, number[end - len(chunk["features"]) : end]))], names=["numbers"])

    numbers = cut_lineage(chunks.mapInArrow(renumbered, "numbers binary"))
    lift, size, wide = first_lift(counted), len(counted.names), [f"c{i}" for i in range(max(width, 3))]
    for turn in range(ROUNDS + 1):
        sent_out = spark.sparkContext.broadcast(lift)

        def expect(batches: Iterator[pa.RecordBatch], turn: int = turn, sent_out=sent_out) -> Iterator[pa.RecordBatch]:
            counts, of_terms = np.zeros((size, width)), np.zeros((len(terms), 3))
            for chunk in _unpacked(batches):
                read = read_of(chunk, column)
                share = expected(read, sent_out.value, terms, place, _SEEDING.get(turn, 0.0))
                counts[read.places] += by_feature(read, share)
                if turn == ROUNDS:
                    of_terms += by_term(read, share, place)
            for kind, table in ((0, counts), (1, of_terms)):
                held = np.flatnonzero(table.any(axis=1))
                if len(held):
                    filled = np.zeros((len(wide), len(held)))
                    filled[: table.shape[1]] = table[held].T
                    yield pa.RecordBatch.from_arrays([*map(pa.array, filled), pa.array(np.full(len(held), kind), pa.int32()), pa.array(held)], names=[*wide, "kind", "place"])

        part = numbers.mapInArrow(expect, ", ".join(f"{c} double" for c in wide) + ", kind int, place long")
        got = part.groupBy("kind", "place").agg(*(F.sum(c).alias(c) for c in wide)).toArrow().to_pandas()
        sent_out.unpersist()
        words, marks = got[got["kind"] == 0], got[got["kind"] == 1]
        counts = np.zeros((size, width))
        counts[words["place"].to_numpy()] = words[wide[:width]].to_numpy()
        lift = next_lift(counts, counted)
    of_terms = np.zeros((len(terms), 3))
    of_terms[marks["place"].to_numpy()] = marks[wide[:3]].to_numpy()
    vocabulary.unpersist()
    return tuple(sorted(supported(terms, counted, counts, *of_terms.T))) or terms


def term_sentences(documents: DataFrame, terms: tuple[Term, ...], doc_id: str, text: str) -> DataFrame:
    """doc_id, sentences, the terms of each sentence that has some, one after another, and their numbers: one pass over whole texts."""
    id_type = documents.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = lexicon_of(terms)
        for batch in batches:
            hits = lexicon.read(batch.column("text").to_pylist())
            doc, docs = _spread(hits.sentences), batch.num_rows
            size = np.bincount(hits.sent, minlength=len(doc))
            filled = np.flatnonzero(size)
            of_docs = [np.bincount(doc[x], minlength=docs) for x in (hits.sent, filled)]
            columns = [batch.column("doc_id"), pa.array(hits.sentences, pa.int32()), _lists(hits.term, of_docs[0]), _lists(size[filled], of_docs[1])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sentences", "terms", "sizes"])

    read = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(scan, f"doc_id {id_type}, sentences int, terms array<int>, sizes array<int>")


def sentences_about(sent: np.ndarray, weight: np.ndarray, column: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """For each sentence and subject whether it has the sentence's highest sum of weights and that reaches SENTENCE."""
    sums = np.bincount(sent * shape[1] + column, weight, shape[0] * shape[1]).reshape(shape)
    return (sums >= SENTENCE) & (sums >= sums.max(axis=1, keepdims=True) - 1e-9)


def sentence_subjects(terms: tuple[int, ...], owner: list[int], weight: list[float]) -> tuple[int, ...]:
    """The subjects of one sentence by its terms."""
    owners, column = np.unique([owner[t] for t in terms], return_inverse=True)
    about = sentences_about(np.zeros(len(terms), dtype=np.int64), np.array([weight[t] for t in terms]), column, (1, len(owners)))
    return tuple(owners[about[0]].tolist())


def subject_shares(scanned: DataFrame, terms: tuple[Term, ...]) -> DataFrame:
    """doc_id, subject_id, share: the part of the document's sentences that are about the subject.

    A term's weight is scaled by its rarity over all documents (between a half and one and a half times). A sentence is
    about the subject with the highest sum, if that reaches SENTENCE; equal sums count for each.
    """
    total = scanned.count()
    used = scanned.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    found = {r["term"]: log1p(total / r["df"]) for r in used.collect()}  # one row per term of the lexicon
    usual = sorted(found.values())[len(found) // 2] if found else 1.0
    weight = np.array([w * min(1.5, max(0.5, found.get(i, usual) / usual)) for i, (_, w, _) in enumerate(terms)])
    owners, _, place = _classes(terms)
    owner, place, width = _ints(owners), place - 1, len(owners)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch.column("sizes").value_lengths().to_pylist(), SLICE_SENTENCES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                term, size = _ints(part.column("terms").flatten()), _ints(part.column("sizes").flatten())
                doc = _spread(part.column("sizes").value_lengths())
                sent, subject = np.nonzero(sentences_about(_spread(size), weight[term], place[term], (len(size), width)))
                counts = np.bincount(doc[sent] * width + subject, minlength=part.num_rows * width).reshape(part.num_rows, width)
                doc, subject = np.nonzero(counts)
                hits = counts[doc, subject]
                columns = [part.column("doc_id").take(pa.array(doc)), pa.array(owner[subject]), pa.array(hits, pa.int32()), pa.array(hits / _ints(part.column("sentences"))[doc])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "subject_id", "hits", "share"])

    id_type = scanned.schema["doc_id"].dataType.simpleString()
    return scanned.where("sentences > 0 AND size(terms) > 0").mapInArrow(score, f"doc_id {id_type}, subject_id long, hits int, share double")


def calibrated(shares: DataFrame, labels: DataFrame, doc_id: str, subject_id: str) -> dict[int, float]:
    """For each subject the share within LATITUDE of SHARE that agrees best with the hand labels; SHARE itself if equal.

    Labels may be wrong, missing or repeated. All labelled documents are used.
    """
    clean = labels.where(F.col(doc_id).isNotNull() & F.col(subject_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(subject_id).cast("long").alias("subject_id")).distinct()
    chosen = clean.select("doc_id").distinct()
    near = shares.where(F.col("share").between(SHARE - LATITUDE, SHARE + LATITUDE)).join(chosen.hint("merge"), "doc_id", "left_semi")
    steps = near.join(clean.withColumn("labelled", F.lit(1)).hint("merge"), ["doc_id", "subject_id"], "left").groupBy("subject_id", F.round("share", 3).alias("share")).agg(
        F.count("*").alias("n"), F.sum(F.coalesce("labelled", F.lit(0))).alias("yes")
    )
    by_subject: dict[int, list[tuple[float, int, int]]] = defaultdict(list)
    for r in steps.collect():  # at most 61 steps for each subject
        by_subject[r["subject_id"]].append((r["share"], r["n"], r["yes"]))
    chosen_at = {}
    for subject, points in by_subject.items():
        def agreement(cut: float) -> int:
            return sum(yes if share >= cut else n - yes for share, n, yes in points)

        cuts = [SHARE - 0.0005, *(share - 0.0005 for share, _, _ in points)]
        best = max(map(agreement, cuts))
        if best > agreement(cuts[0]) + 2 + 0.02 * sum(n for _, n, _ in points):
            chosen_at[subject] = min((c for c in cuts if agreement(c) == best), key=lambda c: abs(c - SHARE))
    return chosen_at


def subjects_of(documents: DataFrame, subjects: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, subject_id, share: every subject that at least a calibrated share of a document's sentences is about.

    Whole texts are scanned once; what follows works on the terms found, a few hundred bytes a document, written to the
    checkpoint folder. Rarities are counted over all documents. The list of subjects and the terms are of fixed size.
    NULL and empty texts, and texts without a full stop, have no subject; repeated documents give their rows again;
    extra columns are never read; an empty table gives no rows. Subjects without curated terms use their own words.
    """
    listed = tuple((int(r[0]), r[1] or "", r[2] or "") for r in subjects.where("subject_id IS NOT NULL").select("subject_id", "subject", "description").orderBy("subject_id").collect())
    terms = curated_terms(listed)
    if labels is not None and terms:
        terms = learned_terms(documents, labels, terms, doc_id, text)
    scanned = cut_lineage(term_sentences(documents, terms, doc_id, text))
    shares, cuts = subject_shares(scanned, terms), {}
    if labels is not None:
        shares = cut_lineage(shares)  # read twice
        cuts = calibrated(shares, labels, "doc_id", "subject_id")
    least = F.lit(SHARE - 1e-9)
    for subject, cut in cuts.items():
        least = F.when(F.col("subject_id") == subject, F.lit(cut)).otherwise(least)
    return shares.where(F.col("share") >= least).select("doc_id", "subject_id", "share")
