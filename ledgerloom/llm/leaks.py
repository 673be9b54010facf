"""Evaluation texts leaking into training text: a generalised suffix automaton over the items, streamed over the corpus."""

from __future__ import annotations

import html
import pickle
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain
from operator import add

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

#: Words of a passage that a stretch must cover to make a leak, and the share of them that must be repeated.
LEAST_WORDS, LEAST_SHARE = 25, 0.86
#: Shortest exact run that anchors a match, and what the longest run of a stretch within the limits has at least: of 25 words
#: 22 are repeated, and changed, missing and added words (one in ten, so some five) leave them in seven runs at most.
ANCHOR, LEAST_RUN = 3, 4
#: Items are indexed in blocks of at most so many words, and so many words of blocks are held in one pass over the corpus.
BLOCK_WORDS, PASS_WORDS = 400_000, 1_600_000
#: Words back in a document to which runs are looked at one by one; beyond, the best of each place in the item is kept.
NEAR_WORDS = 400

# Letters of other scripts that look like Latin ones, after case folding.
LOOKALIKES = str.maketrans("асеорхуіјѕһԁԛԝвкмнтзгοανρτυχικε", "aceopxyijshdqwbkmhtзroavptuxike")
_KEPT_APART = "/|=<>&+\\"
_ASCII = {i: None for i in range(33, 127) if not chr(i).isalnum()} | {ord(c): " " for c in _KEPT_APART} | {i: i + 32 for i in range(65, 91)}
_BROKEN = re.compile(r"(?<=\w)-[ \t]*\r?\n\s*(?=\w)")
_BLOCK_TAG = re.compile(r"</?(?:p|br|div|li|ul|ol|td|tr|th|table|h[1-6]|section)\b[^<>]*>", re.I)
_INLINE_TAG = re.compile(r"</?[a-z][a-z0-9]*(?:\s[^<>]*)?/?>", re.I)
_UNSEEN = re.compile("[\u00ad\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff\ufe00-\ufe0f\u0300-\u036f]")
_DASHES = re.compile("[\u2012-\u2015\u2026\u2022\u00b7]")
_OTHER_MARKS = re.compile(r"[^\w\s]|_")


def normal_words(text: str | None) -> list[str]:
    """The words of a text without case, punctuation, markup, entities, invisible characters, accents or lookalikes.

    Words broken over a line are joined. NULL and blank texts have none.
    """
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _INLINE_TAG.sub("", _BLOCK_TAG.sub(" ", text))
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text))
        text = text.casefold().translate(LOOKALIKES)
    if "-\n" in text or "-\r" in text or "- \n" in text:
        text = _BROKEN.sub("", text)
    if text.isascii():
        return text.translate(_ASCII).split()
    text = _DASHES.sub(" ", text).translate(_ASCII)
    return _OTHER_MARKS.sub("", text).split()


class SuffixAutomaton:
    """A generalised suffix automaton over sequences of word numbers, with the places where long strings end.

    It is built state by state and then kept in flat arrays: the transitions of a state stand together, sorted by word,
    and so do the places of a state and of all states whose links lead to it. So it holds some 30 bytes a transition.
    """

    def __init__(self, sequences: list[list[int]]) -> None:
        self.sequences = [array("i", s) for s in sequences]
        following: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        ends: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = _extend(following, link, length, last, word)
                ends[last].append((number, at))
        self.link, self.length = array("i", link), array("i", length)
        self.row = array("i", accumulate(map(len, following), initial=0))
        self.word, self.target = array("i"), array("i")
        for state, held in enumerate(following):
            for word in sorted(held):
                self.word.append(word)
                self.target.append(held[word])
            following[state] = None
        self._place(ends)

    def _place(self, ends: dict[int, list[tuple[int, int]]]) -> None:
        """Places in the order of the tree of links, so that each state's are one slice: number, at, low, high."""
        states, link, length = len(self.link), self.link, self.length
        by_length = sorted(range(1, states), key=length.__getitem__)
        size = array("i", [0]) * states
        for state in by_length:
            size[state] = len(ends.get(state, ()))
        for state in reversed(by_length):
            if link[state] > 0:
                size[link[state]] += size[state]
        self.low, free, total = array("i", [0]) * states, array("i", [0]) * states, 0
        self.top = array("i", range(states))  # the last state of at least ANCHOR words on the way of the links
        self.number, self.at = array("i"), array("i")
        for state in by_length:
            up = link[state]
            if up > 0:
                self.low[state] = free[up]
                free[up] += size[state]
                if length[up] >= ANCHOR:
                    self.top[state] = self.top[up]
            else:
                self.low[state], total = total, total + size[state]
            free[state] = self.low[state] + len(ends.get(state, ()))
        self.number, self.at = array("i", [0]) * total, array("i", [0]) * total
        for state, own in ends.items():
            for i, (number, at) in enumerate(own, self.low[state]):
                self.number[i], self.at[i] = number, at
        self.high = array("i", map(add, self.low, size))

    def places(self, state: int) -> list[tuple[int, int]]:
        """The sequences and positions where the strings of a state end."""
        here = slice(self.low[state], self.high[state])
        return list(zip(self.number[here], self.at[here]))

    def step(self, state: int, word: int) -> int:
        """The state after one more word; -1 if no sequence goes on so."""
        stop = self.row[state + 1]
        i = bisect_left(self.word, word, self.row[state], stop)
        return self.target[i] if i < stop and self.word[i] == word else -1

    def matches(self, words: list[int], start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """Maximal matches of at least ANCHOR words within words[start:stop]: end (exclusive), length, state."""
        step, link, size = self.step, self.link, self.length
        state = length = 0
        for at in range(start, stop):
            word = words[at]
            after = step(state, word)
            if after < 0:
                if length >= ANCHOR:
                    yield at, length, state
                while after < 0 and state:
                    state = link[state]
                    length = size[state]
                    after = step(state, word)
                if after < 0:
                    state = length = 0
                    continue
            state, length = after, length + 1
        if length >= ANCHOR:
            yield stop, length, state

    def runs(self, words: list[int], start: int, stop: int) -> Iterator[tuple[int, int, int, int]]:
        """Every sequence's own maximal runs of at least ANCHOR words within words[start:stop]: sequence, start in words, start in it, length.

        A run of one sequence ends where that sequence goes on differently, however far others go on.
        """
        step, link, size, low, high, top = self.step, self.link, self.length, self.low, self.high, self.top
        number, place, sequences = self.number, self.at, self.sequences
        state = length = 0
        for at in range(start, stop):
            word = words[at]
            while (after := step(state, word)) < 0 and state:
                state = link[state]
                length = size[state]
            if after < 0:
                continue
            state, length = after, length + 1
            if length < ANCHOR:
                continue
            follow = words[at + 1] if at + 1 < stop else 0
            if (on := step(top[state], follow)) >= 0 and high[on] - low[on] == high[top[state]] - low[top[state]]:
                continue  # every place goes on
            here, n, below = state, length, None
            while size[here] >= ANCHOR:
                inner = (high[here], high[here]) if below is None else (low[below], high[below])
                for i in chain(range(low[here], inner[0]), range(inner[1], high[here])):
                    sequence, end = sequences[number[i]], place[i]
                    if end + 1 == len(sequence) or sequence[end + 1] != follow:
                        yield number[i], at + 1 - n, end + 1 - n, n
                here, below = link[here], here
                n = size[here]


def _extend(following: list[dict[int, int]], link: list[int], length: list[int], last: int, word: int) -> int:
    """The state for the text so far with one more word; states that exist already are used again."""

    def twin_of(there: int, of: int, p: int) -> int:
        """A copy of `there` for the shorter strings that reach it from `of`; what led there from `p` on leads to the copy."""
        twin = len(length)
        following.append(dict(following[there]))
        link.append(link[there])
        length.append(length[of] + 1)
        link[there] = twin
        while p != -1 and following[p].get(word) == there:
            following[p][word] = twin
            p = link[p]
        return twin

    if (there := following[last].get(word)) is not None:
        return there if length[there] == length[last] + 1 else twin_of(there, last, last)
    state = len(length)
    following.append({})
    link.append(0)
    length.append(length[last] + 1)
    p = last
    while p != -1 and word not in following[p]:
        following[p][word] = state
        p = link[p]
    if p != -1:
        there = following[p][word]
        link[state] = there if length[there] == length[p] + 1 else twin_of(there, p, p)
    return state


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two short lists."""
    if not a or not b:
        return 0
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            kept = row[j]
            row[j] = diagonal + 1 if x and x == y else max(kept, row[j - 1])
            diagonal = kept
    return row[-1]


def chains(anchors: list[tuple[int, int, int]], slack: int) -> Iterator[list[tuple[int, int, int]]]:
    """For every exact run (doc start, item start, length) the best chain in common order that ends with it, best ones first.

    Gaps on either side may hold up to `slack` words, as many as the whole item may miss; once, other sentences of any
    length may stand in the document. Runs more than NEAR_WORDS words back are kept by the place in the item alone, the
    best of each.
    """
    anchors = sorted(set(anchors))
    best: list[list[tuple[float, int, int]]] = []  # per anchor and number of interruptions: score, previous anchor, its interruptions
    longest, first, far = max(n for _, _, n in anchors), 0, {}
    for i, (d, p, n) in enumerate(anchors):
        now = [(float(n), -1, 0), (float(n), -1, 1)]
        while anchors[first][0] + longest + NEAR_WORDS < d:
            _, pj, nj = anchors[first]
            if (pj, nj) not in far or best[first][0][0] > best[far[pj, nj]][0][0]:
                far[pj, nj] = first
            first += 1
        for (pj, nj), j in far.items():
            over = max(pj + nj - p, 0)
            if over < n and p > pj and p + over - pj - nj <= slack and (score := best[j][0][0] + n - over - 0.3 * (p + over - pj - nj)) > now[1][0]:
                now[1] = (score, j, 0)
        for j in range(first, i):
            dj, pj, nj = anchors[j]
            over = max(dj + nj - d, pj + nj - p, 0)
            if over >= n or d <= dj or p <= pj:
                continue
            gap_doc, gap_item = d + over - dj - nj, p + over - pj - nj
            if gap_item > slack:
                continue
            gain = n - over - 0.3 * gap_item
            if gap_doc <= slack:
                for k in (0, 1):
                    if (score := best[j][k][0] + gain - 0.3 * gap_doc) > now[k][0]:
                        now[k] = (score, j, k)
            elif (score := best[j][0][0] + gain) > now[1][0]:
                now[1] = (score, j, 0)
        best.append(now)
    for _, i, k in sorted(((best[i][k][0], i, k) for i in range(len(anchors)) for k in (0, 1)), reverse=True):
        back = []
        while i >= 0:
            back.append(anchors[i])
            _, i, k = best[i][k]
        yield back[::-1]


def may_pass(run: Sequence[tuple[int, int, int]], doc: list[int], item: Sequence[int], slack: int) -> bool:
    """Whether a chain can come up to the limits at all, with every gap and end as full as it can be."""
    reach, words = slack + 2, run[0][2]
    (d0, p0, _), (d1, p1, n1) = run[0], run[-1]
    for (_, pj, nj), (_, p, n) in zip(run, run[1:]):
        words += n + max(p - pj - nj, 0)
    words, d1, p1 = min(words, p1 + n1 - p0), d1 + n1, p1 + n1
    before, after = set(doc[max(0, d0 - reach - 1) : d0]), set(doc[d1 : d1 + reach + 1])
    ends = sum(x in before for x in item[max(0, p0 - reach) : p0]) + sum(x in after for x in item[p1 : p1 + reach])
    return words + ends >= LEAST_SHARE * LEAST_WORDS


def passes(words: int, p0: int, p1: int) -> bool:
    return p1 - p0 >= LEAST_WORDS and words >= LEAST_SHARE * (p1 - p0)


def stretch(anchors: list[tuple[int, int, int]], doc: list[int], item: Sequence[int]) -> tuple[int, int, int, list[tuple[int, int]]] | None:
    """What the best chain of exact runs repeats that passes the limits, as `measured` gives it; None if none passes.

    A chain that fails as a whole may have taken in chance runs at its ends: its parts are tried then, those with most
    words first, and then the chains that end elsewhere.
    """
    tried, slack = set(), max(1, int((1 - LEAST_SHARE) * len(item)))
    for whole in chains(anchors, slack):
        found = None
        for size in range(len(whole), 0, -1):
            for start in range(len(whole) - size + 1):
                part = tuple(whole[start : start + size])
                if part in tried:
                    continue
                tried.add(part)
                if may_pass(part, doc, item, slack) and passes(*(got := measured(part, doc, item, slack))[:3]) and (found is None or got[0] > found[0]):
                    found = got
            if size == len(whole) and found:
                break
        if found:
            return found
    return None


def beyond(doc: Sequence[int], item: Sequence[int]) -> tuple[int, int]:
    """Words repeated beyond the end of an exact run, where single words may stand behind a changed one, and item words they span."""
    for width in range(len(item), 0, -1):
        held = doc[: width + 1]
        if item[width - 1] in held and ((more := common_length(held, item[:width])) >= 0.7 * width or width == 2 and item[1] in doc[:2]):
            return more, width
    return 0, 0


def measured(run: Sequence[tuple[int, int, int]], doc: list[int], item: Sequence[int], slack: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """What a chain of exact runs repeats: words, first and last item word, and the parts of the document that repeat them.

    There is one part, or two around an interruption; ends are exclusive.
    """
    d0, p0, _ = run[0]
    d1, p1, words, parts = d0, p0, 0, [d0]
    for d, p, n in run:
        over = max(d1 - d, p1 - p, 0)
        if d + over - d1 <= 2 * slack:
            words += common_length(doc[d1 : d + over], item[p1 : p + over])
        else:  # around an interruption, words may be missing on either side of it
            gap = item[p1 : p + over]
            words += max(common_length(doc[d1 : d1 + len(gap) + 2], gap), common_length(doc[d + over - len(gap) - 2 : d + over], gap))
            parts += [d1, d + over]
        words += n - over
        d1, p1 = d + n, p + n
    more, width = beyond(doc[max(0, d0 - slack - 3) : d0][::-1], item[max(0, p0 - slack - 2) : p0][::-1])
    words, p0, d0 = words + more, p0 - width, max(0, d0 - width)
    more, width = beyond(doc[d1 : d1 + slack + 3], item[p1 : p1 + slack + 2])
    words, p1, d1 = words + more, p1 + width, min(len(doc), d1 + width)
    parts = [d0, *parts[1:], d1]
    return words, p0, p1, list(zip(parts[::2], parts[1::2]))


def without(anchors: list[tuple[int, int, int]], start: int, stop: int) -> list[tuple[int, int, int]]:
    """The exact runs outside words[start:stop] of the document; what is left of one they share must still be an anchor."""
    kept = []
    for d, p, n in anchors:
        before, after = min(n, max(0, start - d)), min(n, max(0, d + n - stop))
        if before == n or after == n:
            kept.append((d, p, n))
            continue
        if before >= ANCHOR:
            kept.append((d, p, before))
        if after >= ANCHOR:
            kept.append((d + n - after, p + n - after, after))
    return kept


class ItemIndex:
    """The items of one block: their vocabulary, their words as numbers, and the automaton over them."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids = [item_id for item_id, _ in items]
        self.automaton = SuffixAutomaton([[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normal_words(passage)] for _, passage in items])
        self.words = self.automaton.sequences

    def leaks(self, found: list[str], every: bool = True) -> Iterator[tuple[int, int, int, int, list[tuple[int, int]]]]:
        """item_id, words repeated, first and last item word, and the parts of the document, for its normal words.

        An item the document repeats at several places comes out with each of them, the best one first; with every=False
        with that one only.
        """
        if len(found) < ANCHOR:
            return
        numbers = list(map(self.vocabulary.get, found, [0] * len(found)))
        known = np.array(numbers, dtype=np.int32) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        long = np.flatnonzero(edges[1::2] - edges[::2] >= ANCHOR)
        if not len(long):
            return
        anchors = defaultdict(list)
        for start, stop in zip(edges[::2][long].tolist(), edges[1::2][long].tolist()):
            for item, d, p, n in self.automaton.runs(numbers, start, stop):
                anchors[item].append((d, p, n))
        for item, runs in anchors.items():
            if max(n for _, _, n in runs) < LEAST_RUN:
                continue
            left = numbers
            while runs and (found := stretch(runs, left, self.words[item])):
                yield self.ids[item], *found
                if not every:
                    break
                left = left.copy()
                for a, b in found[3]:
                    left[a:b] = [0] * (b - a)
                    runs = without(runs, a, b)


def item_passes(items: DataFrame, item_id: str, passage: str) -> Iterator[list[Broadcast]]:
    """The test items as indexes of at most BLOCK_WORDS words (or one item) each, in lists of at most PASS_WORDS words.

    Items come one partition at a time, and one block at a time is held and indexed on the driver. Each index is a
    broadcast of bounded size.
    """
    context = items.sparkSession.sparkContext
    indexes: list[Broadcast] = []
    block: list[tuple[int, str]] = []
    held = ready = 0

    def closed() -> Broadcast:
        return context.broadcast(pickle.dumps(ItemIndex(block)))

    for row in items.where(F.col(passage).isNotNull()).select(item_id, passage).toLocalIterator():
        size = len(normal_words(row[1])) + 1
        if block and held + size > BLOCK_WORDS:
            indexes.append(closed())
            ready, block, held = ready + held, [], 0
            if ready + BLOCK_WORDS > PASS_WORDS:
                yield indexes
                indexes, ready = [], 0
        block.append((row[0], row[1]))
        held += size
    if block:
        indexes.append(closed())
    if indexes:
        yield indexes


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", every: bool = False) -> DataFrame:
    """Every (doc_id, item_id) of which the document repeats a stretch of at least LEAST_WORDS words in order, with the best one.

    Of the stretch's words LEAST_SHARE must be repeated, since about one in ten may be changed, missing or added; gaps in it
    may hold what the share allows for the whole item, and one interruption of any length may stand in it.

    With every=True, a document that repeats an item at several places gives a row for each of them.

    Columns: doc_id, item_id, words (repeated), stretch (words of the passage it covers), first_word, end_word (of the
    passage), from_word, to_word (of the normalised document). Whole texts are streamed through the automata; a block
    of items is one broadcast of bounded size, several are held in one pass, and still more items mean more passes. No shuffle. NULL or blank texts and
    passages leak nothing; a repeated document gives its rows again; equal passages are all reported; extra columns are
    never read; an empty table gives no rows.
    """
    spark: SparkSession = documents.sparkSession
    id_type, item_type = documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id {item_type}, words int, stretch int, first_word int, end_word int, from_word int, to_word int"
    read = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    result = spark.createDataFrame([], schema)
    for number, indexes in enumerate(item_passes(items, item_id, passage)):

        def stream(batches: Iterator[pd.DataFrame], indexes=indexes) -> Iterator[pd.DataFrame]:
            held: list[ItemIndex] = [pickle.loads(index.value) for index in indexes]
            for batch in batches:
                rows = []
                for doc, body in zip(batch["doc_id"], batch["text"]):
                    found = normal_words(body)
                    rows += [(doc, item, words, p1 - p0, p0, p1, parts[0][0], parts[-1][1]) for index in held for item, words, p0, p1, parts in index.leaks(found, every)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words", "stretch", "first_word", "end_word", "from_word", "to_word"])

        part = read.mapInPandas(stream, schema)
        result = part if number == 0 else result.unionByName(part)
    return result


def remove_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """doc_id, text, removed: every document without the parts that repeat a test item, and how many characters those were.

    Only the repeating parts go; sentences that interrupt a stretch stay. Documents without a leak, NULL and empty texts
    come out as they are, repeated documents as often as they came. Every copy goes, and what only a cut brings together;
    with several blocks of items, which are taken off one after another, the rounds end when one removes nothing.
    """
    clean = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(0).alias("removed"))
    indexes, before = [index for some in item_passes(items, item_id, passage) for index in some], -1
    if len(indexes) < 2:
        return strip_blocks(clean, indexes)
    while True:
        clean = cut_lineage(strip_blocks(clean, indexes))
        removed = clean.agg(F.sum(F.col("removed").cast("long"))).head()[0] or 0
        if removed in (0, before):
            return clean
        before = removed


def strip_blocks(clean: DataFrame, indexes: list) -> DataFrame:
    """doc_id, text, removed without the parts that repeat an item of the indexes, which are broadcasts of pickled ones."""
    id_type = clean.schema["doc_id"].dataType.simpleString()
    for index in indexes:

        def strip(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            held: ItemIndex = pickle.loads(index.value)
            for batch in batches:
                kept = [cut_out(body, held) if body and any(True for _ in held.leaks(normal_words(body))) else (body, 0) for body in batch["text"]]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [t for t, _ in kept], "removed": batch["removed"] + [n for _, n in kept]})

        clean = clean.mapInPandas(strip, f"doc_id {id_type}, text string, removed int")
    return clean


def located_words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The normal words of a text with the places they have in it, markup counted to the word it stands at."""
    blank = lambda m: " " * len(m[0])
    flat = _INLINE_TAG.sub(lambda m: "\u00ad" * len(m[0]), _BLOCK_TAG.sub(blank, text)) if "<" in text else text
    flat = re.sub(r"&(?:nbsp|ensp|emsp|thinsp|#160|#xa0);", blank, flat, flags=re.I)
    words, places = [], []
    for m in re.finditer(r"(?:\S*\w-[ \t]*\r?\n\s*(?=\w))*\S+", flat):
        found = normal_words(m[0])
        words += found
        places += [m.span()] * len(found)
    return words, places


def cut_out(text: str, index: ItemIndex) -> tuple[str, int]:
    """The text without the parts that repeat an item, and how many characters they had; cuts go on until nothing repeats."""
    removed = 0
    while True:
        words, places = located_words(text)
        cuts = sorted((places[a][0], places[b - 1][1]) for _, _, _, _, parts in index.leaks(words) for a, b in parts if b > a)
        kept, at, gone = [], 0, 0
        for start, end in cuts:
            if end > at:
                kept.append(text[at : max(at, start)])
                gone += end - max(at, start)
                at = end
        if not gone:
            return text, removed
        text, removed = "".join([*kept, text[at:]]), removed + gone
