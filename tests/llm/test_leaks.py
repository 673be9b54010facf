import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.leaks import ANCHOR, ItemIndex, SuffixAutomaton, common_length, find_leaks, located_words, normal_words, remove_leaks

RNG = random.Random(5)
WORDS = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("a", "e", "oo") for c in ("rd", "st", "ll", "nt", "x")]


def passage(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (str(rng.randint(2, 99)) if rng.random() < 0.3 else "") for _ in range(n))


ITEM = passage(70, 1)
NOISE = [passage(60, s) for s in range(50, 60)]


@pytest.mark.parametrize(
    "text",
    ["**Over** the <b>wall</b>", "OVER THE WALL", "over&nbsp;the&nbsp;wall", "o­ver the​ wall", "оver the wаll", "o-\nver the wall", "ｏver the wáll", "over, the; wall."],
)
def test_words_are_the_same_however_written(text):
    assert normal_words(text) == ["over", "the", "wall"]


def test_no_words():
    assert normal_words(None) == [] and normal_words("") == [] and normal_words(" \n ** ") == []


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        items = [[rng.randint(1, 4) for _ in range(rng.randint(0, 14))] for _ in range(4)]
        automaton = SuffixAutomaton(items)
        text = [rng.randint(0, 5) for _ in range(40)]
        found = {(end, n) for end, n, _ in automaton.matches(text, 0, len(text))}
        subs = {tuple(i[a:b]) for i in items for a in range(len(i)) for b in range(a + 1, len(i) + 1)}
        longest = [max([n for n in range(0, end + 1) if tuple(text[end - n : end]) in subs or n == 0]) for end in range(len(text) + 1)]
        expected = {(e, longest[e]) for e in range(1, len(text) + 1) if longest[e] >= ANCHOR and (e == len(text) or longest[e + 1] <= longest[e])}
        assert found == expected
        for end, n, state in automaton.matches(text, 0, len(text)):
            places = {(i, at + n - 1) for i, item in enumerate(items) for at in range(len(item) - n + 1) if item[at : at + n] == text[end - n : end]}
            assert set(automaton.places(state)) == places


def test_runs_of_every_sequence_against_brute_force():
    rng = random.Random(4)
    for _ in range(80):
        items = [[rng.randint(1, 3) for _ in range(rng.randint(0, 14))] for _ in range(5)]
        items.append(items[0][2:9])
        text = [rng.randint(0, 3) for _ in range(25)] + items[0] + [rng.randint(0, 3) for _ in range(5)]
        want = set()
        for i, item in enumerate(items):
            for d in range(len(text)):
                for p in range(len(item)):
                    n = 0
                    while d + n < len(text) and p + n < len(item) and text[d + n] == item[p + n]:
                        n += 1
                    if n >= ANCHOR and not (d and p and text[d - 1] == item[p - 1]):
                        want.add((i, d, p, n))
        automaton, edges = SuffixAutomaton(items), [-1, *[k for k, x in enumerate(text) if x == 0], len(text)]
        got = [r for a, b in zip(edges, edges[1:]) for r in automaton.runs(text, a + 1, b)]
        assert set(got) == want and len(got) == len(want)


def test_contained_and_nearly_equal_items(spark):
    words = passage(60, 21).split()
    near = ["other" if k in (20, 41) else w for k, w in enumerate(words)]
    held = {1: words, 2: words[:30], 3: words[15:45], 4: words[30:], 5: near, 6: words[:30] + passage(30, 22).split(), 7: passage(60, 23).split()}
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in held.items()], "item_id long, passage string")
    df = spark.createDataFrame([(1, f"{NOISE[0]} {' '.join(words)} {NOISE[1]}"), (2, f"{NOISE[0]} {' '.join(near)} {NOISE[1]}")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in find_leaks(df, items).collect())
    assert got == [(d, i) for d in (1, 2) for i in range(1, 7)]


def test_common_length():
    assert common_length([1, 2, 3, 4], [2, 9, 4]) == 2 and common_length([], [1]) == 0 and common_length([0, 0], [0, 0]) == 0


def changed(words, share, seed):
    rng, out = random.Random(seed), []
    for w in words:
        kind = rng.random()
        if kind < share / 3:
            continue
        out.append("other" if kind < 2 * share / 3 else w)
        if kind > 1 - share / 3:
            out.append("added")
    return out


def test_leaks(spark):
    words = ITEM.split()
    other = passage(70, 2)
    docs = {
        1: NOISE[0] + " " + ITEM + " " + NOISE[1],
        2: NOISE[2] + " " + " ".join(words[20:48]) + " " + NOISE[3],
        3: NOISE[2] + " " + " ".join(words[20:38]) + " " + NOISE[3],
        4: NOISE[4] + " " + " ".join(changed(words[5:60], 0.09, 4)) + " " + NOISE[5],
        5: " ".join(words[:20]) + " " + NOISE[6] + " " + " ".join(words[20:40]),
        6: "\n".join(f"**{w.upper()}**&nbsp;" for w in words),
        7: None,
        8: "",
        9: " ".join(words[40:52]) + " " + NOISE[7] + " " + other,
        10: (NOISE[8] + " ") * 2000 + ITEM,
        11: " ".join(reversed(words)),
    }
    df = spark.createDataFrame([(i, t) for i, t in docs.items()] + [(1, docs[1])], "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("words", F.lit(1))
    items = spark.createDataFrame([(1, ITEM), (2, other), (3, None), (4, ""), (5, ITEM), (6, "too short")], "item_id long, passage string").withColumn("doc_id", F.lit("clash"))
    got = sorted((r["doc_id"], r["item_id"]) for r in find_leaks(df, items).collect())
    same = [1, 1, 2, 4, 5, 6, 10]
    assert got == sorted([(d, i) for d in same for i in (1, 5)] + [(9, 2)])
    assert find_leaks(df.limit(0), items).collect() == [] and find_leaks(df, items.limit(0)).collect() == []


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    import ledgerloom.llm.leaks as leaks

    df = spark.createDataFrame([(1, ITEM), (2, passage(70, 2))], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, passage(70, 2))], "item_id long, passage string")
    whole = {tuple(r) for r in find_leaks(df, items).collect()}
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 10)
    assert {tuple(r) for r in find_leaks(df, items).collect()} == whole and len(whole) == 2


def test_a_chance_run_beyond_the_end_loses_no_leak():
    index, words = ItemIndex([(1, ITEM)]), ITEM.split()
    far = " ".join(["unknown"] * 20)
    for text in (f"{' '.join(words[:30])} {far} {' '.join(words[38:41])}", f"{' '.join(words[:3])} {far} {' '.join(words[11:41])}"):
        (found,) = index.leaks(normal_words(text))
        assert found[1] == 30 and found[3] - found[2] == 30


@pytest.mark.parametrize("between", [100, 399, 401, 450, 5000])
def test_an_interruption_of_any_length(between):
    words = ITEM.split()
    text = f"{' '.join(words[:15])} {' '.join(['unknown'] * between)} {' '.join(words[15:30])}"
    (found,) = ItemIndex([(1, ITEM)]).leaks(normal_words(text))
    assert found[1:4] == (30, 0, 30) and found[4] == [(0, 15), (15 + between, 30 + between)]


@pytest.mark.parametrize(("n", "leaks"), [(22, 0), (23, 0), (24, 0), (25, 1), (26, 1)])
def test_the_least_stretch(n, leaks):
    text = f"{NOISE[0]} {' '.join(ITEM.split()[9 : 9 + n])} {NOISE[1]}"
    assert len(list(ItemIndex([(1, ITEM)]).leaks(normal_words(text)))) == leaks


def test_planted_changes_are_found_at_any_place():
    """25 to 60 words with one in ten changed, missing or added, whole or interrupted at any distance: all are found."""
    rng, words, index = random.Random(77), ITEM.split(), ItemIndex([(1, ITEM)])
    for trial in range(300):
        n = rng.randint(27, 60)
        start = rng.randint(0, 70 - n)
        part = words[start : start + n]
        for k in rng.sample(range(1, n - 1), int(n * 0.1)):
            kind = rng.randint(0, 2)
            part[k] = "other" if kind == 0 else "" if kind == 1 else part[k] + " added"
        cut = rng.randint(5, n - 5)
        between = " ".join(["unknown"] * rng.choice([0, 0, 9, 50, 395, 405, 5000]))
        text = f"{NOISE[trial % 9]} {' '.join(part[:cut])} {between} {' '.join(part[cut:])} {NOISE[trial % 7]}"
        assert len(list(index.leaks(normal_words(text)))) == 1, (trial, text)


def test_building_alike_is_no_leak():
    index = ItemIndex([(1, ITEM)])
    rng = random.Random(9)
    alike = " ".join(w if i % 5 < 3 else rng.choice(WORDS) for i, w in enumerate(ITEM.split()))
    assert list(index.leaks(normal_words(alike))) == []


@pytest.mark.parametrize("text", ["A <b>bold</b> te-\nst&nbsp;of words.", "x<p>y</p>z", "plain text, no more", "a-\nb-\nc d", ""])
def test_located_words_are_the_normal_words(text):
    words, places = located_words(text)
    assert words == normal_words(text) and all(0 <= a < b <= len(text) for a, b in places)


def test_removal(spark):
    words = ITEM.split()
    between = "These sentences interrupt it. They must stay here. " + NOISE[6]
    docs = {
        1: f"Before it. {ITEM}. After it.",
        2: f"Start. {' '.join(words[:30])} {between} {' '.join(words[30:60])} End.",
        3: "Nothing here " + NOISE[1],
        4: None,
        5: "",
        6: "Keep. " + "&nbsp;".join(f"**{w}**" for w in words) + " Keep too.",
    }
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, ITEM)], "item_id long, passage string")
    got = {r["doc_id"]: r for r in remove_leaks(df, items).collect()}
    assert got[1]["text"].split() == ["Before", "it.", "After", "it."] and got[6]["text"].split() == ["Keep.", "Keep", "too."]
    assert " ".join(got[2]["text"].split()) == f"Start. {between} End."
    for i in (3, 4, 5):
        assert got[i]["text"] == docs[i] and got[i]["removed"] == 0
    assert all(len(got[i]["text"]) + got[i]["removed"] == len(docs[i]) for i in (1, 2, 6))
    assert find_leaks(remove_leaks(df, items).select("doc_id", "text"), items).count() == 0


def test_every_copy_is_removed(spark, monkeypatch):
    import ledgerloom.llm.leaks as leaks

    words, other = ITEM.split(), passage(60, 31).split()
    docs = {
        1: f"Start. {ITEM} {NOISE[0]} {ITEM} End.",
        2: f"Start. {' '.join(words[35:])} {NOISE[1]} {' '.join(words[:35])} End.",
        3: f"Start. {' '.join(words[:30])} {' '.join(NOISE[:8])} {' '.join(words[30:])} End.",
        4: f"Start. {ITEM} {ITEM} End.",
        5: f"Start. {' '.join(words[:9])} {' '.join(other)} {' '.join(words[9:18])} {' '.join(other)} {' '.join(words[18:27])} End.",
    }
    left = {1: NOISE[0], 2: NOISE[1], 3: " ".join(NOISE[:8]), 4: "", 5: ""}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, " ".join(other))], "item_id long, passage string")
    places = find_leaks(df, items, every=True).groupBy("doc_id", "item_id").count().collect()
    assert {(r[0], r[1]): r[2] for r in places if r[1] == 1 and r[0] in (1, 2, 3, 4)} == {(1, 1): 2, (2, 1): 2, (3, 1): 1, (4, 1): 2}
    assert find_leaks(df.where("doc_id < 5"), items).count() == 4
    for size in (leaks.BLOCK_WORDS, 10):
        monkeypatch.setattr(leaks, "BLOCK_WORDS", size)
        got = {r["doc_id"]: r for r in remove_leaks(df, items).collect()}
        assert {i: " ".join(r["text"].split()) for i, r in got.items()} == {i: " ".join(f"Start. {t} End.".split()) for i, t in left.items()}
        assert all(len(got[i]["text"]) + got[i]["removed"] == len(docs[i]) for i in docs)
