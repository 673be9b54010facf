"""Problems 5 and 8 on the driver's small tables against plain versions that compare everything with everything."""

import re

from ledgerloom.llm.found import p5_mapped, p8_found
from ledgerloom.llm.leaks import normal_words
from ledgerloom.session import table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    d = distance(a, b)
    return d <= 1 and len(b) >= 3 or d == 2 and (len(b) >= 5 or sorted(a) == sorted(b))


def test_entries(spark, sf_dir):
    entries = {r["entry_id"]: r["entry"] for r in table(spark, sf_dir, "entries").collect()}
    models = {re.search(r"LP\d+\w*|\d{4}", e)[0].lower(): i for i, e in entries.items() if re.search(r"\d{3}", e)}
    named = {i: e.lower().split() for i, e in entries.items() if not re.search(r"\d{3}", e)}
    whole = {"".join(words): i for i, words in named.items()}
    checked = 0
    for r in p5_mapped(spark, sf_dir).select("value", "entry_id").distinct().collect():
        bare = re.sub("[​®™]", "", r["value"])
        number = re.search(r"(?i)lp[\s-]*\d{3}[\s-]*[a-z]{0,2}\b|(?<!\d)\d{4}(?!\d)", bare)
        if number:
            want = models.get(re.sub(r"[\s-]", "", number[0]).lower(), 0)
        else:
            words = re.findall(r"[^\W\d_]+\.?", re.sub(r"([a-z])([A-Z])(?=[a-zA-Z]{2})", r"\1 \2", bare))
            words = [w.lower() for w in words]
            met = lambda part: any(near(w.rstrip("."), part) or w.endswith(".") and part.startswith(w[:-1]) for w in words)  # noqa: B023, E731
            full = [i for i, parts in named.items() if all(map(met, parts))]
            want = full[0] if full else next((i for s, i in whole.items() if any(distance(w, s) <= 2 for w in words)), 0)
        assert r["entry_id"] == want, r["value"]
        checked += 1
    assert checked > 50


def aligned(doc, item):
    """Best score of a local alignment (+1 for a word repeated, -2 otherwise) that may jump ahead in the document once."""
    m = len(item)
    plain, jumped, ahead = [0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    best = 0
    for x in doc:
        now, then = [0] * (m + 1), [0] * (m + 1)
        for j, y in enumerate(item, 1):
            s = 1 if x == y else -2
            now[j] = max(0, plain[j - 1] + s, plain[j] - 2, now[j - 1] - 2)
            then[j] = max(0, jumped[j - 1] + s, jumped[j] - 2, then[j - 1] - 2, ahead[j - 1] + s)
            best = max(best, then[j], now[j])
        ahead = [max(a, b) for a, b in zip(ahead, now)]
        plain, jumped = now, then
    return best


def test_leaks(spark, sf_dir):
    items = {r["item_id"]: normal_words(r["passage"]) for r in table(spark, sf_dir, "eval_items").collect()}
    grams = {}
    for i, words in items.items():
        for k in range(len(words) - 2):
            grams.setdefault(tuple(words[k : k + 3]), set()).add(i)
    want = set()
    for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        words = normal_words(r["text"])
        shared = {}
        for k in range(len(words) - 2):
            for i in grams.get(tuple(words[k : k + 3]), ()):
                shared[i] = shared.get(i, 0) + 1
        want |= {(r["doc_id"], i) for i, n in shared.items() if n >= 5 and aligned(words, items[i]) >= 15}
    assert {tuple(r) for r in p8_found(spark, sf_dir).collect()} == want and want
