"""Problems 2 and 6 on the driver's small tables against plain versions that look at everything."""

import json
import re
from collections import defaultdict

from ledgerloom.plans.found import p1_found, p2_found, p6_found
from ledgerloom.session import table


def kind(v):
    return "text" if isinstance(v, str) else "flag" if isinstance(v, bool) else "number" if isinstance(v, int | float) else "list"


def test_schema_changes(spark, sf_dir):
    files, meta = defaultdict(dict), {}
    for r in table(spark, sf_dir, "support_rows").collect():
        files[r["file_id"]][r["record"]] = {re.sub(r"\s+", " ", k.strip().lower()): v for k, v in json.loads(r["record"]).items()}
        meta[r["file_id"]] = (r["table_name"], r["scan_no"])
    series = defaultdict(dict)
    for f, (t, s) in meta.items():
        series[t][s] = f
    text = lambda v: json.dumps(v)

    def identifies(rows, c):
        held = [text(r[c]) for r in rows if r.get(c) is not None]
        return len(held) >= 0.9 * len(rows) and len(set(held)) == len(held)

    want = set()
    for scans in series.values():
        order = sorted(scans)
        for a, b in zip(order, order[1:]):
            old, new, f = list(files[scans[a]].values()), list(files[scans[b]].values()), scans[b]
            was, now = {k for r in old for k in r}, {k for r in new for k in r}
            gone, come, used = was - now, now - was, set()
            for k in was & now:
                x, y = ({kind(r[k]) for r in rows if r.get(k) is not None} for rows in (old, new))
                if x and y and x != y:
                    want.add((f, "retyped", k, k))
            anchors = [(x, y) for x in was for y in ([x] if x in now else come) if identifies(old, x) and identifies(new, y)]
            common = lambda p: len({text(r[p[0]]) for r in old if r.get(p[0]) is not None} & {text(r[p[1]]) for r in new if r.get(p[1]) is not None})  # noqa: B023, E731
            if anchors:
                x, y = max(anchors, key=common)
                left, right = {text(r.get(x)): r for r in old}, {text(r.get(y)): r for r in new}
                for g in gone:
                    for c in come:
                        pairs = [(left[k].get(g), right[k].get(c)) for k in left.keys() & right.keys()]
                        pairs = [p for p in pairs if None not in p]
                        if pairs and sum(u == v for u, v in pairs) >= 0.8 * len(pairs):
                            want.add((f, "renamed", g, c))
                            used |= {("g", g), ("c", c)}
            want |= {(f, "removed", g, "") for g in gone if ("g", g) not in used} | {(f, "added", "", c) for c in come if ("c", c) not in used}
    assert {tuple(r) for r in p6_found(spark, sf_dir).collect()} == want and len(want) > 5


def test_moments_are_unambiguous_and_ordered_like_the_text(spark, sf_dir):
    """Every result has one of the three forms, and the digits of plain ISO values come out as they stand."""
    found = {(r["source_table"], r["row_id"]): r["moment"] for r in p2_found(spark, sf_dir).collect()}
    assert found and all(re.fullmatch(r"\d{4}-\d{2}(-\d{2}(T\d{2}:\d{2}:\d{2}Z)?)?", m) for m in found.values())
    for name, field in (("recommendations", "recommendation_effective_date"), ("eos_notices", "end_of_sale")):
        for r in table(spark, sf_dir, name).select("row_id", field).collect():
            value = (r[1] or "").strip()
            if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) and 1 <= int(value[5:7]) <= 12 and int(value[8:]) <= 28:
                assert found[name, r[0]] == value
            if re.fullmatch(r"\d{4}-\d{2}-\d{2}T[\d:]{8}(\.\d+)?Z", value):
                assert found[name, r[0]] == value[:19] + "Z"


def test_values_are_parts_of_their_cells(spark, sf_dir):
    """Nothing is invented or lost: the values of a cell, in order, are all of its text but delimiters and quotes."""
    by = defaultdict(list)
    for r in p1_found(spark, sf_dir).collect():
        by[r["source_table"], r["row_id"]].append((r["pos"], r["val"]))
    plain = lambda s: re.sub(r"""[\s,;|"'“”/&]|\b(and|or)\b""", "", s)
    for name, field in (("ap_firmware", "supported_fw_versions"), ("eos_notices", "replacement_product")):
        for r in table(spark, sf_dir, name).select("row_id", field).collect():
            values = [v for _, v in sorted(by.get((name, r[0]), []))]
            assert [p for p, _ in sorted(by.get((name, r[0]), []))] == list(range(1, len(values) + 1))
            if values:
                assert plain("".join(values)) == plain(r[1])
            else:
                assert not r[1] or not r[1].strip() or r[1].strip().lower() in ("n/a", "-")
