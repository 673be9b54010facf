import json

from pyspark.sql import functions as F

from ledgerloom import cli
from ledgerloom.functions.rules import TypeRules
from ledgerloom.operators import catalog, compat, library, reporting
from ledgerloom.operators.ledger import VersionStore
from ledgerloom.streaming.ledger_stream import merge_stream


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_compatibility(spark):
    def cells(table, header, lines):
        return [(table, r, c, header[c], v) for r, line in enumerate(lines) for c, v in enumerate(line)]

    head = ["component", "minimum", "last supported", "links"]
    ranges = cells("01-alpha-switches-software-support.csv", head, [["m1", "30.1", "latest available", ""], ["m2", "Net OS 9.4.1", "31.2", ""]])
    ranges += cells("02-beta.csv", head, [["m1", "12.1", "15.x", ""], ["m2", "11.2", "14.9", ""], ["m3", "n/a", "99", ""]])
    ranges += cells("03-silent.csv", head, [["m", "1.1", "2.1", ""]]) + cells("04-unknown.csv", head, [["m", "1.1", "2.1", ""]]) + cells("05-open.csv", head, [["m", "1.1", "", ""]])
    schema = "table_name string, row_no int, col_no int, header string, value string"
    recommended = cells("r", ["Platform", "Maintenance Release", "Latest Feature Release", "Release Effective Date"], [["Alpha", "Net OS 9.1", "Net OS 9.4", "Net OS 1"], ["Gamma", "Net OS 1", "x", ""], ["", "Net OS 7", "", ""], ["alpha", "Other 3", "", ""]])
    found, unmapped = compat.compatibility(
        {"a": spark.createDataFrame(ranges, schema), "b": spark.createDataFrame(recommended, schema)},
        [
            compat.RangeSource("a", ["Net", "OS"], {"alpha": "Alpha Series", "BETA": "Beta", "open": "Open"}, ["silent"], prefixes="Net OS"),
            compat.RecommendedSource("b", {"Alpha": "Alpha Series"}, {"Net": "Wrong", "Net OS": "OS"}),
        ],
    )
    got = {(r["platform"], r["kind"]): (r["software"], r["min"], r["max"], r["releases"]) for r in found.collect()}
    assert got == {
        ("Alpha Series", "range"): (["Net", "OS"], "9.4.1", None, []),
        ("Beta", "range"): (["Net", "OS"], "11.2", "15.x", []),
        ("Alpha Series", "recommended"): (["OS"], None, None, ["9.1", "9.4"]),
    }
    assert rows(unmapped) == [("a", "04-unknown.csv"), ("b", "Gamma")]


def test_targets_and_links(spark):
    urls = ["https://h/products/a/", "https://h/products/a", "https://h/resources/brief/x", "https://h/resources/brief/", "https://h/resources/video/x", "https://h/other", "https://h/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert rows(catalog.page_targets(df, ["products"], ["brief"])) == [("https://h/products/a",), ("https://h/resources/brief/x",)]
    hit = lambda u: spark.range(1).select(catalog.snapshot_page(F.lit(u), ["/eos", "/rec/*"])).head()[0]
    assert hit("https://h/eos/") and hit("https://h/rec/x") and not hit("https://h/rec/") and not hit("https://h/record")
    keep = spark.createDataFrame([(h,) for h in ("#a", "javascript:x", "MAILTO:a", "tel:1", "", None, "/x")], "h string").where(catalog.keep_link(F.col("h")))
    assert rows(keep) == [("/x",)]


def test_owners_roles_latest(spark):
    edge = "url string, heading string, entry string, ord int"
    owners = catalog.page_owners(spark.createDataFrame([("p1", "H", "E1", 2), ("p1", "H", "E0", 5)], edge), spark.createDataFrame([("p1", "H", "E9", 0), ("p2", "H", "E2", 1)], edge))
    assert rows(owners) == [("p1", "H", "E1"), ("p2", "H", "E2")]
    options = spark.createDataFrame([("E", "All", "p0", 0), ("E", "9.4.1", "p1", 1), ("E", "9.4", "p2", 2), ("E", "9.3", "p3", 3), ("G", "Latest docs", "g0", 0)], "entry string, label string, page string, pos int")
    pages = spark.createDataFrame([("p0", "E", "p0", "All"), ("p1", "E", "p0", "9.4.1"), ("p2", "E", "p0", "9.4"), ("p3", "E", "p0", "9.3"), ("g0", "G", "g0", "Latest docs"), ("g1", "G", "g0", "x")], "page string, entry string, entry_page string, label string")
    assert {r["page"] for r in catalog.latest_mark(options, pages).where("is_latest").collect()} == {"p1", "p2", "g0"}


def test_furniture(spark):
    links = [(f"p{i}", "everywhere") for i in range(10)] + [("p1", "own"), ("p1", "own"), ("p2", "p2/#top")]
    df = spark.createDataFrame(links, "page string, href string")
    assert rows(catalog.furniture(df, 10)) == [("everywhere", 10)] and rows(catalog.furniture(df, 100)) == []
    areas = df.withColumn("area", F.lit("a")).withColumn("is_hub", F.col("href") == "own")
    pages = spark.createDataFrame([("a", f"p{i}") for i in range(10)] + [("b", "x")], "area string, page string")
    wide = catalog.area_furniture(areas.select("area", "page", "href", "is_hub"), pages)
    assert rows(wide) == [("a", "everywhere", 10)]
    kept = catalog.content_links(areas, catalog.furniture(df, 10), wide)
    assert {r["href"] for r in kept.collect()} == {"own"}


def test_health_and_labels(spark):
    pages = spark.createDataFrame(
        [("p", 200, 0, ["m"], 2, ["tabs"], "E"), ("q", 503, 0, None, 0, None, None), ("r", 200, 3, [], 1, [], "E")], "page string, status int, items int, missed array<string>, selects int, signals array<string>, entry string"
    )
    assert {(r["page"], r["check"]) for r in catalog.page_health(pages).collect()} == {("p", "missed-link"), ("p", "extra-dropdown"), ("p", "structure"), ("p", "empty-page"), ("q", "fetch-failed"), ("q", "orphan-page")}
    labels = spark.createDataFrame([("release", "9.4"), ("release", "Beta"), ("entry", "Latest"), ("orphan", "x"), ("entry", "")], "role string, label string")
    assert rows(catalog.unread_labels(labels, "latest")) == [("release", "Beta")]
    assert rows(spark.createDataFrame([("products", True, "Data Sheet"), ("products", True, "more"), ("x", True, "View")], "a string, h boolean, l string").where(catalog.datasheet_link(F.col("a"), F.col("h"), F.col("l"), ["products"])))[0][2] == "Data Sheet"


def test_documents_carry_redirects(spark):
    view = "url string, title string, format string, via string, host string, ord int"
    a = spark.createDataFrame([("u", "A", "pdf", "", "", 2), ("u", "first", "pdf", "", "", 1)], view)
    b = spark.createDataFrame([("u", "B", "pdf", "", "", 0), ("v", "V", "pdf", "", "", 0)], view)
    known = "url string, redirect string, revision string"
    got = catalog.documents([a, b], spark.createDataFrame([("u", "old", "AA"), ("v", "kept", "BB")], known), spark.createDataFrame([("u", "new", "CC"), ("v", "", "")], known))
    assert {(r["url"], r["title"], r["redirect"], r["revision"]) for r in got.collect()} == {("u", "first", "new", "CC"), ("v", "V", "kept", "BB")}


def test_document_tree(spark):
    listing = "heading string, entry string, title string, release string, latest string, month string, format string, via string, url string, ord int"
    l = spark.createDataFrame([("H", "E", "Guide", "9.3", "yes", "", "pdf", "", "u", 1), ("H", "E", "Guide", "9.5", "", "", "pdf", "", "u", 2), ("H", "E", "Guide", "9.1", "yes", "", "pdf", "", "u", 3)], listing)
    d = catalog.entry_documents(l, TypeRules(by_title=[("Guide", "guide")]))
    assert [(r["release"], r["is_latest"], r["type"]) for r in d.collect()] == [("9.1", True, "Guide")]
    sheets = spark.createDataFrame([("E", "s?1", 1), ("E", "s?2", 2), ("P", "t", 3), ("Q", "q", 4)], "product string, url string, ord int")
    entries = spark.createDataFrame([("E",), ("F",)], "entry string")
    got = {r["url"]: (r["title"], r["ents"]) for r in catalog.datasheet_documents(sheets, entries, {"P": ["F", "gone"], "Q": []}).collect()}
    assert got == {"s?1": ("E Data Sheet", ["E"]), "t": ("P Data Sheet", ["F"]), "q": ("Q Data Sheet", [])}
    main = "url string, page string, area string, heading string, label string, via string, ord int"
    links = [
        ("a", "https://h/policies/", "support/policies", "Head", "Download PDF", "content_hub", 1), ("a", "https://h/resources/brief/x", "resources/solution-brief", "", "l", "content_hub", 2),
        ("b", "https://h/support/training/my-track", "support/training", "Course", "Outline", "content_hub", 3), ("c", "https://h/resources/brief/x", "resources/solution-brief", "", "l", "content_hub", 4),
        ("d", "https://h/x", "products", "", "l", "content_hub", 5), ("d", "https://h/policies", "support/policies", "", "ZIP Download", "content_hub", 6), ("e", "https://h/policies", "s", "", "l", "direct", 7),
    ]
    titles = spark.createDataFrame([("https://h/resources/brief/x", "Title | Site")], "url string, title string")
    got = {r["url"]: (r["entry"], r["title"], r["type"]) for r in catalog.main_documents(spark.createDataFrame(links, main), titles, [("Policy", "policies", "Policies")], site_suffix=" | Site").collect()}
    assert got == {"a": ("Policies", "Head", "Policy"), "b": ("My Track", "Course (Outline)", "Course Outline"), "c": ("Solution briefs", "Title", "Brief"), "d": ("Policies", "MIBs (ZIP)", "Policy")}


LOCK = "url string, path string, sha256 string, bytes bigint, title string, etag string, last_modified string, fetched string, earlier array<struct<sha256:string,bytes:bigint,last_modified:string,fetched:string>>"
SEEN = "url string, head_status int, etag string, last_modified string, content_length bigint, status int, sha256 string, on_disk boolean, bytes bigint, title string"


def test_library_from_update_to_drop(spark):
    lock = spark.createDataFrame(
        [("same", "p1", "s1", 1, "t", "e1", "", "d1", []), ("content", "p2", "s2", 1, "t", "", "", "d1", []), ("again", "p3", "s3", 1, "t", "x", "", "d1", []), ("drop", "p4", "s4", 1, "t", "", "", "d1", []), ("down", "p5", "s5", 1, "t", "", "", "d1", [])], LOCK
    )
    seen = spark.createDataFrame(
        [("same", 200, "e1", "", 1, 0, None, True, 1, "t"), ("content", 404, "", "", 1, 200, "s2", True, 1, "t"), ("again", 200, "y", "", 1, 200, "new", True, 2, "t2"), ("new", 200, "", "", 1, 200, "n", False, 3, "t3"), ("down", 0, "", "", None, 0, None, True, None, None)], SEEN
    )
    plan = spark.createDataFrame([("same", "q1"), ("content", "q2"), ("again", "q3"), ("new", "q6"), ("down", "q5")], "url string, path string")
    d = library.sync_decisions(plan, lock, seen)
    assert rows(d) == [("again", "p3", "updated"), ("content", "p2", "same"), ("down", "p5", "failed"), ("drop", "p4", "dropped"), ("new", "q6", "new"), ("same", "p1", "same")]
    after = {r["url"]: r for r in library.next_lock(lock, d, seen, "d2").collect()}
    assert set(after) == {"same", "content", "again", "new", "down"}
    assert after["again"]["sha256"] == "new" and [e["sha256"] for e in after["again"]["earlier"]] == ["s3"] and after["same"]["fetched"] == "d1" and after["new"]["fetched"] == "d2"
    assert {tuple(r) for r in library.moved_aside(d, "archive", "d2").collect()} == {("p3", ".library/archive/p3 (d2)"), ("p4", ".library/archive/p4 (d2)")}
    assert library.history_entry(d, "d2").count() == 4
    files = spark.createDataFrame([("p1", "s1"), ("p2", "zz"), ("x", "y")], "path string, sha256 string")
    assert rows(library.check_files(lock.where("path IN ('p1', 'p2', 'p3')"), files)) == [("p1", "ok"), ("p2", "changed"), ("p3", "missing"), ("x", "new")]
    heads = seen.select("url", "head_status", "etag", "last_modified", "content_length")
    assert dict(rows(library.remote_verdicts(lock, heads))) == {"same": "ok", "content": "unreachable", "again": "upstream", "drop": "unreachable", "down": "unreachable"}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("a", 5), ("c", 2), ("c", 9)], "v string, ord int")
    assert [(r["name"], r["n"]) for r in reporting.most_common(reporting.counted(df, "s", F.col("v"), "ord")).collect()] == [("c", 2), ("a", 2), ("b", 1)]
    docs = spark.createDataFrame([("E", "Guide", "t</a"), ("E", "Guide", "t"), ("F", "Notes", "t")], "entry string, type string, title string")
    assert rows(reporting.matrix(docs, ["Guide", "Notes"])) == [("E", 2, 0), ("F", 0, 1)]
    shown = docs.selectExpr("entry", "type", "title", "concat(title, entry) AS url", "'' AS month", "'' AS release", "'' AS format", "'' AS via")
    parts = reporting.explorer_rows(shown, most=1).collect()
    assert len(parts) >= 2 and sum(len(json.loads(r["json"])["d"]) for r in parts) == 3 and all("</" not in r["json"] for r in parts)
    assert "| entry | type | title |" in reporting.table_markdown(docs) and "1 more" in reporting.table_markdown(docs, 2)
    file = tmp_path / "r.md"
    assert not reporting.replace_block(file, "n", "x")
    file.write_text("a\n<!-- n:begin -->\nold\n<!-- n:end -->\nz\n")
    assert reporting.replace_block(file, "n", "new") and file.read_text() == "a\n<!-- n:begin -->\nnew\n<!-- n:end -->\nz\n" and not reporting.replace_block(file, "m", "x")
    (tmp_path / "2025-01-01").mkdir()
    (tmp_path / "2025-01-01/notes.md").write_text("# Notes\nStatus: open\nkeep\n")
    target = tmp_path / "2025-02-01/notes.md"
    assert reporting.latest_report(tmp_path) == "2025-01-01" and reporting.carry_notes(tmp_path / "2025-01-01/notes.md", target) and "keep" in target.read_text() and "Status" not in target.read_text()
    assert not reporting.carry_notes(tmp_path / "2025-01-01/notes.md", target)
    checks = reporting.to_check({"few": (docs, "entry", 1), "none": (docs.limit(0), "entry", 3)})
    assert [tuple(r) for r in checks.collect()] == [("few", 3, "E")]
    report = reporting.render_report({"summary": [{"ledger": "l", "change": "new", "n": 2}], "to_check": [], "catalog": []}, "2025-01-01")
    assert "* l: 2 new" in report


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "build_session", lambda: spark)
    root, keys = str(tmp_path / "store"), json.dumps({"listings": ["url"]})
    for n, day, data in ((1, "2025-01-01", [("a", "A", 1), ("b", "B", 2)]), (2, "2025-02-01", [("a", "A2", 1), ("b", "B", 2), ("c", "C", 3)])):
        spark.createDataFrame(data, "url string, title string, ord int").write.parquet(str(tmp_path / f"in{n}/listings.parquet"))
        assert cli.main(["scan", root, str(tmp_path / f"in{n}"), "--site", "s", "--keys", keys, "--today", day]) == 0
    capsys.readouterr()
    assert cli.main(["compare", root, "2025-01-01", "2025-02-01", "--keys", keys, "--shown", json.dumps({"listings": ["title"]}), "--report", str(tmp_path / "r.md")]) == 0
    assert json.loads(capsys.readouterr().out) == [{"ledger": "listings", "change": "changed", "n": 1}, {"ledger": "listings", "change": "new", "n": 1}]
    assert cli.main(["due", root, "--sites", "s", "--today", "2025-02-02"]) == 1 and cli.main(["due", root, "--sites", "s", "x", "--today", "2025-02-02"]) == 0
    library_root = tmp_path / "lib"
    (library_root / "sub").mkdir(parents=True)
    (library_root / "sub/f.txt").write_bytes(b"hi")
    lock = str(tmp_path / "lock")
    import hashlib

    spark.createDataFrame([("sub/f.txt", hashlib.sha256(b"hi").hexdigest())], "path string, sha256 string").write.parquet(lock)
    assert cli.main(["check", str(library_root), lock]) == 0
    (library_root / "extra").write_bytes(b"x")
    assert cli.main(["check", str(library_root), lock]) == 1


def test_nothing_is_cut_from_changes_and_checks(spark, tmp_path, capsys):
    root, keys, shown = str(tmp_path / "store"), json.dumps({"listings": ["url"]}), json.dumps({"listings": ["title"]})
    for day, title in (("2025-01-01", "A"), ("2025-02-01", "B")):
        spark.range(1200).selectExpr("format_string('u%04d', id) AS url", f"'{title}' AS title", "id AS ord").write.parquet(str(tmp_path / f"{day}/listings.parquet"))
        assert cli.main(["scan", root, str(tmp_path / day), "--site", "s", "--keys", keys, "--today", day]) == 0
    assert cli.main(["compare", root, "2025-01-01", "2025-02-01", "--keys", keys, "--shown", shown, "--changes", str(tmp_path / "all")]) == 0
    changes = spark.read.parquet(str(tmp_path / "all/listings"))
    assert changes.count() == 1200 and {r["change"] for r in changes.collect()} == {"changed"}
    counts = spark.createDataFrame([("listings", "changed", 1200)], "ledger string, change string, n long")
    document = reporting.write_changes(tmp_path, counts, spark.createDataFrame([("c", 1, "x")], "check string, n long, sample string"), changes)
    assert len(document["catalog"]) == 1000 and document["left_out"] == 200 and document["left_out_summary"] == document["left_out_to_check"] == 0
    assert json.loads((tmp_path / "changes.json").read_text()) == document
    assert spark.read.parquet(str(tmp_path / "changes/catalog")).count() == 1200 and spark.read.parquet(str(tmp_path / "changes/to_check")).count() == 1
    spark.range(1100).selectExpr("format_string('f%04d', id) AS path", "'x' AS sha256").write.parquet(str(tmp_path / "lock"))
    (tmp_path / "lib").mkdir()
    capsys.readouterr()
    assert cli.main(["check", str(tmp_path / "lib"), str(tmp_path / "lock"), "--out", str(tmp_path / "verdicts")]) == 1
    said = capsys.readouterr().out.split("\n")
    assert said[0] == "files: 0 ok, 1100 missing, 0 changed, 0 new" and said[1:-1] == [f"missing: f{i:04d}" for i in range(1100)]
    assert spark.read.parquet(str(tmp_path / "verdicts")).count() == 1100


def test_stream_of_deliveries(spark, tmp_path):
    schema = "url string, title string, scan_date string, row_id long"
    source = str(tmp_path / "in")
    spark.createDataFrame([("a", "A", "d1", 1), ("b", "B", "d1", 2)], schema).write.parquet(source)
    store = VersionStore(spark, str(tmp_path / "store"))
    run = lambda: merge_stream(spark.readStream.schema(schema).parquet(source), store, "l", ["url"], str(tmp_path / "cp")).awaitTermination()
    run()
    spark.createDataFrame([("a", "A2", "d2", 3)], schema).write.mode("append").parquet(source)
    run()
    assert rows(store.read("l")) == [("a", "A2", "d1", "d2"), ("b", "B", "d1", "d1")] and store.versions() == ["d1", "d2"]


def test_a_late_day_is_not_lost(spark, tmp_path):
    schema = "url string, title string, scan_date string, row_id long"
    source = str(tmp_path / "in")
    store = VersionStore(spark, str(tmp_path / "store"))
    for day, delivered in (("2025-02-01", [("a", "A"), ("b", "B")]), ("2025-01-01", [("a", "old"), ("c", "C")]), ("2025-02-01", [("a", "A"), ("b", "B")]), ("2025-03-01", [("c", "C3")])):
        spark.createDataFrame([(u, t, day, i) for i, (u, t) in enumerate(delivered)], schema).write.mode("append").parquet(source)
        merge_stream(spark.readStream.schema(schema).parquet(source), store, "l", ["url"], str(tmp_path / "cp")).awaitTermination()
        if day < "2025-03":
            late = [("c", "C", "2025-01-01", "2025-01-01")] if store.read("l").where("url = 'c'").count() else []
            assert rows(store.read("l")) == [("a", "A", "2025-01-01" if late else "2025-02-01", "2025-02-01"), ("b", "B", "2025-02-01", "2025-02-01"), *late]
    places = store._manifest("2025-03-01")["l"]
    assert len({p.split("/")[1] for p in places.values()}) > 1  # the last delivery left other buckets where they were
    assert store.read("l", buckets=[]).count() == 0 and store.read("l", "2025-02-15").count() == 3
    assert rows(store.read("l"))[-1] == ("c", "C3", "2025-01-01", "2025-03-01") and store.versions() == ["2025-02-01", "2025-03-01"]


def test_all_checks_after_a_scan(spark):
    make = lambda values, schema: spark.createDataFrame(values, schema)
    change = "change string, name string, latest boolean"
    changes = {
        "listings": make([("new", "A", True), ("new", "B", False), ("no_longer_listed", "u", False)], change),
        "documents": make([("changed", "g", False), ("new", "h", False)], change),
        "datasheets": make([("new", "s", False), ("changed", "t", False)], change),
    }
    pages = make([("A", "d1", "d2"), ("New", "d2", "d2")], "entry string, first_seen string, last_seen string")
    name = lambda *values: make([(v,) for v in values], "name string")
    got = reporting.scan_checks(changes, name("recommended", "x", "y"), name("h"), pages, make([("A",), ("Lost",)], "entry string"), name("l"), name("s"), name("m"), name("p"), ("1", "2"))
    assert {r["check"]: (r["n"], r["sample"]) for r in got.collect()} == {
        "scanner version changed": (1, "1 to 2"), "recommendation pages changed": (1, "recommended"), "other snapshots changed": (2, "x, y"), "new latest documents": (1, "A"),
        "rows no longer listed": (1, "u"), "guides redirect elsewhere": (1, "g"), "datasheets changed": (1, "s"), "health changed": (1, "h"), "new entries": (1, "New"),
        "profiles name unknown entries": (1, "Lost"), "unread labels": (1, "l"), "slow steps": (1, "s"), "unmapped names": (1, "m"), "unplaced products": (1, "p"),
    }
    none = reporting.scan_checks({}, name("x").limit(0), name("x").limit(0), pages.where("entry = 'A'"), make([("A",)], "entry string"), *[name("x").limit(0)] * 4)
    assert none.collect() == []
