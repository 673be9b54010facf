import pytest

from ledgerloom import cli
from ledgerloom.operators import library, scan
from ledgerloom.operators.ledger import GuardError, VersionStore
from ledgerloom.operators.reporting import render_last_scan
from ledgerloom.sources import files

HOSTS = {"own_hosts": ["vendor.example"], "portal_hosts": ["docs.vendor.example"], "hub_hosts": ["hubstore"]}
D, M = "https://docs.vendor.example", "https://www.vendor.example"
MENU = "<select><option value=''>-</option><option value='/entry/a/'>All</option><option value='/entry/a/2'>Version 2.1</option><option value='/entry/a/1'>Version 1.9</option></select>"
RAW = [
    (f"{D}/", 200, "<section><h2>H1</h2><a href='/entry/a/'>A</a><a href='/entry/b/'>B</a></section><section><h2>H2</h2><a href='/entry/a/'>A again</a></section>"),
    (f"{D}/entry/a/", 200, f"<title>A | Docs</title>{MENU}<li><a href='/g/'><h3>Guide</h3> Sept 2019</a>"),
    (f"{D}/entry/a/2", 200, f"<title>A 2</title>{MENU}<li><a href='n.pdf'><h3>Notes</h3> May 2020</a>"),
    (f"{D}/entry/a/1", 200, f"<title>A 1</title>{MENU}"),
    (f"{D}/entry/b/", 503, None),
    (f"{D}/entry/z/", 200, "<title>Z</title><li><a href='z.zip'><h3>Zip</h3></a>"),
]


def test_docs_site(spark):
    raw = spark.createDataFrame(RAW, "url string, status int, body string")
    got = scan.scan_docs(raw, f"{D}/", "/entry/", HOSTS, "| Docs")
    pages = {r["page"].removeprefix(D): (r["heading"], r["entry"], r["role"], r["latest"], r["release"], r["items"]) for r in got["pages"].collect()}
    assert pages == {
        "/entry/a/": ("H1", "A", "entry", "", "All", 1),
        "/entry/a/2/": ("H1", "A", "release", "yes", "2.1", 1),
        "/entry/a/1/": ("H1", "A", "release", "", "1.9", 0),
        "/entry/b/": ("H1", "B", "entry", "yes", "", 0),
        "/entry/z/": ("", "", "orphan", "", "", 1),
    }
    listings = {r["title"]: (r["entry"], r["month"], r["format"], r["via"], r["url"].removeprefix(D)) for r in got["listings"].collect()}
    assert listings == {"Guide": ("A", "2019-09", "pdf", "html_guide", "/g/"), "Notes": ("A", "2020-05", "pdf", "direct", "/entry/a/n.pdf"), "Zip": ("", "", "zip", "direct", "/entry/z/z.zip")}
    assert {(r["check"], r["page"].removeprefix(D)) for r in got["health"].collect()} == {("empty-page", "/entry/a/1/"), ("fetch-failed", "/entry/b/"), ("orphan-page", "/entry/z/")}
    moved = scan.guide_redirects(spark.createDataFrame([("https://h/g", 200, '<meta http-equiv="refresh" content="0;url=ug_revabdev/"/>'), ("https://h/n", 200, None)], "url string, status int, body string"))
    assert [tuple(r) for r in moved.collect()] == [("https://h/g", "https://h/g/ug_revabdev/", "AB")]


ARCHIVE = [
    (f"{D}/support/release-notes", 200, "<select><option value=''>-<option value='/release-notes/product/sw/'>S<option value='/release-notes/product/sw'>S<option value='/release-notes/product/ap/'>P<option value='/release-notes/product/lost/'>L<option value='/release-notes/product/gone/'>G<option value='/entry/b/'>B</select>"),
    (f"{D}/release-notes/product/sw/", 200, f"<main><a href='https://www.vendor.example/n1.pdf'>N1</a><a href='https://www.vendor.example/n1.pdf'>N1 again</a><a href='{D}/entry/a/'>Back</a><a href='https://x.hubstore.example/n2'>N2</a></main>"),
    (f"{D}/release-notes/product/ap/", 200, "<main><a href='https://www.vendor.example/n1.pdf'>N1 of P</a></main>"),
    (f"{D}/release-notes/product/gone/", 404, "<a href='https://www.vendor.example/404.pdf'>no</a>"),
]


def test_release_notes_archive(spark, tmp_path):
    raw = spark.createDataFrame(RAW + ARCHIVE, "url string, status int, body string")
    got, plain = scan.scan_docs(raw, f"{D}/", "/entry/", HOSTS, "| Docs"), scan.scan_docs(spark.createDataFrame(RAW, "url string, status int, body string"), f"{D}/", "/entry/", HOSTS, "| Docs")
    notes = {(r["archive_page"], r["title"], r["format"], r["via"], r["url"]) for r in got["release-notes"].collect()}
    assert notes == {("sw", "N1", "pdf", "direct", f"{M}/n1.pdf"), ("sw", "N2", "file", "content_hub", "https://x.hubstore.example/n2"), ("ap", "N1 of P", "pdf", "direct", f"{M}/n1.pdf")}
    assert {(r["page"].split("/")[-2], r["status"]) for r in got["archive_pages"].collect()} == {("sw", 200), ("ap", 200), ("lost", 0), ("gone", 404)}
    for name in ("pages", "listings", "health"):  # the archive's own pages are no documentation pages
        assert sorted(map(str, got[name].collect())) == sorted(map(str, plain[name].collect()))
    assert plain["release-notes"].count() == 0 and plain["archive_pages"].count() == 0
    store, parts, keys = VersionStore(spark, str(tmp_path / "store")), {"release-notes": got["release-notes"]}, {"release-notes": ["archive_page", "url"]}
    with pytest.raises(GuardError):
        cli.publish_scan(store, "2025-01-01", parts, keys, "docs-site", watched={"archive_pages": got["archive_pages"]})
    fine = got["archive_pages"].where("status = 200")
    assert cli.publish_scan(store, "2025-01-01", parts, keys, "docs-site", watched={"archive_pages": fine}) == {"archive_pages": 2, "release-notes": 3}
    with pytest.raises(GuardError):
        cli.publish_scan(store, "2025-01-02", parts, keys, "docs-site", watched={"archive_pages": fine.limit(1)})


def test_main_site(spark):
    nav = "<a href='/contact'>Contact</a>"
    raw = [(f"{M}/products/p{i}/", 200, f"<title>P{i} | Vendor</title><main><h2>Files</h2><a href='https://a.hubstore.example/d{i}'>Data Sheet</a>{nav}</main>") for i in range(9)]
    raw.append((f"{M}/support/x/", 404, None))
    got = scan.scan_main(spark.createDataFrame(raw, "url string, status int, body string"), ["products"], HOSTS)
    assert got["listings"].count() == 9 and {r["label"] for r in got["listings"].collect()} == {"Data Sheet"}
    assert {(r["product"], r["url"]) for r in got["datasheets"].collect()} == {(f"P{i}", f"https://a.hubstore.example/d{i}") for i in range(9)}
    assert {r["metric"]: r["n"] for r in scan.main_summary(got["pages"]).collect()} == {"pages": 10, "failed": 1, "hub_files": 9, "links": 9}


def test_snapshots(spark, tmp_path):
    body = "<title>Notices | Site</title><main><table><tr><th>a</th></tr><tr><td>1</td></tr><tr><td>2</td></tr></table></main>"
    raw = spark.createDataFrame([("https://h/notices/", 200, body), ("https://h/lost", 500, None)], "url string, status int, body string")
    got = scan.scan_snapshots(raw, "main-site")
    assert {tuple(r)[:6] for r in got["index"].collect()} == {("main-site", "main-site/notices", "Notices", 200, 1, 2), ("main-site", "", "", 500, 0, 0)}
    assert [tuple(r) for r in scan.snapshot_totals(got["index"]).collect()] == [("main-site", 2, 1, 2)]
    for _ in range(2):
        scan.write_snapshots(got["cells"], str(tmp_path / "cells"))
    assert spark.read.parquet(str(tmp_path / "cells")).count() == 4
    assert library.copy_snapshots(got["index"], ["main-site/notices", "x"]).count() == 1 and library.copy_snapshots(got["index"], []).count() == 0


def test_files_beside_the_library(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.md").write_text("<!-- Generated by x -->\nbody")
    (tmp_path / "s/b.md").write_bytes(b"body")
    hashes = {r["name"]: r["hash"] for r in files.snapshot_hashes(spark, str(tmp_path / "s")).collect()}
    assert hashes["a"] == hashes["b"]
    schema = "path string, sha256 string"
    assert files.load_lock(spark, str(tmp_path / "lock"), schema).count() == 0
    files.save_lock(spark.createDataFrame([("b", "2"), ("a", "1")], schema), str(tmp_path / "lock"))
    assert [r["path"] for r in files.load_lock(spark, str(tmp_path / "lock"), schema).collect()] == ["a", "b"]
    (tmp_path / "f.pdf").write_text("x")
    (tmp_path / "g.pdf").write_text("x")
    moves = spark.createDataFrame([("f.pdf", ".library/archive/f (d).pdf"), ("g.pdf", None), ("none.pdf", None)], "path string, target string")
    assert library.set_aside(tmp_path, moves) == 2 and (tmp_path / ".library/archive/f (d).pdf").exists() and not (tmp_path / "g.pdf").exists()
    text = render_last_scan({"scanned": {"a": "2025-01-01"}, "counts": {"a": {"pages": 1234}}, "timing": {"steps": [{"step": "s", "pages": 5, "seconds": 2.0}]}})
    assert "1,234 pages" in text and "5 pages in 2.0 s" in text and render_last_scan({}) == "No scan yet."
