import io
import zipfile

import pytest

from ledgerloom.sources import fetch, files, html

PAGE = """<?xml version="1.0"?><html><head><title>Guide list | Docs</title></head><body><header><a href="/x.pdf">no</a></header>
<select><option value="">Pick</option><option value="/entry/a/all">All</option><option value="/entry/a/9">Version 9.4.1.0</option><option value="/entry/a/8">Version 9.3</option></select>
<ul><li><a href="../f/one.pdf"><h4>One &amp; only</h4><span>Sept 2019</span></a><li><a href="/two"><h3>Two</h3> May 2020</a><li><a href="/plain">no heading</a></ul>
<p>text<p>more <b>bold <a href="/missed.zip">zip</a><a href="#x">here</a><iframe src="y"></iframe><button>Load more</button></body></html>"""
WANTED = r"/entry/"


def test_docs_page():
    page = html.docs_page(PAGE, "https://docs.example/entry/a/9/", WANTED, "| Docs")
    assert page["title"] == "Guide list" and page["selected"] == "9.4.1.0"
    assert [o["label"] for o in page["options"]] == ["All", "9.4.1.0", "9.3"]
    assert page["items"] == [{"title": "One & only", "date": "Sept 2019", "url": "https://docs.example/entry/a/f/one.pdf"}, {"title": "Two", "date": "May 2020", "url": "https://docs.example/two"}]
    assert page["missed"] == ["https://docs.example/missed.zip"] and page["selects"] == 1 and page["signals"] == ["iframe", "load-more"]
    for broken in (None, "", b"\xff<p><b><table><tr><td>", "<" * 5000, "<div>" * 20_000):
        assert html.docs_page(broken, "https://h/", WANTED)["items"] == []


def test_index_and_links():
    body = "<section><h2>A &amp; B</h2><a href='/entry/1'>One</a><a href='/entry/2'></a></section><section><h3>C</h3><a href='/entry/1'>Again</a><a href='/entry/3'>Three</a><a href='/x'>no</a></section>"
    assert html.index_entries(body, "https://h/", WANTED) == [("A & B", "One", "https://h/entry/1"), ("C", "Three", "https://h/entry/3")]
    body = "<nav><a href='/n'>n</a></nav><main><a href='a'>first</a><h2>H</h2><a href='/b' title='T'><img></a><a href='mailto:x'>m</a><a href='/c' aria-label='L'></a></main>"
    assert html.content_links(body, "https://h/p/") == [(0, "first", "https://h/p/a", ""), (1, "T", "https://h/b", "H"), (2, "L", "https://h/c", "H")]
    assert html.archive_pages("<select><option value='/arch/1'>a<option value='/arch/1'>b<option value='/z'>c</select>", "https://h", "/arch/") == ["https://h/arch/1"]


SNAP = """<title>Notices | Site</title><main><h2>Dates</h2><p>Intro</p><p>Intro</p><div role="tablist"><button role="tab" id="t1">Switches</button></div>
<div role="tabpanel" aria-labelledby="t1"><table><thead><th>Name<th>Date</th><th>|</th></thead><tbody><tr><td>A<td><span style="display: none">2020</span>1 May<td><a href="/x">x</a></table></div>
<table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>2</td></tr></table><script>no()</script><form>no</form></main>"""


def test_snapshot_page(spark):
    page = html.snapshot_page(SNAP, "https://h/")
    assert page["title"] == "Notices"
    assert page["tables"][0] == {"caption": "Switches", "header": ["Name", "Date", "|"], "rows": [["A", "1 May", "x"]], "links": ["https://h/x"]}
    assert page["tables"][1]["header"] == ["k", "v"] and page["tables"][1]["caption"] == "Dates" and page["tables"][1]["rows"] == [["1", "2"]]
    assert page["md"].count("Intro") == 1 and "no()" not in page["md"] and "\\|" in page["md"]
    rows = "".join(f"<tr><td>{i}</td></tr>" for i in range(400))
    assert "400 rows in all" in html.snapshot_page(f"<table>{rows}</table>", "")["md"] and len(html.snapshot_page(f"<table>{rows}</table>", "")["tables"][0]["rows"]) == 400
    df = spark.createDataFrame([("https://h/", SNAP), ("https://e/", None), ("https://f/", "")], "url string, body string")
    cells = html.read_tables(df).collect()
    assert {(r["table_no"], r["row_no"], r["col_no"]): r["value"] for r in cells}[0, 0, 3] == "https://h/x" and len(cells) == 7
    assert html.read_links(df).count() == 1 and html.read_index(df, WANTED).count() == 0
    assert html.read_docs_pages(df, WANTED).where("url = 'https://h/'").head()["doc"]["title"] == "Notices | Site"


def test_csv_and_settings(spark, tmp_path):
    assert files.load_yaml(tmp_path / "none.yaml", 5) == 5
    (tmp_path / "a.yaml").write_text("filters: [{types: Notes}]")
    assert files.starter_profiles(tmp_path) == {"a": {"filters": [{"types": "Notes"}]}} and files.starter_profiles(tmp_path / "no") == {}
    with pytest.raises(FileNotFoundError):
        files.site_settings(tmp_path / "none.yaml")
    assert files.site_settings(tmp_path / "a.yaml")["rescan_after_days"] == 30
    df = spark.createDataFrame([("b", 'quote " and\nline'), ("a", None), ("a", "")], "x string, y string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv(spark, str(tmp_path / "out"), ["x", "y"])
    assert [tuple(r) for r in back.collect()] == [("a", ""), ("a", ""), ("b", 'quote " and\nline')]
    assert files.read_csv(spark, str(tmp_path / "none"), ["x"]).collect() == []
    (tmp_path / "tables").mkdir()
    (tmp_path / "tables/01-x.csv").write_text('h1,\n1,"a, b"\n2\n')
    got = sorted((r["row_no"], r["col_no"], r["header"], r["value"]) for r in files.read_snapshot_tables(spark, str(tmp_path / "tables")).collect())
    assert got == [(0, 0, "h1", "1"), (0, 1, "col 2", "a, b"), (1, 0, "h1", "2")]


def test_cards(spark, tmp_path):
    def zipped(names):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in names:
                z.writestr(n, '<?xml version="1.0"?><workbook xmlns="urn:x"><sheets><sheet id="1" name="First"/><sheet name="Two &amp; more"/></sheets></workbook>')
        return out.getvalue()

    rows = [("a.zip", zipped(["x.txt", "d/y.TXT", "__MACOSX/z", "bare"])), ("b.xlsx", zipped(["xl/workbook.xml"])), ("c.zip", b"broken"), ("d.bin", b""), ("e.txt", b"v9.4 text"), ("f.xlsx", None)]
    got = {r["path"]: r for r in files.file_cards(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert got["a.zip"]["card"]["entries"] == 3 and got["a.zip"]["card"]["by_extension"] == {"(none)": 1, ".txt": 2}
    assert got["b.xlsx"]["card"]["sheets"] == ["First", "Two & more"] and "BadZipFile" in got["c.zip"]["card"]["error"] and got["d.bin"]["card"]["type"] == "bin"
    assert got["e.txt"]["features"]["versions"] == ["9.4"] and got["d.bin"]["features"]["text_sha256"] is None and got["f.xlsx"]["card"]["error"]


def test_fetching(spark, tmp_path):
    waits, answers = [], [fetch.Answer(503), fetch.Answer(429, retry_after="7"), fetch.Answer(200, body="ok")]
    patient = fetch.Patient(lambda u: answers.pop(0), sleep=waits.append)
    assert patient("u").body == "ok" and 7.0 in waits and patient.pace.delay == 1.0
    assert fetch.Patient(lambda u: 1 / 0, tries=2, sleep=lambda s: None)("u").status == 0
    assert fetch.Patient(lambda u: fetch.Answer(404), sleep=lambda s: None)("u").status == 404
    pace = fetch.Pace()
    for _ in range(10):
        pace.pushed_back()
    assert pace.delay == 15.0
    for _ in range(400):
        pace.answered()
    assert pace.delay == 0.0

    site = {"https://h/a": "A", "https://h/map": "<urlset><url><loc> https://h/a </loc></url><url><loc>https://h/b</loc></url></urlset>", "https://h/g": '<meta http-equiv="refresh" content="0; url=v2/">', "https://h/g/v2/": '<a href="/downloads/guide.pdf">x</a>'}
    urls = spark.createDataFrame([(u,) for u in [*site, "https://h/none", None, "https://h/a"]], "url string")
    store = str(tmp_path / "raw")
    raw = fetch.fetch_missing(spark, store, urls.where("url IS NOT NULL"), lambda: fetch.FixtureFetcher(site))
    assert {r["url"] for r in raw.collect()} == set(site)
    again = fetch.fetch_missing(spark, store, urls.where("url IS NOT NULL"), lambda: fetch.FixtureFetcher({}))
    assert {r["url"] for r in again.collect()} == set(site)
    assert fetch.fetch_all(urls, lambda: fetch.FixtureFetcher(site)).where("status = 404").count() == 1
    assert {r[0] for r in fetch.sitemap_urls(raw.where("url LIKE '%map'")).collect()} == {"https://h/a", "https://h/b"}
    with pytest.raises(ValueError):
        fetch.sitemap_urls(raw.limit(0))
    guides = spark.createDataFrame([("https://h/g",), ("https://h/a",)], "url string")
    assert {tuple(r) for r in fetch.resolve_guides(guides, raw).collect()} == {("https://h/g", "https://h/downloads/guide.pdf"), ("https://h/a", "https://h/a")}
