import json

from ledgerloom import cli
from ledgerloom.operators import runs
from ledgerloom.operators.ledger import VersionStore
from ledgerloom.operators.profiles import load_profile
from ledgerloom.sources.fetch import Answer, FixtureFetcher
from tests.test_scan import ARCHIVE, HOSTS, RAW, D

PAGES = {u: b for u, s, b in RAW + ARCHIVE if s == 200} | {f"{D}/support/release-notes/": ARCHIVE[0][2], f"{D}/entry/a/2/": RAW[2][2], f"{D}/entry/a/1/": RAW[3][2]}
KEYS = {"listings": ["url", "page"], "release-notes": ["archive_page", "url"]}
SHOWN = {"listings": ["title", "latest"], "release-notes": ["title"]}
DOCS = "pos long, url string, title string, entry string, ents array<string>, type string, release string, format string, latest boolean, is_translation boolean"


def test_crawl_and_refresh(spark, tmp_path, capsys):
    root, pages = str(tmp_path / "store"), str(tmp_path / "pages")
    (tmp_path / "store").mkdir()
    words = ["crawl", root, pages, "--site", "docs-site", "--index-url", f"{D}/", "--wanted", "/entry/", "--hosts", json.dumps(HOSTS), "--today"]
    site = PAGES | {f"{D}/entry/b/": "<title>B</title>", f"{D}/release-notes/product/lost/": "<main></main>", f"{D}/release-notes/product/gone/": "<main></main>"}
    try:
        cli.main([*words, "2025-01-01"], lambda: FixtureFetcher(PAGES))
        raise AssertionError("a page in four was lost")
    except cli.guard.__globals__["GuardError"] as e:
        assert "failed" in str(e)
    asked = spark.sparkContext.accumulator(0)

    class Counting(FixtureFetcher):
        def __call__(self, url: str) -> Answer:
            asked.add(1)
            return super().__call__(url)

    assert cli.main([*words, "2025-01-01"], lambda: Counting(site)) == 0
    assert 3 <= asked.value < len(site)  # what the first crawl had fetched was not asked for again
    store = VersionStore(spark, root)
    notes = {(r["archive_page"], r["title"]) for r in store.read("release-notes").collect()}
    assert notes == {("sw", "N1"), ("sw", "N2"), ("ap", "N1 of P")} and store.read("listings").count() == 2
    steps = cli.read_meta(root)["timing"]["steps"]
    assert [s["step"] for s in steps] == ["index", "entries", "releases", "archive"] and all({"pages", "failed", "retried", "throttled", "seconds"} <= s.keys() for s in steps)
    assert not (tmp_path / "pages").exists()
    site[f"{D}/entry/a/"] = site[f"{D}/entry/a/"].replace("<h3>Guide</h3>", "<h3>New guide</h3>")
    assert cli.main([*words, "2025-02-01"], lambda: FixtureFetcher(site)) == 0
    (tmp_path / "README.md").write_text("a\n<!-- last-scan:begin -->\nold\n<!-- last-scan:end -->\nb\n")
    docs = spark.createDataFrame([(0, "u", "T", "A", [], "Guide", "1", "pdf", True, False)], DOCS).selectExpr("*", "'2020-01' AS month", "'direct' AS via")
    docs.write.parquet(str(tmp_path / "docs"))
    args = ["refresh", root, str(tmp_path / "out"), "--keys", json.dumps(KEYS), "--shown", json.dumps(SHOWN), "--readme", str(tmp_path / "README.md"), "--documents", str(tmp_path / "docs")]
    assert cli.main(args) == 0
    assert "listings: 1 changed" in (tmp_path / "out/report.md").read_text() and "docs-site: scanned 2025-02-01" in (tmp_path / "README.md").read_text()
    assert spark.read.json(str(tmp_path / "out/explorer")).count() == 1
    capsys.readouterr()


def test_update_and_remote_check(spark, tmp_path, capsys):
    library, docs = tmp_path / "lib", str(tmp_path / "docs")
    rows = [(i, f"https://h/{n}", t, "A", [], "Guide", "1", "pdf", True, False) for i, (n, t) in enumerate([("a.pdf", "First"), ("b", "Second"), ("c.pdf", "Lost")])]
    spark.createDataFrame(rows, DOCS).write.parquet(docs)
    (tmp_path / "p.yaml").write_text("filters:\n- entries: [A]\n  releases: all\nfolders: '{entry}'\n")
    files = {"https://h/a.pdf": runs.Reply(200, b"%PDF one", "application/pdf", "e1", "", 8), "https://h/b": runs.Reply(200, b"PK\x03\x04 two", "", "", "Mon", 8)}

    class Server:
        def __init__(self, held: dict) -> None:
            self.held = held

        def __call__(self, url: str, head: bool = False) -> runs.Reply:
            r = self.held.get(url, runs.Reply(404))
            return r._replace(content=b"") if head else r

    words = ["update", docs, str(tmp_path / "p.yaml"), str(library)]
    assert cli.main([*words, "--dry-run"], server=lambda: Server({})) == 0 and capsys.readouterr().out.count("new: A/") == 3
    assert cli.main([*words, "--today", "d1"], server=lambda: Server(files)) == 1  # one failed
    assert capsys.readouterr().out.strip().split("\n")[-1] == "1 failed, 2 new"
    held = {p.relative_to(library).as_posix() for p in library.rglob("*") if p.is_file() and runs.OWN not in p.parts}
    assert held == {"A/First.pdf", "A/Second.zip"}
    assert cli.main([*words, "--today", "d2"], server=lambda: Server(files)) == 1
    assert capsys.readouterr().out.strip().split("\n")[-1] == "1 failed, 2 same"
    lock = spark.read.schema(runs.LOCK).json(f"{library}/{runs.OWN}/lock")
    assert {(r["url"], r["fetched"], r["etag"]) for r in lock.collect()} == {("https://h/a.pdf", "d1", "e1"), ("https://h/b", "d1", "")}
    newer = files | {"https://h/a.pdf": runs.Reply(200, b"%PDF 1.2.3", "application/pdf", "e2", "", 10), "https://h/c.pdf": runs.Reply(200, b"x", "text/plain", "", "", 1)}
    check = ["check", str(library), f"{library}/{runs.OWN}/lock", "--remote"]
    assert cli.main(check, server=lambda: Server(newer)) == 1 and "upstream: https://h/a.pdf" in capsys.readouterr().out
    assert cli.main(check, server=lambda: Server({})) == 0 and capsys.readouterr().out.count("unreachable") == 2
    spark.createDataFrame([rows[0], rows[2]], DOCS).write.mode("overwrite").parquet(docs)
    assert cli.main([*words, "--today", "d3"], server=lambda: Server(newer)) == 0
    assert capsys.readouterr().out.strip().split("\n")[-1] == "1 dropped, 1 new, 1 updated"
    held = {p.relative_to(library).as_posix() for p in library.rglob("*") if p.is_file() and runs.OWN not in p.parts}
    assert (library / "A/First.pdf").read_bytes() == b"%PDF 1.2.3" and "A/Second.zip" not in held and len(held) == 2
    assert (library / runs.OWN / "archive/A/First (d3).pdf").read_bytes() == b"%PDF one"
    lock = {r["url"]: r for r in spark.read.schema(runs.LOCK).json(f"{library}/{runs.OWN}/lock").collect()}
    assert len(lock["https://h/a.pdf"]["earlier"]) == 1 and set(lock) == {"https://h/a.pdf", "https://h/c.pdf"}
    assert spark.read.json(f"{library}/{runs.OWN}/history/d3").count() == 3 and spark.read.json(f"{library}/{runs.OWN}/details").count() == 2
    kept = runs.planned(spark.read.parquet(docs).limit(0), load_profile({"filters": []}), spark.createDataFrame([("u", "p")], "url string, path string"), ["pos"])
    assert [tuple(r) for r in kept.collect()] == [("u", "p", "dropped")]
