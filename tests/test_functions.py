import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cards, dates, hashing, links, rules, text, urls, versions


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).head()[0]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (text.clean, " A​®™ \xa0 b ", "A b"),
        (text.clean, None, ""),
        (text.squeeze, " A​®™ \xa0 b ", "Ab"),
        (text.slug, "Käse & Brot — 2", "k-se-brot-2"),
        (text.slug, "...", "untitled"),
        (text.safe_name, ' .a/b:c?  "d". ', "a b c d"),
        (text.safe_name, None, "untitled"),
        (text.words, "  a b\xa0c\n", 3),
        (text.words, " \xa0", 0),
        (text.escape_bars, "a|b", "a\\|b"),
        (urls.listing_key, "HTTPS://Docs.X.example/A/b//#z", "https://docs.x.example/A/b"),
        (urls.listing_key, "https://h", "https://h"),
        (urls.listing_key, None, ""),
        (urls.canonical, "https://h/a#b", "https://h/a/"),
        (urls.canonical, "", ""),
        (urls.host, "https://H_x.example:8080/a", "h_x.example:8080"),
        (urls.path, "https://h/a b|c?x#y", "/a b|c"),
        (urls.extension, "https://h/a%2Epdf", ".pdf"),
        (urls.extension, "https://h/v9.4 User Guide", ""),
        (urls.area_of, "https://h/support/training/x", "support/training"),
        (urls.area_of, "https://h/products/x", "products"),
        (urls.decoded, "a+b%20c%zz", "a+b%20c%zz"),
        (urls.decoded, "a+b%20c", "a+b c"),
        (dates.month_iso, "printed Sept. 2019, Oct 2020", "2019-09"),
        (dates.month_iso, "Q3 2019", ""),
        (dates.stated_date, "All is as of March 3, 2021 or later", "March 3, 2021"),
        (dates.stated_date, "nothing", None),
        (links.portal_revision, "https://h/ug_revacdev/", "AC"),
        (links.portal_revision, "https://h/ug/", ""),
        (links.refresh_target, '<META http-equiv="Refresh" content="0;url=x_revXXdev/index.html">', "x_revXXdev/index.html"),
        (links.refresh_target, "<meta content='5; URL=\"../b c/\"' http-equiv=refresh>", "../b c/"),
        (links.refresh_target, "refresh <meta name=refresh content='0;url=x'>", ""),
        (links.refresh_target, None, ""),
        (hashing.sniff, b"%PDF-1.7", ".pdf"),
        (hashing.sniff, b"PK\x03\x04..", ".zip"),
        (hashing.sniff, b"\x1f\x8b..", ".gz"),
        (hashing.sniff, b"", ""),
        (hashing.text_sha256, "", None),
        (hashing.content_extension, "Application/PDF; charset=x", ".pdf"),
    ],
)
def test_scalars(spark, f, given, want):
    assert one(spark, f(F.lit(given))) == want


def test_page_hash_is_blind_to_its_header(spark):
    h = lambda s: one(spark, hashing.page_hash(F.lit(s)))
    assert h("<!-- Generated by a -->\nbody\r\nrow") == h("<!-- Generated by b -->\nbody\nrow") == h("body\nrow") != h("body\nrow\nmore")


def test_version_keys(spark):
    k = lambda s: one(spark, versions.version_key(F.lit(s)))
    assert k("26.02.13") == [26, 2, 13] and k("v9.4.x") == [9, 4] and k("Latest") is None and k(None) is None
    c = lambda a, b: one(spark, versions.compare(versions.version_key(F.lit(a)), versions.version_key(F.lit(b))))
    assert (c("9.4", "9.4.0"), c("9.10", "9.9"), c("9", "9.0.1"), c("x", "1")) == (0, 1, -1, None)
    assert one(spark, versions.listed(versions.version_key(F.lit("9.4"))) < versions.listed(versions.version_key(F.lit("9.4.0"))))
    assert one(spark, versions.listed(versions.version_key(F.lit("x")))) == [-1]


HOSTS = {"own_hosts": ["vendor.example"], "portal_hosts": ["docs.vendor.example"], "hub_hosts": ["hubstore"]}


@pytest.mark.parametrize(
    ("url", "title", "kind"),
    [
        ("https://youtu.be/x.pdf", "", "video"),
        ("https://a.hubstore.example/x.pdf", "", "hub"),
        ("https://docs.vendor.example/x.PDF", "", "pdf"),
        ("https://docs.vendor.example/x.tgz", "", "archive"),
        ("https://any.example/x.csv", "", "sheet"),
        ("https://developer.other.example/x", "", "api"),
        ("https://docs.vendor.example/x", "REST API Guide", "api"),
        ("https://docs.vendor.example/guide/", "", "portal"),
        ("https://docs.vendor.example/x.bin", "", "other"),
        ("https://www.vendor.example/x", None, "page"),
        ("https://else.example/x", "", "external"),
        (None, None, "external"),
    ],
)
def test_link_kinds(spark, url, title, kind):
    assert one(spark, links.link_kind(F.lit(url), F.lit(title), **HOSTS)) == kind
    assert tuple(one(spark, links.format_via(F.lit(kind)))) == links.FORMAT_VIA[kind]


def test_joined_and_quoted(spark):
    df = spark.createDataFrame([("https://h/a/b", "../c d.pdf#x"), ("https://h/a/", None), (None, "http://[bad")], "b string, h string")
    got = df.select(links.join_url("b", "h").alias("j"), links.quote_url("h").alias("q")).collect()
    assert [tuple(r) for r in got] == [("https://h/c d.pdf#x", "../c%20d.pdf"), (None, None), ("http://[bad", "http://[bad")]


TYPES = {
    "types": {"Notes": {"value": "high"}, "Guide": {"value": "low"}, "Video": "low"},
    "by_format": {"video": "Video", "collection": "Set"},
    "rules": [{"Notes": "release notes"}, {"Guide": "guide|notes"}],
    "translation": "deutsch",
    "quick_reference": "quick ref",
}


@pytest.mark.parametrize(
    ("title", "fmt", "kind"),
    [("Any Release Notes Guide", "pdf", "Notes"), ("User GUIDE", "pdf", "Guide"), ("Release Notes", "video", "Video"), ("My Document Collection notes", "zip", "Set"), ("X", "pdf", "Other"), (None, None, "Other")],
)
def test_document_types(spark, title, fmt, kind):
    r = rules.type_rules(TYPES)
    assert one(spark, r.document_type(F.lit(title), F.lit(fmt))) == kind
    assert one(spark, r.value_class(F.lit("Notes"))) == "high"
    assert one(spark, r.is_translation(F.lit("Guide (Deutsch)"))) and not one(spark, r.is_quick_reference(F.lit(title)))


def test_products_and_prefixes(spark):
    p = rules.product_rules({"Hardware": {"Twins": "A[0-9]+ Twin", "Plain": ["A[0-9]+", "B.*"]}, "Software": None})
    place = lambda e: one(spark, p.place(F.lit(e)))
    assert tuple(place("A1 Twin")) == ("Hardware", "Twins") and tuple(place("A1")) == ("Hardware", "Plain") and place("xA1") is None
    said = lambda s: one(spark, rules.longest_prefix(F.lit(s), {"Net": "N", "Net OS": "O"}))
    assert tuple(said("Net OS 9.4 ")) == ("O", "9.4") and tuple(said("Net 8")) == ("N", "8") and said("Network 1") is None and said(None) is None


def test_text_cards(spark):
    body = "Rev. AB  Published: March 2021 Part 9012345-01. See v9.4, 2.1, release 3.2, 9.4.1.0 and V9.4."
    card = one(spark, cards.text_card(F.lit(body)))
    assert (card["part_number"], card["revision"], card["published"], card["versions"]) == ("9012345-01", "AB", "March 2021", ["9.4", "3.2", "9.4.1.0"])
    paged = one(spark, cards.page_card(F.array(F.lit("one v1.2"), F.lit(None), F.lit("x"), F.lit("Rev AB"), F.lit("Published May 2020 v9.9.9"))))
    assert (paged["pages"], paged["words"], paged["revision"], paged["published"], paged["versions"]) == (5, 9, "AB", None, ["1.2"])
    assert one(spark, cards.page_card(F.lit(None).cast("array<string>")))["pages"] == 0
    empty = one(spark, cards.text_card(F.lit(None).cast("string")))
    assert empty["words"] == 0 and empty["versions"] == [] and empty["text_sha256"] is None
    assert one(spark, cards.extension_counts(F.array(*[F.lit(x) for x in ("a.PDF", "b/c.pdf", "d", ".hidden")]))) == {"(none)": 2, ".pdf": 2}
