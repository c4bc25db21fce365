import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postloom.functions import text as tx
from postloom.functions import urls, vocab


@pytest.mark.parametrize(
    "raw, clean",
    [("  a   b\t", "a b"), ("", ""), (" ", ""), (None, None), ("x" * 40_000, "x" * 40_000)],
)
def test_collapse(one, raw, clean):
    assert one(tx.collapse(F.col("v")), v=raw) == clean


def test_entities_decode_in_their_order(one):
    assert one(tx.decode_entities(F.col("v")), tx.decode_entities(F.col("v"), amp_first=True), v="&amp;lt;b&gt;") == ("&lt;b>", "<b>")


def test_mojibake_then_plain_punctuation(one):
    assert one(tx.fix_mojibake(F.col("v")), v="itâ€™s â€“ “so”…") == "it's - \"so\"..."


def test_titles(one):
    assert one(tx.clean_title(F.col("v")), v='“Art Director (#12345) – ”') == "Art Director"
    assert one(tx.clean_title(F.col("v")), v="(#12345)") == "(#12345)"
    assert one(tx.strip_breadcrumb(F.col("v"), vocab.BREADCRUMB), v="Careers") == "Careers"
    assert one(tx.slug_to_name(F.col("v")), v="blue-river_works") == "Blue River Works"
    assert one(tx.split_camel(F.col("v")), v="BlueRiver") == "Blue River"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("https://X.example:443/a/?utm_source=m&b=1&REF=z#top", "https://x.example/a/?b=1"),
        ("https://x.example/", "https://x.example"),
        ("https://x.example/a?b", "https://x.example/a?b="),
        (" not a url ", "not a url"),
        (None, None),
    ],
)
def test_canonical(one, raw, want):
    assert one(urls.canonical(F.col("v")), v=raw) == want


@settings(max_examples=15, deadline=None)
@given(st.from_regex(r"https://[a-z]{1,5}\.example(/[a-z0-9]{1,4}){0,3}/?(\?[a-z]{1,2}=[a-z]{0,2}(&ref=q)?)?", fullmatch=True))
def test_canonical_is_idempotent(spark, raw):
    df = spark.createDataFrame([(raw,)], "v string").select(urls.canonical(F.col("v")).alias("v"))
    assert df.select("v", urls.canonical(F.col("v")).alias("w")).filter("v <> w").count() == 0


@pytest.mark.parametrize(
    "link, base, want",
    [
        ("/jobs/1", "https://a.example/x/y", "https://a.example/jobs/1"),
        ("see page", "https://a.example/x/y", "https://a.example/x/see%20page"),
        ("?p=2", "https://a.example/x", "https://a.example/x?p=2"),
        ("//b.example/z", "https://a.example", "https://b.example/z"),
        ("https://B.example/q r", "https://a.example", "https://B.example/q r"),
        ("", "https://a.example", None),
        ("/jobs", "nowhere", None),
        (None, "https://a.example", None),
    ],
)
def test_absolute(one, link, base, want):
    assert one(urls.absolute(F.col("v"), F.col("b")), v=link, b=base) == want


@pytest.mark.parametrize(
    "host, base",
    [("jobs.acme.co.uk", "acme.co.uk"), ("a.b.acme.com", "acme.com"), ("acme.io", "acme.io"), ("x.acme.de", "acme.de")],
)
def test_base_domain(one, host, base):
    assert one(urls.base_domain(F.col("v")), v=host) == base


@pytest.mark.parametrize(
    "url, name",
    [("https://boards.greenhouse.io/acme/jobs/1", "Acme"), ("https://acme.lever.co/x", "Acme"), ("https://careers.blueriver.example/1", "Blueriver"), ("nothing", None)],
)
def test_company_from_url(one, url, name):
    assert one(urls.company_from_url(F.col("v")), v=url) == name


def test_slugs(one):
    assert one(urls.title_from_slug(F.col("v")), v="https://a.example/jobs/123-senior_designer/45678") == "Senior Designer"
    assert one(urls.path_slug(F.col("v"), "greenhouse.io"), v="https://boards.greenhouse.io/Acme/jobs") == "acme"
    assert one(urls.path_slug(F.col("v"), "greenhouse.io"), v="https://boards.greenhouse.io/embed") is None
    assert one(urls.avatar(F.col("v")), v="A & (b)!") == "https://avatars.example/?name=A%20%26%20(b)!"


def test_page_bits_and_sections(one):
    raw = "Art Lead Remote Apply now. Back to jobs We buildApplyHere things"
    assert one(tx.without_page_bits(F.col("v"), F.col("t")), v=raw, t="Art Lead") == "now. We build Here things"
    assert one(tx.without_page_bits(F.col("v"), F.col("t")), v=None, t=None) == ""
    html = "<p><strong>Location</strong></p><p>Here</p><p><strong>About the Role</strong></p><p>x</p>"
    assert one(tx.repaired_sections(F.col("v")), v=html) == "<p><strong>Location</strong><br />Here</p><br /><p><strong>About the Role</strong><br />x</p>"
