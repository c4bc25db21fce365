import json

import pytest
from pyspark.sql import functions as F

from postloom.functions import boards
from postloom.operators import curate, logos
from postloom.sources import readers


@pytest.mark.parametrize(
    "system, html, url, want",
    [
        ("greenhouse", "", "https://boards.greenhouse.io/Acme/jobs/1", "acme"),
        ("lever", "see https://jobs.lever.co/blue_river/1", "https://x.example", "blue_river"),
        ("workday", "", "https://acme.wd3.myworkdayjobs.com/en-US/site", "acme"),
        ("icims", "", "https://careers-acme.icims.com/jobs", "careers-acme"),
        ("amazon", None, "https://www.amazon.jobs/en", "amazon.jobs"),
        ("phenom", '{"refNum": "AB12"}', "https://x.example", "ab12"),
        ("workable", None, "https://x.example", None),
        ("generic", "x", "https://x.example", None),
    ],
)
def test_tenant(one, system, html, url, want):
    assert one(boards.tenant(F.col("s"), F.col("h"), F.col("u")), s=system, h=html, u=url) == want


def test_endpoints_and_links(one):
    page = 'x "https://a.example/wday/cxs/t/Ext/jobs?x=1\\u0026y=2" \'/wday/cxs/t/Own/jobs\''
    got = one(boards.endpoints(F.lit("workday"), F.col("h"), F.col("u"), F.lit("t")), h=page, u="https://acme.wd1.myworkdayjobs.com/x")
    assert got == ["https://a.example/wday/cxs/t/Ext/jobs?x=1&y=2", "https://acme.wd1.myworkdayjobs.com/wday/cxs/t/Own/jobs"]
    usual = one(boards.endpoints(F.lit("workday"), F.col("h"), F.col("u"), F.lit("t")), h="", u="https://acme.wd1.myworkdayjobs.com/x")
    assert usual == ["https://acme.wd1.myworkdayjobs.com/wday/cxs/t/External/jobs", "https://acme.wd1.myworkdayjobs.com/wday/cxs/t/Careers/jobs"]
    assert one(boards.endpoints(F.lit("icims"), F.col("h"), F.col("u"), F.lit("t")), h=None, u="https://a.icims.com/x") == ["https://a.icims.com/jobs/search?ss=1"]
    links = one(boards.raw_links(F.col("h"), F.col("u")), h='"https:\\/\\/b.example\\/jobs\\/12" /jobs/4567 https://b.example/about https://b.example/job/senior', u="https://a.example/x")
    assert links == ["https://b.example/jobs/12", "https://b.example/job/senior", "https://a.example/jobs/4567"]


def test_try_urls(one):
    assert one(boards.try_urls(F.col("u")), u="https://a.example/j/1/apply?x=1&ref=2") == ["https://a.example/j/1/apply?x=1&ref=2", "https://a.example/j/1/apply?x=1", "https://a.example/j/1/apply"]


@pytest.mark.parametrize(
    "url, root, ok",
    [
        ("https://a.example/x", "https://a.example", True),
        ("https://jobs.a.example/x", "https://www.a.example", True),
        ("https://blog.a.example/x", "https://a.example", False),
        ("https://boards.greenhouse.io/x", "https://a.example", True),
        ("https://b.example", "https://a.example", False),
        (None, "https://a.example", False),
    ],
)
def test_crawl_allowed(one, url, root, ok):
    assert one(boards.crawl_allowed(F.col("u"), F.col("r")), u=url, r=root) is ok


def test_crawl(spark):
    pages = spark.createDataFrame([("https://a.example/", ["https://a.example/jobs", "https://evil.example/"]), ("https://a.example/jobs", ["https://a.example/", "https://jobs.a.example/1"]), ("https://jobs.a.example/1", [])], "url string, links array<string>")
    got = {(r.url, r.depth) for r in boards.crawl(pages, spark.createDataFrame([("https://a.example",)], "root string")).collect()}
    assert got == {("https://a.example", 0), ("https://a.example/jobs", 1), ("https://jobs.a.example/1", 2)}
    assert boards.crawl(pages, spark.createDataFrame([], "root string")).count() == 0


def test_tenant_of_source(spark):
    jobs = spark.createDataFrame([(1, "s", "https://x.example"), (2, "s", "https://jobs.lever.co/b/1"), (3, "s", "https://jobs.lever.co/c/1"), (4, "t", None)], "id int, source_url string, url string")
    assert [tuple(r) for r in boards.tenant_of_source(jobs, "lever", F.col("id")).collect()] == [("s", "b")]


def test_logos(spark):
    rows = spark.createDataFrame([(1, "Acme Inc.", ""), (2, "Acme Inc.", "https://careers.acme.example/x"), (3, "Board Co", "https://boards.greenhouse.io/b"), (4, "Set", None), (5, "None", None), (6, " ", None), (7, None, None)], "row_id int, company string, company_website string")
    overrides = spark.createDataFrame([("set", "set.example"), ("none", "")], "company_key string, domain string")
    got = {r.company_key: list(r.domains) for r in logos.candidates(rows, overrides).collect()}
    assert got == {"acme inc.": ["acme.example", "acme.com", "acme.io", "acme.co"], "board co": ["boardco.com", "boardco.io", "boardco.co"], "set": ["set.example"], "none": []}
    cache = spark.createDataFrame([("acme inc.", None, None, "unresolved")], "company_key string, domain_host string, logo_url string, logo_source string")
    out = logos.resolve(logos.candidates(rows, overrides), cache, lambda d: (d[0], f"https://{d[0]}/l.png") if d else None)
    assert {r.company_key: r.logo_source for r in out.collect()} == {"acme inc.": "unresolved", "board co": "resolved", "set": "resolved", "none": "unresolved"}


def test_seeds_and_tables(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(["https://f.example", "no", None]))
    path = str(tmp_path / "s.json")
    first = lambda **k: [r.url for r in readers.seeds(spark, **k).collect()]
    assert first(arguments=["https://a.example", "x"], path=path) == ["https://a.example"]
    assert first(environment='["https://e.example"]', path=path) == ["https://e.example"]
    assert first(environment="broken", path=path) == ["https://f.example"] and first() == []
    text = "| # | Title |\n|---|---|\n| 1 | Designer | Acme | 50k |\n| 2 | Artist | B | - |\n\n| 1 | https://a.example/1 |\n"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string")
    assert sorted((r.nr, r.cells[1], r.link) for r in readers.review_tables(docs).collect()) == [(1, "Designer", "https://a.example/1"), (2, "Artist", None)]


def test_append_and_discovered(spark):
    master = spark.createDataFrame([("a", 1), ("b", 2)], "url string, o long")
    new = spark.createDataFrame([("c", 5), ("b", 1), ("c", 4), ("d", 2)], "url string, o long")
    assert [r.url for r in curate.append_new(master, new, "url", "o").orderBy("o").collect()] == ["a", "b", "d", "c"]
    node = {"@graph": [{"@type": "JobPosting", "hiringOrganization": {"sameAs": ["https://www.new.example/x", "old.example", 3]}}, {"@type": "Thing", "hiringOrganization": {"sameAs": "https://no.example"}}]}
    page = f"<script type='application/ld+json'>{json.dumps(node)}</script><script type='application/ld+json'>broken</script>"
    pages = spark.createDataFrame([(page,), (None,)], "html string")
    known = spark.createDataFrame([("https://www.old.example/careers",)], "url string")
    listed = spark.createDataFrame([("listed.example",)], "host string")
    assert [r.host for r in curate.discovered(pages, known, listed).collect()] == ["listed.example", "new.example"]
