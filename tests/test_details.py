import json

import pytest
from pyspark.sql import functions as F

from postloom.functions import boards, extract, html, posting, predicates, skills, urls
from postloom.functions import text as tx
from postloom.operators import dedup, runs
from postloom.sources import readers, sinks

PAGE = """<html><head><title>Art Director | Acme</title><meta name="description" content="Short summary"><script>var x = "<main>no</main>"</script></head>
<body><h1> Art  Director </h1><div id="content"><p>skip</p><div class="box content">Long text about the role, twice &amp; more</div></div>
<span class="job-location">Graz</span><main>tiny</main></body></html>"""


def test_selectors():
    root = html.parse_tree(PAGE)
    assert [e.text() for e in html.select(root, "#content .content")] == ["Long text about the role, twice & more"]
    assert [e.text() for e in html.select(root, "[class*='location']")] == ["Graz"] and html.select(root, "main .content") == []
    assert html.select(root, "[id='content']")[0].tag == "div" and html.select(root, ".conten") == [] and html.select(html.parse_tree(None), "main") == []
    assert html.longest_block(root) == "skipLong text about the role, twice & more" and html.longest_block(html.parse_tree("")) == ""


def test_page_fields():
    f = html.page_fields(PAGE)
    assert f["heading"] == "Art Director" and f["page_title"] == "Art Director | Acme" and f["summary"] == "Short summary" and f["detail_title"] == "Art Director" and f["detail_place"] == "Graz"
    assert html.page_fields("<h1>Careers</h1>")["detail_title"] is None and set(html.page_fields(None).values()) == {None}


def test_row_listing():
    page = "<table><tr><td><a href='/jobs/123/art'>Art Director</a></td><td>Leeds, England</td></tr></table><li><a href='/jobs/9'>Cook</a> Remote</li><a href='/jobs/x'>no</a><a href='/jobs/1'>ab</a>"
    got = html.row_jobs(page, "https://a.example/x")
    assert [(j["title"], j["url"]) for j in got] == [("Art Director", "https://a.example/jobs/123/art"), ("Cook", "https://a.example/jobs/9")]
    assert "Leeds, England" in got[0]["location"] and got[1]["location"] == "Remote" and html.row_jobs(None, "x") == []


def test_detail_of_a_page(one):
    def run(page, url, final=None):
        return one(html.detail(html.fields_column(F.col("p")), F.col("u"), F.col("f")), p=page, u=url, f=final)

    d = run(PAGE.replace("<h1> Art  Director </h1>", ""), "https://a.example/x", "https://a.example/job/7")
    assert (d.title, d.url, d.location) == ("Art Director", "https://a.example/job/7", "Graz")
    assert run(None, "https://a.example/jobs/xmlname-art-director_r123/apply").title == "art director"
    assert run("", "https://a.example/") is None


@pytest.mark.parametrize(
    "node, want",
    [
        ({"baseSalary": {"currency": "EUR", "value": {"minValue": 20, "maxValue": "30.5", "unitText": "HOUR"}}}, (20.0, 30.5, "EUR", "HOURLY")),
        ({"baseSalary": {"value": {"minValue": None, "maxValue": 9, "unitText": "fixed"}}}, (None, 9.0, "USD", "ONE_TIME")),
        ({"baseSalary": {"value": {"minValue": "a lot"}}}, (10.0, 12.0, "USD", "HOURLY")),
        ({"baseSalary": "30"}, (10.0, 12.0, "USD", "HOURLY")), ([], (10.0, 12.0, "USD", "HOURLY")),
    ],
)
def test_salary_of_node_and_text(one, node, want):
    assert tuple(one(posting.salary(F.col("n"), F.col("d")), n=json.dumps(node), d="$10 - $12 per hour")) == want


def test_node_without_json(one):
    assert one(posting.salary(F.col("n"), F.col("d")), n="{bad", d=None) is None and one(posting.node_place(F.col("n")), n=None) is None
    assert one(posting.keywords(F.col("n"), F.col("t"), F.col("d")), n="7", t=None, d=None) == []


def test_keywords_and_skills_of_node(one):
    node = json.dumps({"industry": ["Film", 3, " film "], "occupationalCategory": "Sound, Noise;x", "skills": "Adobe Photoshop, Basket  weaving"})
    got = one(posting.keywords(F.col("n"), F.lit("UX design"), F.lit("")), n=node)
    assert got[:3] == ["sound", "noise", "film"] and "ux" in got and "x" not in got
    named = one(skills.skills_column(F.lit("Cook"), F.lit(""), posting.node_terms(F.col("n"), "skills")), n=node)
    assert named[:2] == ["photoshop", "basket_weaving"]


def test_place_choice(one):
    node = json.dumps({"jobLocation": {"address": {"addressLocality": "Leeds", "addressRegion": "England", "addressCountry": "GB"}}})
    place = lambda seed, n, d: one(posting.place(F.col("s"), F.col("n"), F.col("d")), s=seed, n=n, d=d)
    assert place("Graz, Austria", node, "").city == "Graz" and place("Not specified", node, "").city == "Leeds" and place(None, node, "").country != "GB"
    assert place("", None, "Office location: Porto, Portugal").city == "Porto" and place("", None, "nothing") is None


def test_title_choice(one):
    t = lambda *v: one(posting.title(*[F.col(c) for c in "nhps"]), n=v[0], h=v[1], p=v[2], s=v[3])
    assert t("Acme Careers", "Acme jobs", "Art Director", "seed") == "Art Director" and t(None, "Art", None, "seed") == "seed" and t(" Lead ", "x", None, "seed") == "Lead"


def test_description_choice_and_policy(one):
    d = lambda n, b, m: one(posting.description(F.col("n"), F.col("b"), F.col("m")), n=n, b=b, m=m)
    long = "Words of a role " * 6
    assert d(long, None, None) == long.strip() and d("short", long.strip() + " Apply for this job now", None) == long.strip() and d(None, "x", "A summary") == "A summary"
    assert d(None, None, "Explore corporate jobs and career programs at Amazon today") == posting.PLACEHOLDER == d(None, None, None)

    def policy(text, link):
        safe, seen = html.sanitise(text), html.visible_text(text)
        r = one(posting.description_policy(F.col("t"), F.col("l"), F.col("s"), F.col("sp"), F.col("p")), t=text, l=link, s=safe, sp=html.visible_text(safe), p=seen)
        return r.kind, r.text

    assert policy(None, None) == ("placeholder", posting.PLACEHOLDER) and policy("plain  text", None) == ("as_is", "plain text")
    assert policy(f"<p onclick='x'>{long}</p>", None)[0] == "html" and policy("<p>short</p>", "https://a.example/jobs/1")[0] == "placeholder" and policy("<p>short</p>", "https://a.example/x") == ("plain", "short")
    assert policy("Caf\\u00e9 â€™ Ã\\u00a9".encode().decode("unicode_escape", "ignore") + "�", "https://a.example/jobs/1")[0] == "placeholder"


def test_page_description(one):
    raw = "Role .remix-css-1ab{color:red} text a{b:c} Enter manually end. Create a Job Alert tail"
    assert one(tx.page_description(F.col("v")), v=raw) == "Role text end." and one(tx.page_description(F.col("v")), v=None) is None
    assert one(tx.cut_at_markers(F.col("v")), v="Apply for this job first") == "Apply for this job first"


def test_tries_and_first_page(spark, one):
    got = one(boards.try_urls(F.col("u")), u="https://boards.greenhouse.io/acme/jobs/1/apply?utm_x=1")
    assert got[1] == "https://boards.greenhouse.io/acme/jobs/1/apply" and "https://boards.greenhouse.io/acme/jobs/1" in got and "https://job-boards.greenhouse.io/acme/jobs/1/apply" in got
    assert "https://jobs.lever.co/a/b?x=1" in one(boards.try_urls(F.col("u")), u="https://jobs.lever.co/a/b?lever-via=q&x=1")
    pages = spark.createDataFrame([("b", "x" * 300), ("a", "short"), ("c", "y" * 300)], "url string, html string")
    tries = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"])], "row_id int, tries array<string>")
    assert [(r.row_id, r.url) for r in boards.first_page(tries, pages).collect()] == [(1, "b")]


def test_addresses(one):
    assert one(urls.with_query(F.col("u"), {"page": 2, "ss": 1}), u="https://a.example/x?page=9&b=1&page=3#f") == "https://a.example/x?page=2&b=1&ss=1#f"
    assert one(urls.with_query(F.col("u"), {"page": 2}), u="no") is None and one(urls.retry_canonical(F.col("u")), u=" raw ") == " raw "
    assert one(urls.crawler_title(F.col("u")), u="https://a.example/") is None and one(urls.crawler_title(F.col("u")), u="https://a.example/Art%20Lead_r12-x") == "Art Lead"
    assert one(predicates.needs_browser(F.col("u")), u="https://jobs.a.example/x") and not one(predicates.needs_browser(F.col("u")), u="https://a.example/x")


def test_upload_rules(one):
    assert one(extract.upload_job_type(F.col("v")), v=" Open Call ") == "OPEN_CALL" and one(extract.upload_job_type(F.col("v")), v=None) == "FULLTIME"
    mail = one(extract.apply_method(F.col("l"), F.col("m"), F.col("b")), l="https://a", m=" x@a ", b="TRUE")
    assert tuple(mail) == ("", True, "x@a") and tuple(one(extract.apply_method(F.col("l"), F.col("m"), F.col("b")), l=None, m=None, b=None)) == ("", False, "")
    assert one(extract.positive_number(F.col("v"), 8), v="-3") == 8.0 and one(extract.positive_number(F.col("v"), 8), v="2.5") == 2.5
    assert one(predicates.drop_honoured(F.lit("GENAI_COMPANY"), F.col("t"), F.col("u")), t="Art Director", u="https://a/jobs/1") and not one(predicates.drop_honoured(F.lit("INVALID"), F.col("t"), F.col("u")), t="Art Director", u=None)
    assert one(predicates.drop_honoured(F.lit("INVALID"), F.col("t"), F.col("u")), t=None, u=None)


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "b", None), (2, "a", "x")], "id int, title string, note string")
    sinks.write_json(df, str(tmp_path / "j"), single=True)
    assert sorted(r.id for r in spark.read.json(str(tmp_path / "j")).collect()) == [1, 2]
    sinks.write_records(df, str(tmp_path / "r"), ["title", "note"], ["id"])
    assert spark.read.json(str(tmp_path / "r/enriched")).select("apiJob.title", "id").count() == 2 and spark.read.json(str(tmp_path / "r/api")).columns == ["note", "title"]
    sinks.write_scored(df, F.col("id") * -1, str(tmp_path / "s"))
    assert [r.creative_score for r in readers.read_csv(spark, str(tmp_path / "s")).collect()] == ["-2", "-1"]
    sinks.write_reviewed(df, spark.createDataFrame([(2, "PASS", "ok")], "id int, status string, notes string"), "id", str(tmp_path / "v"))
    assert {(r.id, r.Status, r.Notes) for r in readers.read_csv(spark, str(tmp_path / "v")).collect()} == {("1", "REVIEW", ""), ("2", "PASS", "ok")}
    sinks.write_cache(df, str(tmp_path / "c"))
    sinks.write_cache(spark.read.parquet(str(tmp_path / "c")).unionByName(df), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4
    assert sinks.write_lists({"keep": df}, str(tmp_path)).endswith("proposed") and spark.read.json(sinks.write_lists({"keep": df}, str(tmp_path), apply=True) + "/keep").count() == 2
    sinks.write_csv(df, str(tmp_path / "h"), header=["note", "gone", "id"])
    assert readers.read_csv(spark, str(tmp_path / "h")).columns == ["note", "gone", "id"]


def test_run_reports(spark):
    rows = spark.createDataFrame([("u", "c"), ("u", "b"), ("v", "b"), (None, "b"), (None, None), ("w", None)], "u string, c string")
    assert tuple(runs.removed_counts(rows, F.col("u"), F.col("c")).first()) == (6, 1, 2)
    assert tuple(runs.removed_counts(rows.limit(0), F.col("u"), F.col("c")).first()) == (0, 0, 0)
    scraped = spark.createDataFrame([("a", 1, 3), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("c", 1, 2)], "s string, run int, n int")
    assert {tuple(r) for r in runs.silent_sources(scraped, "s", F.col("n"), F.col("run")).collect()} == {("a", 2)}
    blank = spark.createDataFrame([(1, "p"), (2, "p"), (3, ""), (4, "")], "id int, path string")
    assert dedup.keep_first(blank, [F.col("path")], F.col("id")).count() >= 2


def test_string_lists(spark, tmp_path):
    (tmp_path / "a.json").write_text('["https://a.example", 7, null, {"x": 1}, "b", "7"]')
    (tmp_path / "bad.json").write_text('{"no": ["array"]} and more')
    assert [r.value for r in readers.read_strings(spark, str(tmp_path / "a.json")).collect()] == ["https://a.example", "b", "7"]
    assert readers.read_strings(spark, str(tmp_path / "bad.json")).count() == 0 and readers.read_strings(spark, str(tmp_path / "gone.json")).count() == 0
    with pytest.raises(Exception, match="(?i)path"):
        readers.read_strings(spark, str(tmp_path / "gone.json"), missing_ok=False).count()
