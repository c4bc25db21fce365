import json

from pyspark.sql import functions as F

from postloom.functions import html as h
from postloom.sources import readers, sinks

PAGE = """<html><head><title>Acme careers</title><meta property="og:title" content="x">
<script type="application/ld+json">{"@graph":[{"@type":"WebPage"},{"@type":["Thing","JobPosting"],"title":"Art Lead","url":"/j/1","jobLocation":{"address":{"addressLocality":"Lyon"}}}]}</script>
<script>var hidden = 1</script></head><body><h1>Open</h1><p>Text &amp; more</p>
<a href="/jobs/12">Senior Designer</a><a href="/privacy">Privacy</a><a href="https://b.example/careers">All roles</a></body></html>"""


def test_page():
    page = h.parse_page(PAGE)
    assert "hidden" not in "".join(page.text) and "Text & more" in "".join(page.text)
    assert [j["url"] for j in h.page_jobs(PAGE, "https://a.example/x")] == ["https://a.example/jobs/12", "https://b.example/careers", "https://a.example/j/1"]
    assert h.next_pages(page, "https://a.example/x") == ["https://a.example/jobs/12", "https://b.example/careers"]
    assert json.loads(h.job_posting(page))["title"] == "Art Lead"
    assert h.job_posting(h.parse_page("<script type='application/ld+json'>{broken</script>")) is None
    assert h.page_jobs(None, "https://a.example") == [] and h.visible_text(None) == ""


def test_json_jobs():
    data = {"jobs": [{"jobTitle": "Painter", "applyUrl": "/jobs/9", "location": {"city": "Porto", "country": "PT"}}], "@type": "JobPosting", "title": "Lead", "url": "https://c.example/careers/1"}
    found = h.json_jobs(data, "https://a.example")
    assert [j["title"] for j in found] == ["Lead", "Painter", "Lead"] and found[1]["location"] == "Porto, PT"
    deep = {"a": {}}
    for _ in range(30):
        deep = {"a": deep}
    assert h.json_jobs(deep, "https://a.example") == []


def test_sanitise():
    raw = '<div onclick="x"><p style="a">Hi <b>you</b></p><script>1</script><a href="javascript:1">no</a><a href="https://x.example">yes</a><table><tr><td>t</td></tr></table></div>'
    clean = h.sanitise(raw)
    assert "onclick" not in clean and "javascript" not in clean and "<td>" not in clean and 'href="https://x.example"' in clean and "<b>you</b>" in clean
    assert h.sanitise("<p> </p>") == "" and h.sanitise(None) == ""


def test_seed_paths():
    got = h.seed_paths("https://a.example/us/en/home")
    assert got[0] == "https://a.example/us/en/search-results" and len(got) == 15 and len(set(got)) == 15


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\nd', ["x", "y, z"], None), (2, " ", [], "")], "id int, t string, l array<string>, n string")
    sinks.write_csv(df, str(tmp_path / "c"), {"l": "|"})
    back = readers.read_csv(spark, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.collect()) == [("1", 'a "b", c\nd', "x|y, z", ""), ("2", "", "", "")]


def test_scrapes_nested_and_flat(spark, tmp_path):
    (tmp_path / "n.json").write_text(json.dumps([{"source": "s", "ats": "lever", "jobs_count": 2, "creative_jobs": [{"title": "A", "url": "https://a.example/1"}, {"title": "B", "url": "bad"}]}]))
    (tmp_path / "f.json").write_text(json.dumps([{"title": "C", "url": "https://c.example/1", "company": "Z"}]))
    got = sorted((r.title, r.location, r.company, r.ats) for f in ("n", "f") for r in readers.read_scrapes(spark, str(tmp_path / f"{f}.json")).collect())
    assert got == [("A", "Not specified", "unknown", "generic"), ("C", "Not specified", "Z", "generic")]


def test_strings_captures_dictionary(spark, tmp_path):
    (tmp_path / "s.json").write_text('["https://a.example", null]')
    (tmp_path / "c.jsonl").write_text('{"url": "https://a.example"}\n{broken\n')
    (tmp_path / "d.json").write_text('{"weights": {"design": 8.5, "bad": "x"}}')
    assert [r.value for r in readers.read_strings(spark, str(tmp_path / "s.json")).collect()] == ["https://a.example"]
    assert readers.read_strings(spark, str(tmp_path / "none.json")).count() == 0
    assert readers.read_captures(spark, str(tmp_path / "c.jsonl")).count() == 1
    assert [tuple(r) for r in readers.read_dictionary(spark, str(tmp_path / "d.json")).collect()] == [("design", 8.5)]


BODIES = {
    "greenhouse": ({"name": "Acme Co", "jobs": [{"title": " A ", "absolute_url": "https://g/1", "content": "&lt;p&gt;", "updated_at": "2025"}, {"title": ""}]}, ("A", "https://g/1", None, "Acme Co", "<p>", "2025")),
    "lever": ({"jobs": [{"text": "A", "hostedUrl": "u", "state": "Closed"}, {"text": "B", "hostedUrl": "u", "categories": {"location": "L"}}]}, ("B", "u", "L", None, None, None)),
    "ashby": ({"jobPostings": [{"title": "A", "jobUrl": "u", "descriptionPlain": "d"}]}, ("A", "u", None, "Blue River", "d", None)),
    "workable": ({"jobs": [{"title": "A", "shortlink": "u", "telecommuting": True}]}, ("A", "u", "Remote", "blue-river", None, None)),
    "smartrecruiters": ({"content": [{"name": "A", "ref": "7", "location": {"city": "X", "country": "Y"}}]}, ("A", "https://jobs.smartrecruiters.com/blue-river/7", "X, Y", None, None, None)),
    "workday": ({"jobPostings": [{"title": "A", "externalPath": "/job/1", "bulletFields": ["B"]}]}, ("A", "https://w.example/job/1", "B", None, None, None)),
    "amazon": ({"jobs": [{"title": "A", "job_path": "/en/1", "city": "X"}]}, ("A", "https://w.example/en/1", "X", "Amazon", None, None)),
}


def test_boards(spark):
    for system, (body, want) in BODIES.items():
        df = spark.createDataFrame([("blue-river", "https://w.example/x", json.dumps(body)), ("t", "o", "{broken"), ("t", "o", None)], "tenant string, origin string, body string")
        got = [tuple(r) for r in readers.board_jobs(df, system).select("title", "url", "location", "company", "description", "date_posted").collect()]
        assert got == [want], system


def test_snapshot_and_upsert(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    at = F.lit("2021-01-03 10:00:00").cast("timestamp")
    for _ in range(2):
        sinks.snapshot(df, str(tmp_path / "s"), at)
    hist = spark.read.parquet(str(tmp_path / "s/history"))
    assert hist.count() == 2 and hist.first().iso_week == "2020-W53"
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert sorted(tuple(r) for r in sinks.upsert(df, new, "id").collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(tuple(r) for r in sinks.upsert(df, new, "id", ["v"]).collect()) == [(1, "a"), (2, "b"), (3, "d")]
