import pytest
from pyspark.sql import functions as F

from postloom.functions import extract, predicates, scoring, skills, vocab


@pytest.mark.parametrize(
    "title, loose, strict",
    [("Senior Designer", True, True), ("Tax Auditor", False, False), ("Legal Counsel, Brand Design", True, True), ("éux lead", True, True), ("Redesigned", False, False), ("", False, False), (None, False, False)],
)
def test_title_filters(one, title, loose, strict):
    assert one(predicates.title_loose(F.col("v")), predicates.title_strict(F.col("v")), v=title) == (loose, strict)


@pytest.mark.parametrize(
    "title, url, strict, loose",
    [
        ("Designer", "https://a.example/jobs/12", True, True),
        ("Designer", "https://a.example/careers", False, False),
        ("Home", "https://a.example/jobs/12", False, False),
        ("Zookeeper", "https://jobs.lever.co/acme/abc", True, False),
        ("Designer", "https://a.example/team/x", False, False),
        ("Designer", "ftp://a.example/jobs/1", True, False),
        ("Designer", "no url", False, False),
        (None, None, False, False),
    ],
)
def test_posting(one, title, url, strict, loose):
    assert one(predicates.posting_strict(F.col("t"), F.col("u")), predicates.posting_loose(F.col("t"), F.col("u")), t=title, u=url) == (strict, loose)


def test_rescue(one):
    out = one(predicates.rescue(F.col("t"), F.col("s"), F.col("d"), F.col("u")), t="Welcome", s="Brand Designer", d="short", u="https://x.example/z")
    assert (out.keep, out.title, out.placeholder) == (True, "Brand Designer", True)
    assert not one(predicates.rescue(F.col("t"), F.col("t"), F.col("d"), F.col("u")), t="Driver", d="x" * 80, u="https://x.example/z").keep


def test_scores(one):
    weights = [("design", 8.5), ("art", 2.5), ("ui/ux", 6.5), ("c++", 4.4)]
    up = scoring.dictionary_score(F.col("v"), weights)
    even = scoring.dictionary_score(F.col("v"), weights, half_even=True)
    assert one(up, even, v="Design lead") == (9, 8)
    assert one(up, even, v="art of ui/ux") == (7, 6)
    assert one(up, even, v="nothing") == (3, 3)
    assert one(up, even, v=None) == (3, 3)
    assert one(scoring.tier_score(F.col("v")), v="Senior Illustrations Lead") == 10
    assert one(scoring.tier_score(F.col("v")), v="gardener") == vocab.NEUTRAL_SCORE


@pytest.mark.parametrize("w, up, even", [(8.5, 9, 8), (2.18, 2, 2), (2.5, 3, 2), (11.0, 10, 10), (0.2, 2, 2)])
def test_clamp(w, up, even):
    assert (scoring.clamp(w, False), scoring.clamp(w, True)) == (up, even)


@pytest.mark.parametrize(
    "raw, city, state, country",
    [
        ("Austin, TX", "Austin", "TX", "United States"),
        ("Montréal, QC", "Montréal", "QC", "Canada"),
        ("Denver CO", "Denver", "CO", "United States"),
        ("Nantes, France", "Nantes", "", "France"),
        ("Berlin, DE", "Berlin", "DE", "United States"),
        ("Berlin, Land, DE", "Berlin", "Land", "Germany"),
        ("Remote - USA", "Remote", "USA", "United States"),
        ("Remote", "Remote", "", ""),
        ("Brno; Bandung", "Brno", "", ""),
        ("Osaka", "Osaka", "", ""),
    ],
)
def test_location(one, raw, city, state, country):
    out = one(extract.location(F.col("v")), v=raw)
    assert (out.city, out.state, out.country) == (city, state, country)


@pytest.mark.parametrize("raw", ["Not specified", "n/a", "", None, "what you'll do here", "x" * 200])
def test_no_location(one, raw):
    assert one(extract.location(F.col("v")), v=raw) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("Pay $45k - $60k per year", (45000.0, 60000.0, "USD", "ANNUAL")),
        ("€25-30 / hour", (25.0, 30.0, "EUR", "HOURLY")),
        ("£400 to £500", (400.0, 500.0, "GBP", "DAILY")),
    ],
)
def test_salary(one, text, want):
    assert tuple(one(extract.salary(F.col("v")), v=text)) == want


def test_no_salary(one):
    assert one(extract.salary(F.col("v")), v="$50,000 flat") is None


def test_dates_mail_and_counts(one):
    v = "Apply by March 5, 2026. 3 openings. Ask info@a.example or Jo.Doe@a.example; mailto:hr@b.example"
    assert one(extract.deadline(F.col("v")), extract.positions(F.col("v")), extract.email(F.col("v")), v=v) == ("2026-03-05", 3, "hr@b.example")
    assert [one(extract.day(F.col("v")), v=x) for x in ("2025-06-13T07:54:21Z", "March 2025", "3 days ago", None)] == ["2025-06-13", "2025-03-01", None, None]


def test_types(one):
    assert one(extract.job_type(F.col("a"), F.col("b")), extract.work_type(F.col("a"), F.col("b"), F.lit("")), a="Intern", b="hybrid team") == ("GIG", "HYBRID")
    assert [one(extract.job_type_value(F.col("v")), v=x) for x in ("Full-time", "Contract", "odd", "freelance")] == ["FULLTIME", "GIG", "FULLTIME", "FREELANCE"]
    assert [one(extract.work_type_value(F.col("v")), v=x) for x in ("On-site", "work from home", "", None)] == ["ONSITE", "REMOTE", "", ""]


def test_systems_in_order(one):
    assert one(extract.system(F.col("v")), v="see boards.greenhouse.io and jobs.lever.co") == "greenhouse"
    assert one(extract.system(F.col("v")), v="nothing here") == "generic"


def test_skills():
    assert skills.canonical("Adobe Photoshop") == "photoshop"
    assert skills.canonical("design") == "indesign"
    assert skills.canonical("the") == ""
    assert skills.listed_skills("Motion Designer", "Experience with Figma, Blender or puppetry; more.")[:3] == ["figma", "blender", "puppetry"]
    assert skills.listed_skills(None, None) == []
    # the index finds what a look at every entry finds
    for value in ("design", "adobe photoshop", "ui", "blend", "x", "motion design", "c", "after effects and more"):
        want = next((n for n, words in vocab.SKILL_TAXONOMY.items() if any(w in value or value in w for w in words)), None)
        assert skills.TAXONOMY.first(value) == want


def test_skills_column(one):
    got = one(skills.skills_column(F.col("t"), F.col("d")), t="Motion Designer", d="Experience with Figma, Blender or puppetry; more. the way of the world is_a_b_c_d")
    assert got[:2] == ["figma", "blender"] and "puppetry" in got and len(got) == len(set(got))
    assert one(skills.skills_column(F.col("t"), F.col("d")), t=None, d=None) == []


def test_edges_of_words(spark):
    # each edge becomes the look-around that its neighbour needs; the result is that of the general form
    general = f"(?:{vocab.OPEN}(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_]){vocab.CLOSE})"
    texts = ["ui designer", "uixdesigner", "séo", "art  director", "3d artist", "ux/ui", "", "hr", "ahr", "hré", "ux", "motion graphics lead"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for spec in vocab.TIERS.values():
        patterns = vocab.tier_patterns(spec)
        slow = "|".join(f"(?:{p})" for p in (x.replace(r"\b", general) for x in patterns))
        assert df.filter(F.col("t").rlike(slow) != F.col("t").rlike(vocab.java_any(patterns))).count() == 0


def test_large_dictionaries_are_joined(spark, monkeypatch):
    table = spark.createDataFrame([("UX", 9.5), ("ux lead", 4.0), ("c++", 8.0), ("art", 2.5), ("bad", None), (None, 3.0)], "keyword string, weight double")
    df = spark.createDataFrame([(1, "UX lead"), (2, "c++ dev"), (3, "smart"), (4, None), (5, "art, ux")], "id int, title string")
    for even in (False, True):
        want = {r.id: r.score for r in scoring.with_dictionary_score(df, F.col("title"), table, "id", even).collect()}
        monkeypatch.setattr(scoring, "PATTERN_KEYWORDS", 2)
        got = {r.id: r.score for r in scoring.with_dictionary_score(df, F.col("title"), table, "id", even).collect()}
        monkeypatch.undo()
        assert got == want
