import random

import pytest
from pyspark.sql import functions as F

from postloom.llm import pivots
from postloom.llm.pivots import Link, parse_link


@pytest.mark.parametrize(
    "link, want",
    [
        ("https://boards.talentarc.example/acme/jobs/20230165?utm_source=x#top", Link("boards.talentarc.example", "acme", "20230165")),
        ("http://WWW.boards.talentarc.example//en-us/acme/jobs/20230165/apply/", Link("boards.talentarc.example", "acme", "20230165")),
        ("https://boards.talentarc.example/embed/job_app?page=7&token=20230165&for=acme", Link("boards.talentarc.example", "acme", "20230165")),
        ("https://work.openseat.example/de/apply?tenant=t1&job=2011", Link("work.openseat.example", "t1", "2011")),
        ("https://jobs.hirelane.example/acme/20138888-podcast-producer/apply", Link("jobs.hirelane.example", "acme", "20138888")),
        ("https://apply.rolebase.example/acme/DA0BA2DC30D3", Link("apply.rolebase.example", "acme", "da0ba2dc30d3")),
        ("https://www.acme.example/careers/art-director-20240856", Link("acme.example", "", "20240856")),
        ("https://pixelboard.example/p/20000281/pattern-cutter?ref=feed", Link("pixelboard.example", "", "20000281")),
        ("", None),
        (" ", None),
        (None, None),
    ],
)
def test_links(link, want):
    assert parse_link(link) == want


COLUMNS = "ord int, host string, tenant string, code string, space string, text string"


def firsts(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as point", "1 as d", "2 as class", "3 as nth")
    return {r.ord: r.first for r in pivots.accept(df)[0].collect()}


def test_rules(spark):
    rows = [
        (1, "h", "t", "1", "s", ""),  # first posting
        (2, "h", "t", "2", "s", ""),  # same wording, other number on one host: another posting
        (3, "h", "u", "1", "s", ""),  # same number, other tenant: a third
        (4, None, None, None, "s", ""),  # no link: joins the first
        (5, "g", "", "9", "s", ""),  # other host: joins the first
        (6, "h", "t", "2", None, None),  # link alone decides
        (7, None, None, None, None, None),  # says nothing
        (8, None, None, None, None, None),
        (9, "g", "", "9", "q", "else"),  # link wins over wording
        (10, "k", "", "1", "r", "data engineer"),
        (11, None, None, None, "r", "data enginere"),  # a slip in the wording
        (12, None, None, None, "r", "data entry"),
    ]
    assert firsts(spark, rows) == {1: 1, 2: 2, 3: 3, 4: 1, 5: 1, 6: 2, 7: 7, 8: 8, 9: 1, 10: 10, 11: 10, 12: 12}


def test_one_pass_equals_batch_by_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        linked = rng.random() < 0.7
        host = rng.choice(["h", "g"])
        rows.append((i, host if linked else None, "t" if linked else None, str(rng.randrange(30)) if linked else None, f"s{rng.randrange(6)}", rng.choice(["", "night auditor", "night auditro"])))
    whole = firsts(spark, rows)
    kept, got = None, {}
    for k, cut in enumerate((0, 50, 51, 90)):
        batch = spark.createDataFrame(rows[cut : (50, 51, 90, 120)[k]], COLUMNS)
        found, kept = pivots.accept(batch, kept)
        got |= {r.ord: r.first for r in found.collect()}
        kept.save(str(tmp_path / f"k{k}"))
        kept = pivots.Accepted.load(spark, str(tmp_path / f"k{k}"))
    assert got == whole
    found, _ = pivots.accept(spark.createDataFrame([], COLUMNS), kept)
    assert found.count() == 0


def test_known_link_takes_a_later_wording(spark):
    batches = [
        [(1, "h", "t", "1", None, None), (2, "h", "t", "2", None, None)],
        [(3, "h", "t", "1", "s", ""), (4, None, None, None, "s", ""), (5, "h", "t", "2", None, None)],
        [(6, "g", "", "9", "s", ""), (7, None, None, None, "s", ""), (8, "h", "t", "1", "q", ""), (9, None, None, None, "q", ""), (10, "h", "t", "2", "r", "")],
    ]
    kept, got = None, {}
    for batch in batches:
        found, kept = pivots.accept(spark.createDataFrame(batch, COLUMNS), kept)
        got |= {r.ord: r.first for r in found.collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2, 6: 1, 7: 1, 8: 1, 9: 9, 10: 2}


def test_batches_with_late_wordings_equal_one_pass_so_far(spark):
    rng = random.Random(11)
    rows = []
    for i in range(120):
        host, k = rng.choice(["h", "g", None]), rng.randrange(25)
        says = rng.random() < 0.5
        rows.append((i, host, "t" if host else None, str(k) if host else None, f"s{k}" if says else None, "" if says else None))
    kept = None
    for start, end in ((0, 50), (50, 51), (51, 90), (90, 120)):
        found, kept = pivots.accept(spark.createDataFrame(rows[start:end], COLUMNS), kept)
        so_far = firsts(spark, rows[:end])
        assert {r.ord: r.first for r in found.collect()} == {i: so_far[i] for i in range(start, end)}


def test_near_pairs_against_brute_force(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abc ") for _ in range(rng.randrange(3, 14))) for _ in range(60)]
    points = spark.createDataFrame([(f"p{i}", f"s{i % 2}", w) for i, w in enumerate(words)], "point string, space string, text string")
    table = pivots.with_pivots(points)
    got = {tuple(r) for r in pivots.near_pairs(table, table).collect()}
    from postloom.llm.canonical import acceptable, levenshtein, radius_of

    want = {
        (f"p{i}", f"p{j}")
        for i, a in enumerate(words)
        for j, b in enumerate(words)
        if i != j and i % 2 == j % 2 and levenshtein(a, b) <= 2 and radius_of(a) and acceptable(a, b, 2) and acceptable(b, a, 2)
    }
    assert got == want


def test_append_measures_only_new_points(spark):
    old = spark.createDataFrame([("a", "s", "night auditor", "k"), ("b", "s", "lab technician", "m")], "point string, space string, text string, class string")
    new = spark.createDataFrame([("c", "s", "night auditro"), ("d", "s", "cook"), ("e", "s", "night audito")], "point string, space string, text string")
    got = {r.point: r["class"] for r in pivots.wording_classes(pivots.with_pivots(new), pivots.with_pivots(old)).collect()}
    assert got == {"c": "k", "d": "d", "e": "k"}


def test_empty(spark):
    assert firsts(spark, []) == {}
    assert pivots.near_pairs(pivots.with_pivots(spark.createDataFrame([], "point string, space string, text string")), pivots.with_pivots(spark.createDataFrame([], "point string, space string, text string"))).count() == 0
    assert spark.range(1).select(pivots.link_parts(F.lit(None).cast("string")).alias("l")).first().l.host is None


ROWS = "ord int, title string, company string, city string, job_link string"
TERMS = [(1, "title", "Graphic Designer"), (2, "title", "UX Designer"), (3, "title", "UI Designer")]


def batch(spark, rows):
    return spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' as organisation", "1 as term_id", "2 as space")


def test_a_batch_with_a_lower_sorting_spelling_finds_its_repeats(spark, tmp_path):
    terms = spark.createDataFrame(TERMS, "term_id long, term_kind string, canonical_name string")
    first = [
        (1, "Graphic Designer", "Walter Huber Design", "Graz", None), (2, "UX Designer", "Walter Huber Design", "Graz", None),
        (3, "Night Auditor", "Boda Tralute Media", "Leeds", "https://boards.talentarc.example/boda/jobs/20230165"), (4, None, None, None, None),
    ]
    found, kept = pivots.accept_postings(batch(spark, first), terms, {})
    assert {r.ord: r.first for r in found.collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    kept.save(str(tmp_path / "h"))
    kept = pivots.History.load(spark, str(tmp_path / "h"))
    second = [
        (5, "Graphic Desinger", "Walter Hber Design", "graz", None),  # a spelling that sorts lower than the stored label
        (6, "UI Designer", "Walter Hber Design", "Graz", None),  # one letter from a stored role, but another entry
        (7, "Night Auditro", "Boda Tralute Media GmbH", "Leeds", None),  # a typed role with a slip
        (8, "Cook", "", "", "http://WWW.boards.talentarc.example/boda/jobs/20230165/apply"),
    ]
    found, kept = pivots.accept_postings(batch(spark, second), terms, {}, kept)
    assert {r.ord: r.first for r in found.collect()} == {5: 1, 6: 6, 7: 3, 8: 3}
    found, kept = pivots.accept_postings(batch(spark, []), terms, {}, kept)
    assert found.count() == 0
    found, _ = pivots.accept_postings(batch(spark, [(9, "UI Designer", "W. Huber Design", "Graz", None)]), terms, {}, kept)
    assert {r.ord: r.first for r in found.collect()} == {9: 6}


def test_points_move_when_two_organisations_are_one(spark):
    terms = spark.createDataFrame(TERMS, "term_id long, term_kind string, canonical_name string")
    _, kept = pivots.accept_postings(batch(spark, [(1, "Cook", "Walter Hubermann Design", "Graz", None), (2, "Night Auditor", "Walter Hbermnn Design", "Graz", None)]), terms, {})
    found, kept = pivots.accept_postings(batch(spark, [(3, "Cook", "Walter Hbermann Design", "Graz", None), (4, "Night Auditor", "Walter Hbermann Design", "Graz", None)]), terms, {}, kept)
    assert {r.ord: r.first for r in found.collect()} == {3: 1, 4: 2}
    assert kept.accepted.points.groupBy("point").count().filter("count > 1").count() == 0


def test_a_later_batch_reads_tables_of_the_history_and_no_rows(spark, tmp_path):
    terms = spark.createDataFrame(TERMS, "term_id long, term_kind string, canonical_name string")
    rows = batch(spark, [(i, "Cook", f"Company{chr(97 + i)}{chr(97 + i)} Design", "Graz", f"https://h.example/{20000 + i}") for i in range(20)])
    rows.write.parquet(str(tmp_path / "rows"))
    _, kept = pivots.accept_postings(spark.read.parquet(str(tmp_path / "rows")), terms, {})
    kept.save(str(tmp_path / "h"))
    kept = pivots.History.load(spark, str(tmp_path / "h"))
    found, after = pivots.accept_postings(batch(spark, [(30, "Cook", "Companyaa Design", "Graz", None)]), terms, {}, kept)
    for df in (found, after.accepted.points, after.accepted.links, after.names.names, after.roles):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert str(tmp_path / "rows") not in plan and "job_link" not in plan
    assert {r.ord: r.first for r in found.collect()} == {30: 0}


def test_pivots_prune_what_ranges_leave(spark):
    rng = random.Random(5)
    roles = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(6, 26))) for _ in range(150)]
    roles += [r[:-1] + "z" for r in roles[:20]]
    points = pivots.with_pivots(spark.createDataFrame([(f"p{i}", "s", w) for i, w in enumerate(roles)], "point string, space string, text string"))
    all_pairs = len(roles) * (len(roles) - 1)
    ranged, pruned, near = pivots.range_candidates(points, points).select("a", "b").distinct().count(), pivots.pivot_candidates(points, points).count(), pivots.near_pairs(points, points).count()
    assert near >= 40 and near <= pruned < 0.6 * ranged and ranged < all_pairs / 2
