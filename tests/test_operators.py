import pandas as pd
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postloom.operators import curate, dedup, enrich, layout, quality


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_keep_best_ties_nulls_and_exempt(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 2), (3, "a", 2), (4, None, 1), (5, None, 0), (6, "", 9)], "id int, k string, p int").withColumn("o", F.lit("clash"))
    best = dedup.keep_best(df, [F.col("k")], [-F.col("p"), F.col("id")])
    assert rows(best, "id") == [(2,), (4,), (6,)]
    assert best.columns == df.columns
    assert rows(dedup.keep_first(df, [F.col("k")], F.col("id"), exempt=F.col("k").isNull()), "id") == [(1,), (4,), (5,), (6,)]
    assert dedup.keep_first(df.limit(0), [F.col("k")], F.col("id")).count() == 0


def test_prune_and_promote(spark):
    data = [(1, "s1", 3, [("Designer",)]), (2, "s1", 2, [("Clerk",)]), (3, "s2", 0, []), (4, "s3", 1, [("Designer",)])]
    results = spark.createDataFrame(data, "scrape_id int, source_url string, jobs_count int, creative_jobs array<struct<title:string>>")
    score = F.when(F.col("job.title") == "Designer", 9).otherwise(3)
    stats = curate.source_stats(results, score, 6, F.col("scrape_id"))
    listed = spark.createDataFrame([("s1",), ("s2",), ("s3",), ("s4",)], "source_url string")
    assert rows(curate.prune(listed, stats), "source_url", "bucket") == [("s1", "low"), ("s2", "zero"), ("s3", "keep"), ("s4", "not_in_scrape")]
    assert rows(curate.promote(stats, listed.filter("source_url = 's9'")), "source_url", "decision") == [("s1", "rejected"), ("s2", "rejected"), ("s3", "promoted")]


def test_tag_weights(spark):
    tags = spark.createDataFrame([(u, "a") for u in range(6)] + [(0, "a"), (1, "b"), (None, "a")], "u int, t string")
    assert rows(curate.tag_weights(tags, "u", "t", 5), "tag", "users", "weight") == [("a", 6, 10.0)]


def test_audit_and_missing(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q")], "id int, f string, g string")
    b = spark.createDataFrame([(1, "x", None), (3, "y", "q")], "id int, f string, g string")
    got = rows(quality.field_audit(a, b, "id", ["f", "g"]), "id", "field", "status")
    assert got == [(1, "f", "MATCH"), (1, "g", "MATCH"), (2, "f", "MISSING_RIGHT"), (2, "g", "MISSING_RIGHT"), (3, "f", "MISSING_LEFT"), (3, "g", "MISSING_LEFT")]
    assert tuple(quality.missing_counts(a, ["f", "g"]).first()) == (2, 0, 1)


def test_positions_and_batches(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 37) % 1000)
    got = layout.batches(df, ["k"], 7).select("k", "position", "batch").collect()
    assert all(r.k == r.position and r.batch == r.position // 7 for r in got) and len(got) == 1000


def brute_spread(sizes, blanks):
    total = sum(sizes) + blanks
    taken, out = set(), []
    for n in sizes:
        own = []
        for i in range(n):
            pos = int(i * (total / n) + total / n / 2) % total
            while pos in taken:
                pos = (pos + 1) % total
            taken.add(pos)
            own.append(pos)
        out.append(own)
    out.append([p for p in range(total) if p not in taken])
    return out


@given(st.lists(st.integers(1, 12), max_size=8), st.integers(0, 6))
def test_spread_slots(sizes, blanks):
    sizes = sorted(sizes, reverse=True)
    assert layout.spread_slots(sizes, blanks) == brute_spread(sizes, blanks)


def test_spread_is_a_permutation(spark):
    df = spark.createDataFrame([(i, ["A", "a ", "b", None, ""][i % 5]) for i in range(40)], "id int, company string")
    out = layout.spread(df, "company", "id")
    assert sorted(r.slot for r in out.collect()) == list(range(40))
    keys = layout.spread_key(df, F.col("company"), ["id"], slices=3)
    a = sorted(r.spread_key for r in keys.collect() if (r.company or "").strip().lower() == "a")
    assert a == [(i + 0.5) / 16 for i in range(16)]
    assert keys.filter("spread_key is null").count() == 16


ROW = dict(title="T", description="d" * 40, job_type="odd", work_type="Remote", city="Lyon", state="", country="France", salary_min="0", salary_max="5", salary_currency="EUR", salary_period="", company="C")


def merged(spark, reply, **change):
    row = ROW | change
    df = spark.createDataFrame([tuple(row.values()) + (reply,)], ", ".join(f"{k} string" for k in [*row, "raw"]))
    return enrich.merge(df.withColumn("reply", enrich.parse_reply(F.col("raw"))), "reply").first()


def test_merge(spark):
    out = merged(spark, 'Sure: ```json {"title": "New", "city": "remote", "jobType": "CONTRACT"} ```')
    assert (out.title, out.city, out.country, out.work_type, out.job_type, out.salary_min) == ("New", "", "", "REMOTE", "GIG", "")
    out = merged(spark, '{"title": "INVALID", "city": "LYON", "description": "short"}')
    assert (out.title, out.city, out.work_type, out.description) == ("T", "Lyon", "ONSITE", "d" * 40)
    for bad in ("no object", "{broken", None):
        out = merged(spark, bad, description="")
        assert (out.title, out.description, out.salary_min) == ("T", "", "")


def test_enricher_is_injected(spark):
    df = spark.createDataFrame([("a",)], "title string")

    def shout(batches):
        for pdf in batches:
            yield pd.DataFrame({"title": pdf["title"].str.upper()})

    assert enrich.enrich(df, None, "").first().title == "a"
    assert enrich.enrich(df, shout, "title string").first().title == "A"
