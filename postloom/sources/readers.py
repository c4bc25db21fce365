"""Readers with explicit schemas, and projections of board replies into one row shape."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.functions import urls
from postloom.functions.text import blank_to_null, decode_entities, slug_to_name, trim

JOB_FIELDS = "title string, url string, location string, company string, ats string, source string, description string, datePosted string"
SCRAPE_SCHEMA = f"source string, ats string, tenant string, jobs_count int, creative_jobs array<struct<{','.join(f.replace(' ', ':') for f in JOB_FIELDS.split(', '))}>>"
UPLOAD_COLUMNS = (
    "title jobType description deadline keywords skills jobLink workEmail numberOfPositions workType formattedAddress city state country latitude longitude company companyWebsite "
    "companyLogo companyEmail salaryMin salaryMax salaryCurrency salaryPeriod allowEmailApplications hiringTeam screeningQuestions"
).split()
VISIBILITY = "job.visibility.allowedLocations"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header: quoted commas, doubled quotes, line breaks in fields, BOM; empty fields are empty strings."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', mode="PERMISSIVE", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_scrapes(spark: SparkSession, path: str) -> DataFrame:
    """Stage results, nested or as a flat list of jobs, as one row per job with defaults filled."""
    schema = f"{SCRAPE_SCHEMA}, {', '.join(f for f in JOB_FIELDS.split(', ') if f.split()[0] not in ('source', 'ats'))}"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    nested = raw.filter("creative_jobs is not null").select(F.explode("creative_jobs").alias("j")).select("j.*")
    flat = raw.filter("creative_jobs is null and title is not null").select(*[F.col(f.split()[0]) for f in JOB_FIELDS.split(", ")])
    return with_defaults(nested.unionByName(flat))


def with_defaults(jobs: DataFrame) -> DataFrame:
    """Jobs with a title and an http address; open fields get their stand-ins."""
    kept = jobs.filter(F.col("title").isNotNull() & F.col("url").rlike("(?i)^https?://"))
    fill = {"location": F.lit("Not specified"), "ats": F.lit("generic"), "company": F.lit("unknown"), "source": F.col("url")}
    return kept.withColumns({c: F.coalesce(F.col(c), d) for c, d in fill.items()})


def read_strings(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """A JSON array of strings, one row each; other values are dropped, and so is a file that is no array.

    A missing file gives no rows with ``missing_ok``; without it that is an error.
    """
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException:
        if not missing_ok:
            raise
        return spark.createDataFrame([], "value string")
    items = F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")
    texts = raw.select(F.explode(items).alias("v")).filter(F.schema_of_variant("v") == "STRING")
    return texts.select(F.try_variant_get("v", "$", "string").alias("value"))


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Addresses of an index capture in JSON lines; broken lines are dropped."""
    return spark.read.schema("url string").json(path, mode="DROPMALFORMED").filter("url is not null")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, weight) of a score dictionary file; values that are no numbers are dropped."""
    raw = spark.read.text(path, wholetext=True)
    parsed = F.from_json("value", "weights map<string,string>")
    return raw.select(F.explode(parsed["weights"]).alias("keyword", "w")).select("keyword", F.col("w").try_cast("double").alias("weight")).filter("weight is not null and not isnan(weight)")


def _join(*parts: Column) -> Column:
    """Filled parts joined by commas, null without any."""
    kept = F.filter(F.array(*[blank_to_null(p) for p in parts]), lambda p: p.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(kept, ", "))


BOARD_SCHEMAS = {
    "greenhouse": "name string, jobs array<struct<title:string,absolute_url:string,content:string,first_published:string,updated_at:string,location:struct<name:string>>>",
    "lever": "jobs array<struct<text:string,hostedUrl:string,state:string,categories:struct<location:string>>>",
    "ashby": "jobs array<struct<title:string,jobUrl:string,location:string,descriptionHtml:string,descriptionPlain:string,publishedAt:string>>, jobPostings array<struct<title:string,jobUrl:string,location:string,descriptionHtml:string,descriptionPlain:string,publishedAt:string>>",
    "workable": "name string, jobs array<struct<title:string,url:string,shortlink:string,city:string,state:string,country:string,telecommuting:boolean,locations:array<struct<city:string,region:string,country:string>>,description:string,published_on:string,created_at:string>>",
    "smartrecruiters": "content array<struct<name:string,ref:string,location:struct<city:string,region:string,country:string,remote:boolean>>>",
    "workday": "jobPostings array<struct<title:string,externalPath:string,locationsText:string,bulletFields:array<string>>>",
    "amazon": "jobs array<struct<title:string,job_path:string,city:string,state:string,country:string,location:string>>",
}


def board_jobs(replies: DataFrame, system: str) -> DataFrame:
    """(tenant, title, url, location, company, ats, description, date_posted) of stored board replies.

    ``replies`` has tenant, origin (the board's address) and body (JSON).  A
    body that cannot be read gives nothing.
    """
    parsed = replies.select("tenant", "origin", F.from_json("body", BOARD_SCHEMAS[system]).alias("r"))
    none = F.lit(None).cast("string")
    first = lambda *cs: F.coalesce(*[blank_to_null(c) for c in cs])
    listed = F.col({"smartrecruiters": "r.content", "workday": "r.jobPostings"}.get(system, "r.jobs"))
    if system == "ashby":
        listed = F.coalesce(listed, F.col("r.jobPostings"))
    j = parsed.select("tenant", "origin", "r", F.explode(listed).alias("j"))
    c = lambda f: F.col(f"j.{f}")
    if system == "greenhouse":
        out = (trim(c("title")), trim(c("absolute_url")), first(c("location.name")), F.coalesce(first(F.col("r.name")), F.col("tenant")), decode_entities(first(c("content"))), first(c("first_published"), c("updated_at")))
    elif system == "lever":
        j = j.filter(F.coalesce(F.lower(c("state")) != "closed", F.lit(True)))
        out = (c("text"), c("hostedUrl"), c("categories.location"), none, none, none)
    elif system == "ashby":
        out = (trim(c("title")), trim(c("jobUrl")), trim(c("location")), slug_to_name(F.col("tenant")), first(c("descriptionHtml"), c("descriptionPlain")), first(c("publishedAt")))
    elif system == "workable":
        head = F.get(c("locations"), F.lit(0))
        nowhere = first(c("city")).isNull() & first(c("country")).isNull()
        place = F.when(c("telecommuting") & nowhere, "Remote").otherwise(F.coalesce(_join(head["city"], head["region"], head["country"]), _join(c("city"), c("state"), c("country")), F.when(c("telecommuting"), "Remote")))
        out = (c("title"), F.coalesce(c("url"), c("shortlink")), place, F.coalesce(first(F.col("r.name")), F.col("tenant")), first(c("description")), first(c("published_on"), c("created_at")))
    elif system == "smartrecruiters":
        place = F.coalesce(_join(c("location.city"), c("location.region"), c("location.country")), F.when(c("location.remote"), "Remote"))
        out = (c("name"), F.concat(F.lit("https://jobs.smartrecruiters.com/"), F.url_encode("tenant"), F.lit("/"), c("ref")), place, none, none, none)
    elif system == "workday":
        out = (c("title"), urls.absolute(c("externalPath"), F.col("origin")), F.coalesce(c("locationsText"), F.get(c("bulletFields"), F.lit(0))), none, none, none)
    else:
        out = (c("title"), urls.absolute(c("job_path"), F.col("origin")), F.coalesce(_join(c("city"), c("state"), c("country")), c("location")), F.lit("Amazon"), none, none)
    names = ("title", "url", "location", "company", "description", "date_posted")
    jobs = j.select("tenant", *[col.alias(n) for n, col in zip(names, out)], F.lit(system).alias("ats"))
    if system in ("greenhouse", "ashby"):
        jobs = jobs.filter((F.coalesce("title", F.lit("")) != "") & (F.coalesce("url", F.lit("")) != ""))
    return jobs


def seeds(spark: SparkSession, arguments: list[str] | None = None, environment: str | None = None, path: str | None = None) -> DataFrame:
    """Addresses to start from: the first source that holds any, of arguments, a JSON list and a file."""
    import json

    def web(values: list) -> list[str]:
        return [v for v in values if isinstance(v, str) and v.lower().startswith(("http://", "https://"))]

    listed = web(arguments or [])
    if not listed and environment:
        try:
            parsed = json.loads(environment)
        except ValueError:
            parsed = []
        listed = web(parsed if isinstance(parsed, list) else [])
    if listed or not path:
        return spark.createDataFrame([(v,) for v in listed], "url string")
    return read_strings(spark, path).filter("lower(value) rlike '^https?://'").withColumnRenamed("value", "url")


def review_tables(docs: DataFrame) -> DataFrame:
    """(doc_id, nr, cells, link) of the rows of Markdown tables, joined with the document's numbered sources.

    A row is a line of cells between bars that starts with a number; a source
    is such a row with an address in it.  Rows without source have no link.
    """
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(r"^\s*\|\s*[0-9]+\s*\|"))
    cells = F.transform(F.split(F.regexp_replace(F.col("line"), r"^\s*\||\|\s*$", ""), r"\|"), trim)
    rows = lines.select("doc_id", cells.alias("cells"), F.regexp_extract("line", r"(https?://[^\s|)>]+)", 1).alias("link")).withColumn("nr", F.col("cells")[0].cast("int"))
    sources = rows.filter("link <> '' and size(cells) <= 3").groupBy("doc_id", "nr").agg(F.min("link").alias("source"))
    main = rows.filter("not (link <> '' and size(cells) <= 3)")
    return main.join(sources, ["doc_id", "nr"], "left").select("doc_id", "nr", "cells", F.coalesce("source", F.nullif("link", F.lit(""))).alias("link"))
