"""The path from scraped rows to distinct, described postings (stages 1 to 3), as one plan.

Cheap predicates come before the two deduplications, those before any call of
an enricher; a stored table of pages stands in for fetching.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import extract, predicates, urls, vocab
from postloom.functions import text as tx
from postloom.functions.html import posting_column, text_column
from postloom.operators import dedup, enrich

PLACEHOLDER = "For job details, click apply."
Enricher = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


@dataclass(frozen=True)
class Options:
    """Limits are features of a run: ``max_jobs`` keeps the first rows after deduplication, None all."""

    cutoff: Column | None = None
    max_jobs: int | None = None
    least_score: int = 2


def normalise(raw: DataFrame) -> DataFrame:
    """Rows (row_id, title, url, location, company, ats, source_url, description, date_posted) with clean fields."""
    return raw.withColumns(
        {
            "title": tx.collapse(F.col("title")),
            "url": urls.absolute(tx.collapse(F.col("url")), F.col("source_url")),
            "location": F.coalesce(F.nullif(tx.collapse(F.col("location")), F.lit("")), F.lit("Not specified")),
            "company": F.coalesce(F.nullif(tx.collapse(F.col("company")), F.lit("")), urls.company_from_host(F.col("source_url"))),
            "ats": F.coalesce("ats", F.lit("generic")),
        }
    ).filter("title <> '' and url <> ''")


def candidates(jobs: DataFrame, options: Options) -> DataFrame:
    """Strict titles, first of each address and title, recent, worth a look; trails cut from titles."""
    kept = jobs.filter(predicates.title_strict(F.col("title"))).withColumn("url", urls.canonical(F.col("url")))
    first = dedup.keep_first(kept, [F.lower("url"), F.lower("title")], F.col("row_id"))
    if options.max_jobs is not None:
        first = first.orderBy("row_id").limit(options.max_jobs)
    if options.cutoff is not None:
        first = first.filter(predicates.recent(F.col("date_posted"), options.cutoff))
    seen = first.filter(~predicates.skip_before_fetch(F.col("title"), F.col("url")))
    return seen.withColumn("title", tx.strip_breadcrumb(F.col("title"), vocab.BREADCRUMB))


def with_pages(jobs: DataFrame, pages: DataFrame | None) -> DataFrame:
    """The stored page's JobPosting node and text beside each row."""
    if pages is None:
        return jobs.withColumns({"node": F.lit(None).cast("string"), "page_text": F.lit(None).cast("string")})
    read = pages.select(urls.canonical(F.col("url")).alias("url"), posting_column(F.col("html")).alias("node"), text_column(F.col("html")).alias("page_text"))
    return jobs.join(dedup.keep_first(read, [F.col("url")], F.col("page_text")), "url", "left")


def described(jobs: DataFrame) -> DataFrame:
    """Fields read from title, description and page; weak rows are rescued or dropped."""
    node = F.from_json("node", "title string, description string, employmentType string, jobLocationType string, validThrough string")
    own, page = F.coalesce("description", F.lit("")), F.coalesce(tx.cut_at_markers(F.coalesce(node["description"], F.col("page_text"))), F.lit(""))
    chosen = F.when((F.length(own) > 200) & ((F.length(page) < 300) | (F.length(own) >= F.length(page))), own).when(page != "", page).otherwise(own)
    d = jobs.withColumn("seed", F.col("title")).withColumns({"title": F.coalesce(F.nullif(tx.collapse(node["title"]), F.lit("")), F.col("title")), "description": chosen, "employment": F.coalesce(node["employmentType"], F.lit("")), "place_type": F.coalesce(node["jobLocationType"], F.lit("")), "until": node["validThrough"]})
    r = d.withColumn("r", predicates.rescue(F.col("title"), F.col("seed"), F.col("description"), F.col("url")))
    kept = r.filter("r.keep").withColumns({"title": F.col("r.title"), "description": F.when(F.col("r.placeholder") | (tx.trim(F.col("description")) == ""), PLACEHOLDER).otherwise(F.col("description"))})
    text, place = F.col("description"), extract.location(F.col("location"))
    return (
        kept.withColumn("place", place)
        .withColumns(
            {
                "score": predicates.text_score(predicates.combined(F.col("title"), text, F.col("url"))),
                "job_type": extract.job_type(F.col("title"), text, F.col("employment")),
                "work_type": F.when(F.upper("place_type") == "TELECOMMUTE", "REMOTE").otherwise(extract.work_type(F.col("title"), text, F.col("place.address"))),
                "salary": extract.salary(text),
                "keywords": extract.keyword_terms(F.col("title"), text),
                "deadline": F.coalesce(extract.day(F.col("until")), extract.deadline(text)),
                "positions": extract.positions(text),
                "email": extract.email(text),
                "posted": extract.day(F.col("date_posted")),
            }
        )
        .drop("r", "seed", "node", "page_text", "employment", "place_type", "until")
    )


def run(raw: DataFrame, pages: DataFrame | None = None, enricher: Enricher | None = None, options: Options = Options()) -> DataFrame:
    """Described, distinct postings of the scraped rows, each passed through the enricher if there is one."""
    out = described(with_pages(candidates(normalise(raw), options), pages))
    final = dedup.keep_first(out, [F.lower("title"), F.lower(urls.canonical(F.col("url")))], F.col("row_id"))
    return enrich.enrich(final, enricher, final.schema.simpleString()[len("struct<") : -1] if enricher else "")
