"""Pictures of companies resolved once for each company."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import urls
from postloom.functions.text import trim
from postloom.session import ship

# One of these endings of a name is cut off, once.
NAME_TAIL = r"\s*(?:inc\.?|llc|ltd\.?|limited|corp\.?|corporation|gmbh|pvt\.?|private|software|services|athletics|retail|uk|spa)\s*$"
#: Least size in bytes of a picture that is one.
LEAST_BYTES = 100


def guesses(name: Column) -> Column:
    """Domains that a name suggests, likeliest first; none for names of less than two plain letters."""
    low = F.lower(trim(name))
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(low, NAME_TAIL, ""), r",\s*$", "")), r"[^a-z0-9\s]", ""), r"\s+", "")
    return F.when(F.length(bare) >= 2, F.array(*[F.concat(bare, F.lit(t)) for t in (".com", ".io", ".co")])).otherwise(F.array().cast("array<string>"))


def candidates(rows: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """(company_key, domains) of each company: an override alone, or its website and then guesses.

    An override with an empty domain says that there is none.
    """
    named = rows.filter(trim(F.col("company")) != "").withColumn("company_key", F.lower(trim(F.col("company"))))
    site = urls.strip_career_label(urls.bare_host(F.col("company_website")))
    first = named.groupBy("company_key").agg(F.min_by(F.when(~urls.is_board_domain(site), site), F.struct(F.when(trim(F.col("company_website")) != "", 0).otherwise(1), F.col("row_id"))).alias("site"))
    own = F.filter(F.array_distinct(F.concat(F.array("site"), guesses(F.col("company_key")))), lambda d: d.isNotNull() & (d != ""))
    if overrides is None:
        return first.select("company_key", own.alias("domains"))
    both = first.join(overrides.select("company_key", F.col("domain").alias("set")), "company_key", "left")
    return both.select("company_key", F.when(F.col("set").isNull(), own).when(F.col("set") == "", F.array().cast("array<string>")).otherwise(F.array("set")).alias("domains"))


def valid_picture(status: Column, kind: Column, size: Column, digest: Column, stand_ins: list[str]) -> Column:
    """A fetched picture that is one: found, an image, large enough, and no known stand-in."""
    return F.coalesce((status == 200) & kind.startswith("image/") & (size >= LEAST_BYTES) & ~digest.isin(*stand_ins), F.lit(False))


def resolve(wanted: DataFrame, cache: DataFrame, resolver: Callable[[list[str]], tuple[str, str] | None]) -> DataFrame:
    """The cache with the companies that it lacked; failures are kept too, so none is tried twice.

    ``resolver`` gets a company's domains and gives (domain, address) or None.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, domains in zip(pdf["company_key"], pdf["domains"]):
                hit = resolver(list(domains))
                rows.append((key, *hit, "resolved") if hit else (key, None, None, "unresolved"))
            yield pd.DataFrame(rows, columns=["company_key", "domain_host", "logo_url", "logo_source"])

    ship(wanted.sparkSession)
    new = wanted.join(cache.select("company_key"), "company_key", "left_anti").mapInPandas(run, "company_key string, domain_host string, logo_url string, logo_source string")
    return cache.select("company_key", "domain_host", "logo_url", "logo_source").unionByName(new)
