"""Replies of an external enricher merged into rows.

The enricher is a function from batches to batches; offline the identity
stands in for it.  Everything around it is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import extract
from postloom.functions.text import single_line_html, strip_emoji, trim
from postloom.session import ship

REPLY_FIELDS = "title description jobType workType city state country salaryMin salaryMax salaryCurrency salaryPeriod keywords skills company".split()
REPLY_TYPE = "drop boolean, dropReason string, " + ", ".join(f"{f} string" for f in REPLY_FIELDS)
PLACEHOLDER = "For more details, click apply"


def enrich(df: DataFrame, enricher: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None, schema: str) -> DataFrame:
    """Rows passed through the enricher in batches; as they are without one."""
    ship(df.sparkSession)
    return df if enricher is None else df.mapInPandas(enricher, schema)


def parse_reply(raw: Column) -> Column:
    """A reply as a struct: fences and talk around the object do not matter; null where there is no object."""
    body = F.regexp_extract(raw, r"(?s)(\{.*\})", 1)
    parsed = F.from_json(F.nullif(body, F.lit("")), REPLY_TYPE)
    return F.when(F.try_parse_json(F.nullif(body, F.lit(""))).isNotNull(), parsed)


def _differs(new: Column, old: Column) -> Column:
    return F.coalesce((trim(new) != "") & (F.lower(trim(new)) != F.lower(trim(F.coalesce(old, F.lit(""))))), F.lit(False))


def merge(df: DataFrame, reply: str) -> DataFrame:
    """Columns of ``df`` with a parsed reply merged in; a null reply changes nothing but zero salaries.

    ``df`` has title, description, job_type, work_type, city, state, country,
    salary_min, salary_max, salary_currency, salary_period, company.  The place
    changes only where the reply contradicts it; a city "remote" clears the
    place and makes the work remote; a place left makes remote or open work
    on-site; a salary of zero is none.
    """
    r = lambda f: F.col(f"{reply}.{f}")
    said = lambda f: F.coalesce(trim(r(f)) != "", F.lit(False))
    has = F.col(reply).isNotNull()
    title = F.when(said("title") & (r("title") != "INVALID"), strip_emoji(r("title"))).otherwise(F.col("title"))
    short = F.length(F.coalesce(trim(F.col("description")), F.lit(""))) < 30
    text = single_line_html(r("description"))
    description = F.when(said("description") & (F.length(text) > 30), text).when(has & short, PLACEHOLDER).otherwise(F.col("description"))
    moved = has & (_differs(r("city"), F.col("city")) | _differs(r("state"), F.col("state")) | _differs(r("country"), F.col("country")))
    place = {f: F.when(moved, F.coalesce(r(f), F.lit(""))).otherwise(F.col(f)) for f in ("city", "state", "country")}
    work = F.coalesce(F.nullif(extract.work_type_value(r("workType")), F.lit("")), F.nullif(extract.work_type_value(F.col("work_type")), F.lit("")), F.lit(""))
    remote_city = F.coalesce(F.lower(trim(place["city"])) == "remote", F.lit(False))
    place = {f: F.when(remote_city, "").otherwise(c) for f, c in place.items()}
    somewhere = F.concat_ws("", *[trim(c) for c in place.values()]) != ""
    work = F.when(remote_city, "REMOTE").when(somewhere & work.isin("REMOTE", ""), "ONSITE").otherwise(work)

    def money(f: str, old: str) -> Column:
        v = F.coalesce(F.when(said(f), r(f)), F.col(old))
        return F.when(v.try_cast("double") == 0, "").otherwise(v)

    return df.withColumns(
        {
            "title": title,
            "company": F.when(_differs(r("company"), F.col("company")), r("company")).otherwise(F.col("company")),
            "description": description,
            "job_type": extract.job_type_value(F.coalesce(F.when(said("jobType"), r("jobType")), F.col("job_type"), F.lit(""))),
            "work_type": work,
            **place,
            "salary_min": money("salaryMin", "salary_min"),
            "salary_max": money("salaryMax", "salary_max"),
            "salary_currency": F.coalesce(F.when(said("salaryCurrency"), r("salaryCurrency")), F.col("salary_currency")),
            "salary_period": F.coalesce(F.when(said("salaryPeriod"), r("salaryPeriod")), F.col("salary_period")),
        }
    )
