"""Curation of source lists against scraped results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def source_stats(results: DataFrame, score: Column, least: int, ordinal: Column) -> DataFrame:
    """(source_url, total_jobs, quality_jobs) by the last result of each source.

    ``results`` has source_url, jobs_count and creative_jobs; ``score`` is a
    column over one job named ``job``.  The last result is taken before its
    jobs are scored, so no other result is exploded.
    """
    last = results.groupBy("source_url").agg(F.max_by(F.struct("jobs_count", "creative_jobs"), ordinal).alias("r"))
    jobs = last.select("source_url", F.col("r.jobs_count").alias("total_jobs"), F.explode_outer("r.creative_jobs").alias("job"))
    return jobs.groupBy("source_url").agg(F.first("total_jobs").alias("total_jobs"), F.sum(F.when(F.col("job").isNotNull() & (score >= least), 1).otherwise(0)).cast("long").alias("quality_jobs"))


def bucket() -> Column:
    """Where a listed source belongs, over total_jobs and quality_jobs of a left join."""
    return F.when(F.col("total_jobs").isNull(), "not_in_scrape").when(F.col("total_jobs") == 0, "zero").when(F.col("quality_jobs") == 0, "low").otherwise("keep")


def prune(listed: DataFrame, stats: DataFrame) -> DataFrame:
    """Every listed source with its bucket."""
    return listed.select("source_url").join(stats, "source_url", "left").withColumn("bucket", bucket())


def promote(stats: DataFrame, master: DataFrame) -> DataFrame:
    """Every scraped source as promoted, known or rejected."""
    known = master.select("source_url").distinct().withColumn("known", F.lit(True))
    return stats.join(known, "source_url", "left").select(
        "source_url", "quality_jobs", F.when(F.col("quality_jobs") == 0, "rejected").when(F.col("known"), "known").otherwise("promoted").alias("decision")
    )


def unseen(found: DataFrame, *known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in none of the known lists."""
    for other in known:
        found = found.join(other.select(key).distinct(), key, "left_anti")
    return found


def tag_weights(tags: DataFrame, user: str, tag: str, floor: int) -> DataFrame:
    """(tag, users, weight): distinct users of each tag used by at least ``floor``, log-smoothed to at most 10."""
    pairs = tags.filter(F.col(user).isNotNull() & F.col(tag).isNotNull()).select(user, tag).distinct()
    counted = pairs.groupBy(tag).agg(F.count("*").alias("users")).filter(F.col("users") >= floor)
    total = pairs.agg(F.countDistinct(user)).scalar()
    return counted.select(F.col(tag).alias("tag"), "users", F.round(F.log1p("users") / F.log1p(total) * 10, 2).alias("weight"))


def append_new(master: DataFrame, new: DataFrame, key: str, ordinal: str) -> DataFrame:
    """``master`` (key, ordinal) in its order, then the keys of ``new`` that it lacks in theirs, each once.

    The result's ordinal goes on from the master's largest; ties of repeated
    new keys go to the first.
    """
    base = master.groupBy(key).agg(F.min(ordinal).alias(ordinal))
    last = base.agg(F.coalesce(F.max(ordinal), F.lit(0))).scalar()
    added = new.groupBy(key).agg(F.min(ordinal).alias(ordinal)).join(base.select(key), key, "left_anti")
    return base.select(key, ordinal).unionByName(added.select(key, (F.col(ordinal) + last + 1).alias(ordinal)))


def discovered(pages: DataFrame, known: DataFrame, listed: DataFrame) -> DataFrame:
    """Hosts of hiring organisations on stored pages (html) that are neither known nor listed, and the listed ones, sorted.

    ``known`` has url, ``listed`` has host.
    """
    from postloom.functions import urls
    from postloom.functions.html import organisation_hosts_column

    hosts = pages.select(F.explode(organisation_hosts_column(F.col("html"))).alias("host")).distinct()
    old = known.select(urls.bare_host(F.col("url")).alias("host")).filter("host is not null")
    return unseen(hosts, old, listed, key="host").unionByName(listed.select("host")).distinct().orderBy("host")
