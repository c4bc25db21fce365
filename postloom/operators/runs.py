"""What runs did: counts of kept and removed rows, discovery statistics, sources that fell silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recency_counts(df: DataFrame, day: Column, cutoff: Column) -> DataFrame:
    """One row: kept, dropped and undated rows; a day that cannot be read counts as none."""
    d = F.try_to_date(F.substring(F.trim(day), 1, 10), "yyyy-MM-dd")
    return df.agg(F.count_if(d >= cutoff).alias("kept"), F.count_if(d < cutoff).alias("dropped"), F.count_if(d.isNull()).alias("undated"))


def removed_counts(df: DataFrame, url_key: Column, cross_key: Column) -> DataFrame:
    """One row: rows, how many repeat an address, and how many of the addresses' first rows repeat a cross key.

    Keys are counted, not rows listed: an address that is null repeats nothing.
    Of an address's rows those with the least cross key stand for it.
    """
    keyed = df.select(url_key.alias("u"), cross_key.alias("c"))
    alone = F.when(F.col("u").isNull(), F.monotonically_increasing_id())
    firsts = keyed.withColumn("alone", alone).groupBy("u", "alone").agg(F.count("*").alias("n"), F.min("c").alias("c"))
    by_cross = firsts.groupBy("c").agg(F.sum("n").alias("rows"), F.count("*").alias("firsts"))
    extra = F.when(F.col("c").isNotNull(), F.col("firsts") - 1).otherwise(0)
    return by_cross.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("rows") - F.col("firsts")), F.lit(0)).alias("url_repeats"), F.coalesce(F.sum(extra), F.lit(0)).alias("cross_repeats"))


def discovery_stats(found: DataFrame, known: DataFrame, host: str, key: str) -> DataFrame:
    """(host, captured, unique, new): addresses of each host, their distinct keys, and those that no list knows."""
    once = found.filter(F.col(host).isNotNull()).groupBy(host, key).agg(F.count("*").alias("n"))
    marked = once.join(known.select(key).distinct().withColumn("__known", F.lit(True)), key, "left")
    return marked.groupBy(host).agg(F.sum("n").alias("captured"), F.count(F.col(key)).alias("unique"), F.count_if(F.col("__known").isNull() & F.col(key).isNotNull()).alias("new"))


def silent_sources(runs: DataFrame, source: str, jobs: Column, order: Column, least: int = 2) -> DataFrame:
    """(source, empty_runs): sources whose last ``least`` runs or more brought nothing.

    By aggregates only: the runs after the last one that brought something.
    """
    run = F.struct(order.alias("o"))
    facts = runs.select(source, run.alias("run"), (jobs > 0).alias("full"))
    last = facts.groupBy(source).agg(F.max(F.when(F.col("full"), F.col("run"))).alias("last_full"))
    after = facts.join(last, source).filter(F.col("last_full").isNull() | (F.col("run") > F.col("last_full")))
    return after.groupBy(source).agg(F.count("*").alias("empty_runs")).filter(F.col("empty_runs") >= least)


def kept_list(buckets: DataFrame) -> DataFrame:
    """Sources that stay listed: the kept ones and those that were not scraped, as they are."""
    return buckets.filter(F.col("bucket") == "keep").select("source_url").unionAll(buckets.filter(F.col("bucket") == "not_in_scrape").select("source_url"))
