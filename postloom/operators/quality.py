"""Quality reports, audits and review joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import trim


def filled(name: str) -> Column:
    """Whether a string field says anything."""
    return F.coalesce(trim(F.col(f"`{name}`")) != "", F.lit(False))


def missing_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: rows, and how many lack each field."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(~filled(f)).alias(f"no_{f}") for f in fields])


def missing_required(fields: Sequence[str]) -> Column:
    """Names of the required fields that a row lacks, in the given order."""
    return F.filter(F.array(*[F.when(~filled(f), f) for f in fields]), lambda f: f.isNotNull())


def field_audit(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, field, status) for every field of every row of two tables.

    MATCH, MISMATCH, or which side lacks the row; two nulls match.
    """
    a = left.select(key, *[F.col(f"`{f}`").cast("string").alias(f"l{i}") for i, f in enumerate(fields)], F.lit(True).alias("__l"))
    b = right.select(key, *[F.col(f"`{f}`").cast("string").alias(f"r{i}") for i, f in enumerate(fields)], F.lit(True).alias("__r"))
    status = [
        F.struct(F.lit(f).alias("field"), F.when(F.col("__r").isNull(), "MISSING_RIGHT").when(F.col("__l").isNull(), "MISSING_LEFT").when(F.col(f"l{i}").eqNullSafe(F.col(f"r{i}")), "MATCH").otherwise("MISMATCH").alias("status"))
        for i, f in enumerate(fields)
    ]
    return a.join(b, key, "full").select(key, F.explode(F.array(*status)).alias("s")).select(key, "s.*")


def drift(before: DataFrame, after: DataFrame, measures: dict[str, Column], least: float = 0.5) -> DataFrame:
    """One row: each measure before and after, and whether none fell below ``least`` of itself."""
    a = before.agg(*[m.alias(f"{n}_before") for n, m in measures.items()])
    b = after.agg(F.struct(*[m.alias(n) for n, m in measures.items()])).scalar()
    ok = F.lit(True)
    for n in measures:
        ok = ok & (F.col(f"{n}_after") >= F.col(f"{n}_before") * least)
    return a.withColumn("__after", b).select("*", *[F.col(f"__after.{n}").alias(f"{n}_after") for n in measures]).drop("__after").withColumn("accepted", ok)
