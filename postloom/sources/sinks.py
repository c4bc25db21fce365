"""Writers: flat CSV, JSON records, scored and reviewed files, curated lists, caches, latest and history snapshots, manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def flat(df: DataFrame, list_columns: Mapping[str, str] | None = None) -> DataFrame:
    """Every column as a string: lists joined by their separator (``, ``), nulls empty."""
    seps = dict(list_columns or {})
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "array":
            c = F.array_join(c, seps.get(field.name, ", "))
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(field.name))
    return df.select(out)


def write_csv(df: DataFrame, path: str, list_columns: Mapping[str, str] | None = None, header: Sequence[str] | None = None) -> None:
    """CSV that ``readers.read_csv`` reads back to the same strings; ``header`` fixes columns and their order, missing ones stay empty."""
    if header:
        df = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in header])
    flat(df, list_columns).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_rejected(df: DataFrame, keep: Column, path: str, fields: Sequence[str]) -> DataFrame:
    """The kept rows; the others' fields go to an audit file beside ``path``."""
    rejected = df.filter(~F.coalesce(keep, F.lit(False))).select(*fields)
    if not rejected.isEmpty():
        write_csv(rejected, f"{path}_dropped.csv")
    return df.filter(keep)


def iso_week(ts: Column) -> Column:
    """``2026-W09``: the ISO year and week."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def run_tag(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd_HHmmss"), F.lit("Z"))


def snapshot(df: DataFrame, root: str, run_at: Column) -> None:
    """The rows under ``latest`` and, partitioned by week and run, under ``history``; a repeated run replaces itself."""
    df.write.mode("overwrite").parquet(f"{root}/latest")
    tagged = df.withColumns({"iso_week": iso_week(run_at), "run_tag": run_tag(run_at)})
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("iso_week", "run_tag").parquet(f"{root}/history")


def write_manifest(spark: SparkSession, path: str, facts: Mapping[str, object]) -> None:
    """One small JSON file with counts and names."""
    spark.createDataFrame([(json.dumps(dict(facts), sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def upsert(base: DataFrame, changes: DataFrame, key: str, keep_from_base: Sequence[str] = ()) -> DataFrame:
    """``base`` with the rows of ``changes`` put in by key; named columns keep their old value where there is one."""
    old = base.select(key, *[F.col(c).alias(f"__old_{c}") for c in keep_from_base])
    new = changes.join(old, key, "left").withColumns({c: F.coalesce(f"__old_{c}", c) for c in keep_from_base}).drop(*[f"__old_{c}" for c in keep_from_base])
    return base.join(changes.select(key), key, "left_anti").unionByName(new.select(base.columns))


def write_json(df: DataFrame, path: str, single: bool = False) -> None:
    """Records as JSON lines, null fields left out; ``single`` gathers a small result in one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").json(path)


def write_records(df: DataFrame, path: str, api_fields: Sequence[str], own_fields: Sequence[str]) -> None:
    """Two projections of one table: ``api_fields`` nested under apiJob beside ``own_fields``, and the former alone."""
    api = F.struct(*[F.col(f) for f in api_fields]).alias("apiJob")
    write_json(df.select(api, *own_fields), f"{path}/enriched")
    write_json(df.select(*api_fields), f"{path}/api")


def write_cache(cache: DataFrame, path: str) -> None:
    """A cache table, written beside the old one, so that a cache read from ``path`` may be written back to it."""
    from postloom.session import cut

    cut(cache).write.mode("overwrite").parquet(path)


def write_scored(df: DataFrame, score: Column, path: str) -> None:
    """All columns and ``creative_score`` as CSV, lowest score first."""
    write_csv(df.withColumn("creative_score", score).orderBy("creative_score"), path)


def write_reviewed(df: DataFrame, verdicts: DataFrame, key: str, path: str) -> None:
    """All columns with Status and Notes of ``verdicts`` (key, status, notes) as CSV; rows without one wait for review."""
    said = verdicts.select(key, F.col("status").alias("Status"), F.col("notes").alias("Notes"))
    joined = df.join(said, key, "left").withColumns({"Status": F.coalesce("Status", F.lit("REVIEW")), "Notes": F.coalesce("Notes", F.lit(""))})
    write_csv(joined.select(*df.columns, "Status", "Notes"), path)


def write_lists(lists: Mapping[str, DataFrame], folder: str, apply: bool = False) -> str:
    """Curated lists under ``folder``: as proposals, or in force with ``apply``; returns where they went."""
    target = f"{folder}/{'lists' if apply else 'proposed'}"
    for name, df in lists.items():
        write_json(df, f"{target}/{name}")
    return target
