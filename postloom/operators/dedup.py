"""Keyed deduplication with a defined winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], exempt: Column | None = None) -> DataFrame:
    """One row of each group of equal keys: the one that sorts first by ``order``.

    Computed as a minimum over (order, row), so every partition sends one row
    of a group and a hot key is never sorted in one task.  Null keys are equal
    to each other.  ``order`` must be unique within a group; it takes ascending
    columns, so negate numbers to prefer large ones.  Rows where ``exempt`` is
    true all stay.
    """
    cols = [F.coalesce(k.cast("string"), F.lit("\x00null")) for k in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    packed = F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"), row.alias("r"))
    grouped = df if exempt is None else df.filter(~F.coalesce(exempt, F.lit(False)))
    best = grouped.select(*[c.alias(f"__k{i}") for i, c in enumerate(cols)], packed.alias("__p")).groupBy(*[f"__k{i}" for i in range(len(cols))]).agg(F.min_by("__p", F.col("__p.o")).alias("__b"))
    out = best.select("__b.r.*")
    return out if exempt is None else out.unionByName(df.filter(F.coalesce(exempt, F.lit(False))))


def keep_first(df: DataFrame, keys: Sequence[Column], ordinal: Column, exempt: Column | None = None) -> DataFrame:
    """The first row of each group by a unique ordinal."""
    return keep_best(df, keys, [ordinal], exempt)
