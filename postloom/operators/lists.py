"""Several values packed in one field, one row per value.

A packed string is cut in three steps:

1. every run of ordinary characters is masked, which leaves the *delimiter
   skeleton* (``a,a,"a;a"``); this is a JVM expression;
2. the splitting rule of each **distinct** skeleton is resolved once: which of
   its tokens belong to which item (quotes, enclosing brackets and doubled
   quotes are understood here);
3. the rules go back to the rows, by a broadcast when their counted size allows
   it and by a shuffle join otherwise, and the items are taken from their
   positions in the token sequence, again in the JVM.

Work in Python therefore grows with the number of skeletons, not of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.session import cut, ship, small_enough

#: Stands for a slash with white space on both sides; such a slash separates.
SLASH = "\x01"
#: Characters with a role of their own; all others are ordinary.
STRUCTURAL = ",;|•、\t\n\r\"\\[\\]" + SLASH
SEPARATORS = frozenset(",;|•、\t\n\r" + SLASH)
#: White space as trimmed from the ends of an item.
EDGE = "[\\s\\u00a0\\u3000\\ufeff]+"
RULE_TYPE = "array<struct<s:int,n:int>>"


def trimmed(col: Column) -> Column:
    """``col`` without white space (no-break spaces too) at its ends."""
    return F.regexp_replace(col, f"^{EDGE}|{EDGE}$", "")


def marked(col: Column) -> Column:
    """Trimmed text with separating slashes replaced by ``SLASH``."""
    return F.regexp_replace(trimmed(col), "(?<=\\s)/(?=\\s)", SLASH)


def skeleton(col: Column) -> Column:
    """Delimiter skeleton of a marked text: ``a`` words, ``_`` blanks, delimiters kept."""
    words = F.regexp_replace(col, f"[^{STRUCTURAL}]*[^{STRUCTURAL}\\s][^{STRUCTURAL}]*", "a")
    return F.regexp_replace(words, f"[^a{STRUCTURAL}]+", "_")


def tokens(col: Column) -> Column:
    """The pieces of a marked text, one for each character of its skeleton."""
    return F.regexp_extract_all(col, F.lit(f"([^{STRUCTURAL}]+|[{STRUCTURAL}])"), 1)


def splitting_rule(shape: str) -> list[tuple[int, int]]:
    """Items of a skeleton as (first token, number of tokens), from 1.

    A quote opens only at the start of an item and closes at the next quote
    that is not doubled; a quote elsewhere, or one that never closes, is an
    ordinary character.  Brackets around the whole list are dropped.
    """
    lo, hi = 0, len(shape)
    while hi - lo >= 2 and shape[lo] == "[" and shape[hi - 1] == "]":
        lo, hi = lo + 1, hi - 1
        while lo < hi and shape[lo] == "_":
            lo += 1
        while hi > lo and shape[hi - 1] == "_":
            hi -= 1
    items: list[tuple[int, int]] = []

    def close(start: int, end: int) -> None:
        while start < end and shape[start] == "_":
            start += 1
        while end > start and shape[end - 1] == "_":
            end -= 1
        if end - start >= 2 and shape[start] == '"' and closing(start) == end - 1:
            start, end = start + 1, end - 1
        if end > start:
            items.append((start + 1, end - start))

    def closing(at: int) -> int:
        """Place of the quote that closes the one at ``at``, or -1."""
        i = at + 1
        while i < hi:
            if shape[i] == '"':
                if i + 1 < hi and shape[i + 1] == '"':
                    i += 2
                    continue
                return i
            i += 1
        return -1

    start = i = lo
    while i < hi:
        if shape[i] == '"' and not shape[start:i].strip("_"):
            end = closing(i)
            if end > 0:
                i = end + 1
                continue
        if shape[i] in SEPARATORS:
            close(start, i)
            start = i + 1
        i += 1
    close(start, hi)
    return items


def _rules(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pdf["rule"] = [[{"s": s, "n": n} for s, n in splitting_rule(x)] for x in pdf["skeleton"]]
        yield pdf


def skeleton_rules(shapes: DataFrame) -> DataFrame:
    """(skeleton, rule) for the distinct skeletons of ``shapes``."""
    ship(shapes.sparkSession)
    return shapes.select("skeleton").distinct().mapInPandas(_rules, f"skeleton string, rule {RULE_TYPE}")


def explode_packed(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per value of each packed field.

    Returns ``keys``, ``field_name``, ``pos`` (int, from 1 over the non-empty
    values) and ``item``.  Null, blank and delimiter-only fields give no rows;
    repeated values and repeated rows are kept; other columns of ``df`` are
    ignored, whatever their names.
    """
    cells = df.select(
        F.struct(*keys).alias("__key"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in fields])).alias("__cell"),
    ).select("__key", F.col("__cell.f").alias("field_name"), marked(F.col("__cell.v")).alias("__m"))
    cells = cells.filter(F.col("__m") != "").withColumn("skeleton", skeleton(F.col("__m")))
    rules = cut(skeleton_rules(cells))
    if small_enough(rules, 400):
        rules = F.broadcast(rules)
    joined = cells.join(rules, "skeleton").withColumn("__t", tokens(F.col("__m")))

    def item(r: Column) -> Column:
        text = F.array_join(F.slice(F.col("__t"), r["s"], r["n"]), "")
        unquoted = F.when(F.element_at("__t", F.greatest(r["s"] - 1, F.lit(1))) == '"', F.replace(text, F.lit('""'), F.lit('"'))).otherwise(text)
        return trimmed(F.replace(unquoted, F.lit(SLASH), F.lit("/")))

    items = F.filter(F.transform("rule", item), lambda x: x != "")
    return joined.select("__key.*", "field_name", F.posexplode(items).alias("__p", "item")).select(
        *keys, "field_name", (F.col("__p") + 1).cast("int").alias("pos"), "item"
    )
