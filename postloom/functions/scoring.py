"""Relevance scores from a weighted dictionary or from fixed tiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import vocab


def clamp(weight: float, half_even: bool) -> int:
    """A weight as a score from 2 to 10, halves up or to even."""
    whole = int(weight // 1)
    part = weight - whole
    up = part > 0.5 or part == 0.5 and (not half_even or whole % 2 == 1)
    return max(2, min(10, whole + up))


#: Keywords that travel as patterns of one expression; larger dictionaries are joined.
PATTERN_KEYWORDS = 10_000


def usable(table: DataFrame) -> DataFrame:
    """keyword (lower case) and weight of a dictionary table, without null and not-a-number values."""
    return table.filter("keyword is not null and weight is not null and not isnan(weight)").select(F.lower("keyword").alias("keyword"), F.col("weight").cast("double").alias("weight"))


def weights_of(table: DataFrame) -> list[tuple[str, float]]:
    """(keyword, weight) of a dictionary of at most ``PATTERN_KEYWORDS`` keywords; for others see ``with_dictionary_score``."""
    rows = usable(table).limit(PATTERN_KEYWORDS + 1).collect()
    if len(rows) > PATTERN_KEYWORDS:
        raise ValueError(f"more than {PATTERN_KEYWORDS} keywords: use with_dictionary_score")
    return sorted((r.keyword, r.weight) for r in rows)


def with_dictionary_score(df: DataFrame, text: Column, table: DataFrame, key: str, half_even: bool = False, name: str = "score") -> DataFrame:
    """``df`` with the score of ``dictionary_score``, for a dictionary of any size; ``key`` is unique.

    Up to ``PATTERN_KEYWORDS`` the dictionary is part of the expression.  Beyond
    that texts and keywords meet by the keyword's first word, each meeting is
    tested with the keyword's own pattern, and the best is joined back.
    Keywords without a letter or digit never match.
    """
    if table.limit(PATTERN_KEYWORDS + 1).count() <= PATTERN_KEYWORDS:
        return df.withColumn(name, dictionary_score(text, weights_of(table), half_even))
    low = F.lower(F.coalesce(text, F.lit("")))
    escaped = F.regexp_replace("keyword", r"([.*+?^${}()|\[\]\\])", r"\\$1")
    pattern = F.concat(F.lit(vocab.OPEN), escaped, F.lit(vocab.CLOSE))
    rounded = (F.bround if half_even else F.round)(F.col("weight"), 0).cast("int")
    words = usable(table).select(F.regexp_extract("keyword", "[a-z0-9_]+", 0).alias("word"), pattern.alias("pattern"), F.greatest(F.lit(2), F.least(F.lit(10), rounded)).alias("points"))
    texts = df.select(key, low.alias("low")).select(key, "low", F.explode(F.array_distinct(F.regexp_extract_all("low", F.lit("([a-z0-9_]+)"), 1))).alias("word"))
    best = texts.join(words.filter("word <> ''"), "word").filter(F.rlike("low", F.col("pattern"))).groupBy(key).agg(F.max("points").alias(name))
    return df.join(best, key, "left").withColumn(name, F.coalesce(name, F.lit(vocab.NEUTRAL_SCORE)))


def dictionary_score(text: Column, weights: Iterable[tuple[str, float]], half_even: bool = False) -> Column:
    """The best rounded weight of any keyword in the text, 3 where none stands in it.

    Rounding keeps order, so keywords are grouped by their rounded weight and
    each of the at most nine groups is one alternation, tested best first.
    """
    groups: dict[int, list[str]] = {}
    for keyword, weight in weights:
        groups.setdefault(clamp(weight, half_even), []).append(keyword)
    low = F.lower(F.coalesce(text, F.lit("")))
    score = None
    for value in sorted(groups, reverse=True):
        hit = low.rlike(vocab.words(sorted(groups[value])))
        score = F.when(hit, value) if score is None else score.when(hit, value)
    return F.lit(vocab.NEUTRAL_SCORE) if score is None else score.otherwise(vocab.NEUTRAL_SCORE)


def tier_score(text: Column) -> Column:
    """The first tier with a hit, 3 without any."""
    low = F.lower(F.coalesce(text, F.lit("")))
    score = None
    for value, spec in vocab.TIERS.items():
        hit = low.rlike(vocab.java_any(vocab.tier_patterns(spec)))
        score = F.when(hit, value) if score is None else score.when(hit, value)
    return score.otherwise(vocab.NEUTRAL_SCORE)


def scored_text(title: Column, description: Column, head: int = 200) -> Column:
    """Title and the first ``head`` characters of the description (the score's own definition)."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.substring(F.coalesce(description, F.lit("")), 1, head))
