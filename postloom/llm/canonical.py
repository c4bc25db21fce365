"""Free-typed values mapped to the closest entry of a reference list.

The reference entries (and other names for them) form BK-trees under the
Levenshtein distance, a true metric, so a search may skip every subtree that
the triangle inequality rules out and still returns **every** entry within the
threshold.  Small lists travel as one broadcast tree; larger ones are cut into
shards, each value is searched in every shard, and the shard winners merge.
Only distinct values are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.titles import fold, parse_title, role_spellings
from postloom.operators.lists import trimmed
from postloom.session import cut, ship

#: Entries of the reference list that travel as one broadcast tree.
BROADCAST_ENTRIES = 20_000
#: Values that one task searches in one shard.
VALUES_PER_TASK = 20_000
UNMATCHED = -1


def levenshtein(a: str, b: str) -> int:
    """Edit distance (insert, delete, substitute) by bit-parallel columns."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) or len(b)
    peq: dict[str, int] = {}
    for i, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << i
    n = len(a)
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = full, 0, n
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | 1) & full
        pv = (mh << 1 & full) | ~(xv | ph) & full
        mv = ph & xv
    return score


def one_slip_apart(a: str, b: str) -> bool:
    """Whether ``b`` is ``a`` with one letter added, lost, changed, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    if len(a) == len(b):
        return x[1:] == y[1:] or (len(x) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])
    return x[1:] == y if len(a) > len(b) else x == y[1:]


class BKTree:
    """Entries (text, id) under the Levenshtein distance."""

    def __init__(self, entries: Iterable[tuple[str, int]]):
        self.root: list | None = None
        for text, ident in sorted(set(entries)):
            self.add(text, ident)

    def add(self, text: str, ident: int) -> None:
        if self.root is None:
            self.root = [text, [ident], {}]
            return
        node = self.root
        while True:
            d = levenshtein(node[0], text)
            if d == 0:
                if ident not in node[1]:
                    node[1].append(ident)
                return
            child = node[2].get(d)
            if child is None:
                node[2][d] = [text, [ident], {}]
                return
            node = child

    def within(self, text: str, radius: int) -> list[tuple[int, str, int]]:
        """Every (distance, entry, id) at most ``radius`` away, nearest first."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            entry, idents, children = stack.pop()
            d = levenshtein(entry, text)
            if d <= radius:
                out += [(d, entry, i) for i in idents]
            stack += [child for edge, child in children.items() if abs(edge - d) <= radius]
        return sorted(out)


def radius_of(text: str) -> int:
    """Threshold by length: short forms must be exact, others may have one slip (two edits if swapped)."""
    return 0 if len(text) <= 3 else 1 if len(text) == 4 else 2


def acceptable(text: str, entry: str, d: int) -> bool:
    """Exact check after the search: one slip, or one in each of several long words."""
    if d == 0 or one_slip_apart(text, entry):
        return True
    a, b = text.split(), entry.split()
    if len(a) != len(b) or len(a) < 2:
        return len(text) >= 12 and d <= 2
    return all(x == y or (len(x) >= 4 and one_slip_apart(x, y)) for x, y in zip(a, b))


# Marks of mastery around a skill.
MASTERY_BEFORE = re.compile(r"^(?:basic|basics in|strong|solid|advanced|expert|good|proven|working|deep)\s+")
MASTERY_AFTER = re.compile(r"\s+(?:skills?|basics|\((?:expert|advanced|basic|beginner|intermediate)\)|[-–]\s*(?:daily use|expert|basic|advanced))$")
QUALIFIER = re.compile(r"\s*[,;|(\"].*$")


def skill_spellings(value: str) -> list[str]:
    """Readings of a skill, most literal first: as typed, without mastery, without qualifier."""
    text = " ".join(fold(value).split()).strip(" .*")
    bare = text
    while True:
        shorter = MASTERY_AFTER.sub("", MASTERY_BEFORE.sub("", bare)).strip()
        if shorter == bare or not shorter:
            break
        bare = shorter
    return [x for x in dict.fromkeys([text, bare, QUALIFIER.sub("", bare).strip()]) if x]


def title_spellings(value: str) -> list[str]:
    return role_spellings(parse_title(value).role)


SPELLINGS = {"title": title_spellings, "skill": skill_spellings}


def entry_form(kind: str, name: str) -> str:
    """A reference name in the form in which values are compared with it."""
    forms = SPELLINGS[kind](name)
    return forms[0] if forms else ""


def best_entry(tree: BKTree, spellings: list[str]) -> tuple[int, int, int]:
    """(distance, reading, id) of the closest accepted entry, or (-1, 0, UNMATCHED)."""
    best: tuple[int, int, int] | None = None
    for rank, text in enumerate(spellings):
        for d, entry, ident in tree.within(text, radius_of(text)):
            if acceptable(text, entry, d) and (best is None or (d, rank, ident) < best):
                best = (d, rank, ident)
        if best and best[0] == 0:
            break
    return best or (-1, 0, UNMATCHED)


@lru_cache(maxsize=8)
def _tree(entries: tuple[tuple[str, int], ...]) -> BKTree:
    return BKTree(entries)


def reference_entries(terms: DataFrame, aliases: dict[str, dict[str, list[str]]]) -> DataFrame:
    """(kind, form, term_id) for the names of ``terms`` and their other names.

    ``terms`` has term_id, term_kind and canonical_name; ``aliases`` gives by
    kind and canonical name what else the thing is called.  Null names and
    kinds are left out.
    """
    rows = [(kind, name, other) for kind, names in aliases.items() for name, others in names.items() for other in others]
    spark = terms.sparkSession
    ship(spark)
    base = terms.select(F.col("term_kind").alias("kind"), F.col("canonical_name").alias("name"), "term_id").filter("kind is not null and name is not null")
    other = base.join(F.broadcast(spark.createDataFrame(rows, "kind string, name string, other string")), ["kind", "name"]).select("kind", F.col("other").alias("name"), "term_id")

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["form"] = [entry_form(k, n) if k in SPELLINGS else fold(n) for k, n in zip(pdf["kind"], pdf["name"])]
            yield pdf[["kind", "form", "term_id"]]

    return base.select("kind", "name", "term_id").unionByName(other).mapInPandas(forms, "kind string, form string, term_id long").filter("form <> ''").distinct()


def map_values(values: DataFrame, entries: DataFrame, shards: int | None = None) -> DataFrame:
    """(kind, value, term_id, distance) for the distinct (kind, value) of ``values``.

    ``term_id`` is -1 and ``distance`` -1 where no entry lies within the
    threshold; blank values count as unmatched.  Ties go to the reading nearest
    to what was typed, then to the smallest id.  With ``shards`` (or a list of
    more than ``BROADCAST_ENTRIES``) the entries are split by hash; every value
    meets every shard and the winners merge.
    """
    ship(values.sparkSession)
    parts = max(1, values.sparkSession.sparkContext.defaultParallelism)
    distinct = values.select("kind", "value").filter("kind is not null and value is not null").distinct()
    entries = cut(entries)
    count = entries.count()
    if shards is None:
        shards = max(1, -(-count // BROADCAST_ENTRIES))
    if shards == 1:
        packed = entries.sparkSession.sparkContext.broadcast(tuple(sorted((r.kind, r.form, r.term_id) for r in entries.collect())))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            trees = {kind: _tree(tuple((f, i) for k, f, i in packed.value if k == kind)) for kind in {k for k, _, _ in packed.value}}
            for pdf in batches:
                yield _searched(pdf, trees)

        # a number of partitions that is asked for is not merged into one however small the values are
        return distinct.repartition(parts, "value").mapInPandas(search, "kind string, value string, distance int, term_id long, shard_rank int").drop("shard_rank")

    sharded = entries.withColumn("shard", F.pmod(F.xxhash64("form"), F.lit(shards)).cast("int"))
    distinct = cut(distinct)
    salts = max(1, -(-distinct.count() // VALUES_PER_TASK))
    queries = distinct.withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    replicas = sharded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def shard_search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        trees = {k: BKTree(zip(g["form"], g["term_id"].astype(int))) for k, g in right.groupby("kind")}
        return _searched(left, trees)

    found = queries.groupBy("shard", "salt").cogroup(replicas.groupBy("shard", "salt")).applyInPandas(shard_search, "kind string, value string, distance int, term_id long, shard_rank int")
    best = F.min(F.when(F.col("distance") >= 0, F.struct("distance", "shard_rank", "term_id")))
    return found.groupBy("kind", "value").agg(best.alias("b")).select("kind", "value", F.coalesce("b.distance", F.lit(-1)).alias("distance"), F.coalesce("b.term_id", F.lit(UNMATCHED)).cast("long").alias("term_id"))


def _searched(pdf: pd.DataFrame, trees: dict[str, BKTree]) -> pd.DataFrame:
    rows = []
    for kind, value in zip(pdf["kind"], pdf["value"]):
        tree = trees.get(kind)
        spellings = SPELLINGS[kind](value) if kind in SPELLINGS else [fold(value)]
        d, rank, ident = best_entry(tree, spellings) if tree else (-1, 0, UNMATCHED)
        rows.append((kind, value, d, ident, rank))
    return pd.DataFrame(rows, columns=["kind", "value", "distance", "term_id", "shard_rank"])
