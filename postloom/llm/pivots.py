"""New batches checked against all accepted postings through a pivot-distance table.

Each posting row has up to two points in a metric space:

* its *link point*: the space is the host and tenant of its link, the text is
  the posting's number or code, and only distance 0 is the same posting;
* its *wording point*: the space is organisation, city, level, field and team;
  the text is the role, by its name in the reference list where that knows it,
  else as typed, and small edit distances of typed roles are the same role.

Points of different spaces are infinitely far apart, points of one space have
their Levenshtein distance, so the whole is a metric.  The table stores the
distance of each accepted point to a few fixed pivots.  A new point meets only
the range of the table in which the triangle inequality leaves it a chance
(an equi-join on space and distance range), the other pivots thin the
candidates, and the true distance decides.  Points accepted from a batch are
appended; older points are never measured again.

What makes two wordings comparable, the labels of organisations and roles, is
stored with the table: ``History`` keeps every name and role that was met, so a
new batch links only names and roles that no batch before it had.  A label once
given never changes.  Where a new name shows two organisations to be one, the
points of the one are appended under the label of the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import parse_qsl, unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import canonical
from postloom.llm.canonical import acceptable, radius_of
from postloom.llm.components import connected_components
from postloom.llm.names import NameIndex, extend_names, resolved
from postloom.operators.layout import with_position
from postloom.session import cut, ship, ship_active, small_enough

#: The pivots: fixed texts of different length and letters.
PIVOTS = ("", "data engineer", "warehouse night clerk", "pqxz liability technician")
#: Largest edit distance of two wordings of one role.
RADIUS = 2
#: Width of a distance range of the first pivot.
RANGE_WIDTH = 4

# Query parameters that carry a posting's number, and a board's tenant.
NUMBER_PARAMS = ("gh_jid", "token", "job", "jobid", "job_id", "jid", "req", "reqid", "posting", "vacancy", "id")
TENANT_PARAMS = ("for", "tenant", "company", "board", "org")
# Path segments that are part of a board's form.
FORM_SEGMENTS = frozenset("jobs job careers career openings opening apply p embed job_app positions position vacancies o".split())
LOCALE = re.compile(r"[a-z]{2}(?:[-_][a-z]{2})?")
NUMBER_SEGMENT = re.compile(r"(?:.*-)?(\d{5,})|(\d{5,})-.*|([0-9a-f]{10,}|[0-9a-f]{8}-[0-9a-f-]{27})")


class Link(NamedTuple):
    host: str
    tenant: str
    code: str


def parse_link(link: str | None) -> Link | None:
    """Host, tenant and number of a posting's link; None where there is no link.

    Case of the host, ``www.``, scheme, fragment, locale, tracking parameters,
    doubled and closing slashes do not matter.  A link without any number is
    identified by its whole path.
    """
    if link is None:
        return None
    text = re.sub(r"^[a-z][a-z0-9+.-]*:", "", link.strip().strip("<>\"'"), flags=re.I).lstrip("/").split("#")[0]
    place, _, query = text.partition("?")
    host, _, path = place.partition("/")
    host = host.rpartition("@")[2].split(":")[0].rstrip(".").lower()
    host = host.removeprefix("www.")
    if not host:
        return None
    params = {k.lower(): v for k, v in reversed(parse_qsl(query))}
    segments = [unquote(s).lower() for s in path.split("/") if s]
    number = next((params[k] for k in NUMBER_PARAMS if params.get(k)), None)
    if number:
        tenant = next((params[k] for k in TENANT_PARAMS if params.get(k)), "")
        return Link(host, tenant.lower(), number.strip().lower())
    for i in range(len(segments) - 1, -1, -1):
        hit = NUMBER_SEGMENT.fullmatch(segments[i])
        if hit:
            before = [s for s in segments[:i] if s not in FORM_SEGMENTS and not LOCALE.fullmatch(s)]
            return Link(host, before[-1] if before else "", next(g for g in hit.groups() if g))
    return Link(host, "", "/" + "/".join(segments))


def _links(links: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_link(x) or (None, None, None) for x in links], columns=["host", "tenant", "code"])


def link_parts(link: Column) -> Column:
    """Struct of host, tenant and code; all null where there is no link."""
    ship_active()
    return F.pandas_udf(_links, "struct<host:string,tenant:string,code:string>")(link)


def with_pivots(points: DataFrame, text: str = "text") -> DataFrame:
    """Points with their distances to the pivots (``d``), computed in the JVM."""
    return points.withColumn("d", F.array(*[F.levenshtein(F.col(text), F.lit(p)) for p in PIVOTS]))


def range_candidates(new: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs of different points of one space whose distances to the first pivot share a range."""

    def side(points: DataFrame, name: str, reach: int) -> DataFrame:
        low = F.floor((F.col("d")[0] - reach) / RANGE_WIDTH).cast("int")
        ranges = F.explode(F.sequence(low, F.floor((F.col("d")[0] + reach) / RANGE_WIDTH).cast("int")))
        term = F.col("term") if "term" in points.columns else F.lit(None).cast("long")
        return points.select(F.col("point").alias(name), "space", F.col("text").alias(f"t{name}"), F.col("d").alias(f"d{name}"), term.alias(f"term{name}"), ranges.alias("range"))

    return side(table, "a", 0).join(side(new, "b", radius), ["space", "range"]).filter("a <> b")


def pivot_candidates(new: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Those pairs of ``range_candidates`` that the triangle inequality leaves by every pivot."""
    met = range_candidates(new, table, radius)
    for i in range(len(PIVOTS)):
        met = met.filter(F.abs(F.col("da")[i] - F.col("db")[i]) <= radius)
    return met


def near_pairs(new: DataFrame, table: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) = (point of ``table``, point of ``new``) of one space at most ``radius`` apart.

    Both have point, space, text and ``d``, and may have ``term``: the entry of
    the reference list that a text names; texts of different entries, or of an
    entry and none, are different roles however near they are.  The join is on
    space and range of the first pivot's distance, so its work follows the
    points whose distances let them be near.  Texts too short for a slip must
    be equal.
    """
    met = pivot_candidates(new, table, radius)
    met = met.filter(F.levenshtein("ta", "tb", radius) >= 0).filter("terma <=> termb").select("a", "b", "ta", "tb")

    ship(new.sparkSession)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [radius_of(p) > 0 and acceptable(p, q, radius) and acceptable(q, p, radius) for p, q in zip(pdf["ta"], pdf["tb"])]
            yield pdf.loc[keep, ["a", "b"]]

    return met.mapInPandas(exact, "a string, b string")


class Accepted(NamedTuple):
    """What is kept of the accepted rows: the pivot-distance table and the postings.

    ``points``: point, space, text, term, d (distances to the pivots), class;
    ``links``: link, class, nth, first (a second row of a link brings the class
    that the first row lacked); ``counts``: class, host, links (how many links
    of a host a class has); ``heads``: class, nth, first.  All four are compact
    and only ever appended to; ``first`` is the ord of a posting's first row.
    """

    points: DataFrame
    links: DataFrame
    counts: DataFrame
    heads: DataFrame

    def save(self, folder: str) -> None:
        for name, df in self._asdict().items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Accepted:
        return cls(*[spark.read.parquet(f"{folder}/{name}") for name in cls._fields])


def wording_classes(new: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``new`` points (with ``d``) and their class: near wordings share one.

    New points are measured against the known ones and each other, known ones
    never again.  A group of new points joins the smallest class that one of
    them is near to; known classes do not merge.
    """
    linked = connected_components(near_pairs(new, new))
    grouped = new.join(linked.withColumnRenamed("node", "point"), "point", "left").withColumn("class", F.coalesce("component", "point")).drop("component")
    if known is None:
        return grouped
    near = near_pairs(new, known).join(known.select(F.col("point").alias("a"), F.col("class").alias("known")), "a").groupBy(F.col("b").alias("point")).agg(F.min("known").alias("known"))
    home = grouped.join(near, "point").groupBy("class").agg(F.min("known").alias("known"))
    return grouped.join(home, "class", "left").withColumn("class", F.coalesce("known", "class")).drop("known")


def moved_points(points: DataFrame, aliases: DataFrame) -> DataFrame:
    """Points of organisations that turned out to be another, under that one's label.

    ``aliases``: organisation, root.  The text stays, so its distances to the
    pivots do too and nothing is measured; wordings that the other has already
    are left to it.
    """
    named = points.withColumn("organisation", F.substring_index("space", "\x1f", 1)).join(aliases, "organisation")
    space = F.concat("root", F.expr("substring(space, length(organisation) + 1, length(space))"))
    moved = named.withColumn("space", space).withColumn("point", F.concat_ws("\x1e", "space", "text")).groupBy("point").agg(*[F.min_by(c, "class").alias(c) for c in points.columns if c != "point"])
    return moved.select(*points.columns).join(points.select("point"), "point", "left_anti").select(*points.columns)


def accept(rows: DataFrame, before: Accepted | None = None, aliases: DataFrame | None = None) -> tuple[DataFrame, Accepted]:
    """(ord, first) of the rows, and what is accepted after them.

    ``rows``: ord (sortable, unique), host, tenant, code (null without link),
    space, text (null where the wording says too little) and perhaps term.
    ``first`` is the ord of the first row of the posting that the row announces.
    Rows of several batches may come at once; ord decides which was first.
    ``aliases`` names organisations that this batch showed to be others.

    Rows of one link are one posting.  Postings meet by wording only where
    their links cannot be compared: of the links of one host within a wording
    class the n-th joins the n-th of each other host, and rows without link
    join the first.  A link accepted without wording takes the class of the first
    row that brings one, with its own first row.  Hot links and wordings are
    aggregated to one row before anything is sorted or joined.
    """
    if "term" not in rows.columns:
        rows = rows.withColumn("term", F.lit(None).cast("long"))
    if before and aliases is not None:
        before = before._replace(points=before.points.unionByName(cut(moved_points(before.points, aliases))))
    rows = cut(
        rows.withColumn("link", F.when(F.col("host").isNotNull(), F.concat_ws("\x1f", "host", "tenant", "code")))
        .withColumn("point", F.when(F.col("space").isNotNull(), F.concat_ws("\x1e", "space", "text")))
        .select("ord", "host", "link", "point", "space", "text", "term")
    )
    points = rows.filter("point is not null").select("point", "space", "text", "term").distinct()
    if before:
        fresh = cut(wording_classes(with_pivots(points.join(before.points.select("point"), "point", "left_anti")), before.points))
        classes = points.join(before.points.select("point", "class"), "point").select("point", "class").unionByName(fresh.select("point", "class"))
    else:
        fresh = cut(wording_classes(with_pivots(points)))
        classes = fresh.select("point", "class")
    with_class = rows.select("ord", "host", "link", "point").join(classes, "point", "left")
    by_link = with_class.filter("link is not null").groupBy("link", "host").agg(F.min("ord").alias("first_ord"), F.min(F.when(F.col("class").isNotNull(), F.struct("ord", "class"))).alias("w"))
    seen = by_link.select("link", "host", "first_ord", F.col("w.class").alias("class"))
    if before:
        stored = before.links.join(seen.select("link"), "link", "left_semi").groupBy("link").agg(F.max("class").alias("old"), F.max("nth").alias("old_nth"), F.min("first").alias("old_first"))
        seen = seen.join(stored, "link", "left")
    else:
        seen = seen.withColumns({"old": F.lit(None).cast("string"), "old_nth": F.lit(None).cast("long"), "old_first": F.lit(None).cast(rows.schema["ord"].dataType)})
    seen = cut(seen)
    # numbered over the whole order and then within the group, so that no task holds a whole hot class
    named = seen.filter("old is null and class is not null").select("link", "host", "class", F.coalesce("old_first", "first_ord").alias("first_ord"))
    placed = with_position(named, ["class", "host", "first_ord"], "place")
    start = placed.groupBy("class", "host").agg(F.min("place").alias("start"))
    ranked = placed.join(start, ["class", "host"]).withColumn("nth", F.col("place") - F.col("start") + 1).drop("place", "start")
    if before:
        ranked = ranked.join(before.counts, ["class", "host"], "left").withColumn("nth", F.col("nth") + F.coalesce("links", F.lit(0))).drop("links")
    ranked = cut(ranked.select("link", "host", "first_ord", "class", F.col("nth").cast("long").alias("nth")))
    bare = with_class.filter("link is null and class is not null").groupBy("class").agg(F.min("ord").alias("first"))
    parts = ranked.select("class", "nth", F.col("first_ord").alias("first")).unionByName(bare.select("class", F.lit(1).cast("long").alias("nth"), "first"))
    heads = cut((parts.unionByName(before.heads) if before else parts).groupBy("class", "nth").agg(F.min("first").alias("first")))
    placed_links = ranked.select("link", "class", "nth", F.lit(True).alias("new")).unionByName(seen.filter("old is not null").select("link", F.col("old").alias("class"), F.col("old_nth").alias("nth"), F.lit(False).alias("new")))
    nameless = seen.filter("old is null and class is null").select(
        "link", F.lit(None).cast("string").alias("class"), F.lit(None).cast("long").alias("nth"), F.col("old_first").isNull().alias("new"), F.coalesce("old_first", "first_ord").alias("first")
    )
    homes = cut(placed_links.join(heads, ["class", "nth"]).unionByName(nameless))
    links = homes.filter("new").drop("new")
    if before:
        links = links.unionByName(before.links)
    found = (
        rows.filter("link is not null").select("ord", "link").join(homes.select("link", "first"), "link").select("ord", "first")
        .unionByName(with_class.filter("link is null and class is not null").select("ord", "class").join(heads.filter("nth = 1"), "class").select("ord", "first"))
        .unionByName(with_class.filter("link is null and class is null").select("ord", F.col("ord").alias("first")))
    )
    counts = ranked.groupBy("class", "host").agg(F.count("*").alias("links"))
    if before:
        counts = counts.unionByName(before.counts).groupBy("class", "host").agg(F.sum("links").alias("links"))
    table = fresh.select("point", "space", "text", "term", "d", "class")
    return found, Accepted(table.unionByName(before.points) if before else table, links, counts, heads)


def posting_points(parts: DataFrame, organisations: DataFrame, roles: DataFrame) -> DataFrame:
    """Link and wording points of posting rows taken apart by ``posting_parts``.

    ``organisations``: name, organisation (see ``names.extend_names``);
    ``roles``: value, term_id, term_name (see ``canonical.map_values``).
    """
    named = parts.join(organisations.withColumnRenamed("name", "company"), "company", "left").join(roles.withColumnRenamed("value", "role"), "role", "left")
    known = F.col("term_id") >= 0
    place = F.lower(F.trim("city"))
    words = F.array_join(F.array_sort(F.split(F.regexp_replace("role", "[,\\s]+", " "), " ")), " ")
    says = F.col("organisation").isNotNull() & (F.col("role") != "") & F.col("city").isNotNull() & (place != "")
    # the text of an entry is marked, for a typed role may read the same without being it
    text = F.when(known, F.concat(F.lit("="), F.lower("term_name"))).otherwise(words)
    space = F.concat_ws("\x1f", "organisation", place, "level", "field", "team")
    return named.select("ord", "host", "tenant", "code", F.when(says, space).alias("space"), F.when(says, text).alias("text"), F.when(says & known, F.col("term_id")).alias("term"))


def posting_parts(rows: DataFrame) -> DataFrame:
    """ord, company and city of ``rows``, with their title and link taken apart."""
    from postloom.llm.titles import title_parts

    return rows.select("ord", "company", "city", title_parts(F.col("title"), F.col("city")).alias("t"), link_parts(F.col("job_link")).alias("l")).select("ord", "company", "city", "t.*", "l.*")


class History(NamedTuple):
    """All that later batches need of the accepted rows; the rows themselves are not needed.

    ``accepted``: the pivot-distance table and the postings; ``names``: the
    organisations of all names met; ``roles``: value, term_id of all roles met.
    """

    accepted: Accepted
    names: NameIndex
    roles: DataFrame

    def save(self, folder: str) -> None:
        self.accepted.save(f"{folder}/accepted")
        self.names.save(f"{folder}/names")
        self.roles.write.mode("overwrite").parquet(f"{folder}/roles")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> History:
        return cls(Accepted.load(spark, f"{folder}/accepted"), NameIndex.load(spark, f"{folder}/names"), spark.read.parquet(f"{folder}/roles"))


def accept_postings(rows: DataFrame, terms: DataFrame, aliases: dict[str, dict[str, list[str]]], before: History | None = None) -> tuple[DataFrame, History]:
    """(ord, first) of posting rows, and the history that they leave.

    ``rows``: ord, title, company, city, job_link; ``terms``: the reference
    list with term_id, term_kind and canonical_name, and ``aliases`` its other
    names.  Names and roles that the history holds are looked up, others are
    linked and mapped, and nothing of the history is read but the tables that
    ``History`` names.
    """
    spark = rows.sparkSession
    ship(spark)
    parts = cut(posting_parts(rows))
    index = extend_names(parts.select(F.col("company").alias("name")), before.names if before else None)
    index = index._replace(names=cut(index.names) if not before else index.names)
    values = parts.select(F.col("role").alias("value"), F.lit("title").alias("kind")).filter("value <> ''").distinct()
    if before:
        values = values.join(before.roles.select("value"), "value", "left_anti")
    fresh = cut(canonical.map_values(values, canonical.reference_entries(terms, aliases))).select("value", "term_id")
    roles = fresh.unionByName(before.roles) if before else fresh
    met = parts.select(F.col("company").alias("name")).filter("name is not null").distinct()
    labels = cut(resolved(index.names.join(met, "name", "left_semi"), index.aliases))
    wanted = parts.select(F.col("role").alias("value")).distinct()
    names_of = terms.select("term_id", F.col("canonical_name").alias("term_name")).filter("term_id is not null").dropDuplicates(["term_id"])
    mapped = cut(roles.join(wanted, "value", "left_semi").join(names_of, "term_id", "left"))
    labels = F.broadcast(labels) if small_enough(labels, 120) else labels
    mapped = F.broadcast(mapped) if small_enough(mapped, 80) else mapped
    points = posting_points(parts, labels, mapped)
    moved = cut(index.aliases.join(before.names.aliases, ["organisation", "root"], "left_anti")) if before else None
    found, accepted = accept(points, before.accepted if before else None, moved)
    return found, History(accepted, index, roles)
