"""Orders and batches over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from postloom.session import cut


def with_position(df: DataFrame, order: Sequence[str], name: str = "position", ranges: int | None = None) -> DataFrame:
    """Rows numbered from 0 in a unique total order.

    The rows are range-partitioned and sorted, partitions are counted, and each
    row adds its place in the partition to the rows before it: two passes, and
    no task ever holds more than its range.  There are as many ranges as shuffle
    partitions unless ``ranges`` says otherwise.
    """
    parts = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__part", "__before")
    numbered = ranged.withColumn("__at", F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1)
    return numbered.join(F.broadcast(before), "__part").withColumn(name, (F.col("__before") + F.col("__at")).cast("long")).drop("__part", "__before", "__at")


def batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Rows with the number (from 0) of their batch of ``size`` in the order."""
    return with_position(df, order).withColumn("batch", F.floor(F.col("position") / size).cast("long"))


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of the order, ordered (a top-n report)."""
    return df.orderBy(*order).limit(n)


def spread_key(df: DataFrame, group: Column, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rows with a sort key in [0, 1) that spreads each group evenly.

    The i-th of a group's n rows gets (i + 1/2) / n, so large groups are spaced
    over the whole order.  Rows without a group come last, with key null.
    Within a hot group, rows are numbered by slices of the order, so no task
    holds a whole group; there are as many slices as shuffle partitions, 64 at
    least, unless ``slices`` says otherwise.
    """
    slices = slices or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = df.withColumn("__g", F.nullif(F.lower(F.trim(group)), F.lit("")))
    ranged = cut(named.repartitionByRange(slices, *order).withColumn("__s", F.spark_partition_id()))
    counts = ranged.groupBy("__g", "__s").agg(F.count("*").alias("__n"))
    over = counts.select("__g", "__s", F.coalesce(F.sum("__n").over(W.partitionBy("__g").orderBy("__s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__b"), F.sum("__n").over(W.partitionBy("__g")).alias("__all"))
    at = ranged.withColumn("__i", F.row_number().over(W.partitionBy("__g", "__s").orderBy(*order)) - 1).join(over, (ranged["__g"].eqNullSafe(over["__g"])) & (ranged["__s"] == over["__s"])).drop(over["__g"], over["__s"])
    key = F.when(F.col("__g").isNotNull(), (F.col("__b") + F.col("__i") + 0.5) / F.col("__all"))
    return at.withColumn("spread_key", key).drop("__g", "__s", "__i", "__b", "__all")


def spread_slots(sizes: Sequence[int], blanks: int = 0) -> list[list[int]]:
    """Exact slots of each group's rows, for group sizes in descending order.

    Row i of a group of n aims at floor(i*T/n + T/(2n)) mod T and takes the next
    free slot from there; blank rows fill what is left.  Free slots are found
    through merged runs, so the work is near-linear in T.
    """
    total = sum(sizes) + blanks
    after = list(range(total + 1))

    def free(i: int) -> int:
        root = i
        while after[root] != root:
            root = after[root]
        while after[i] != root:
            after[i], i = root, after[i]
        return root

    out = []
    for n in sizes:
        step, own = total / n, []
        for i in range(n):
            slot = free(int(i * step + step / 2) % total)
            if slot == total:
                slot = free(0)
            after[slot] = slot + 1
            own.append(slot)
        out.append(own)
    rest, at = [], 0
    for _ in range(blanks):
        at = free(at)
        after[at] = at + 1
        rest.append(at)
    return out + [rest]


#: Rows up to which the exact order is computed; it depends on every earlier choice, so it is one sequence.
EXACT_ROWS = 2_000_000


def spread(df: DataFrame, group: str, ordinal: str) -> DataFrame:
    """Rows with ``slot``: their place when one group's rows are spread out.

    Only the group sizes go to the driver; each (group, i) gets its slot in the
    driver and comes back by a join.  Tables of more than ``EXACT_ROWS`` rows
    are refused: use ``spread_key``, which needs no sequence.
    """
    spark = df.sparkSession
    named = cut(df.withColumn("__g", F.lower(F.trim(F.coalesce(F.col(group), F.lit(""))))))
    if named.count() > EXACT_ROWS:
        raise ValueError("too many rows for the exact order; use spread_key")
    sizes = named.groupBy("__g").agg(F.count("*").alias("n"), F.min(ordinal).alias("f")).collect()
    groups = sorted((r for r in sizes if r["__g"]), key=lambda r: (-r.n, r.f))
    blanks = sum(r.n for r in sizes if not r["__g"])
    slots = spread_slots([r.n for r in groups], blanks)
    rows = [(r["__g"], own) for r, own in zip(groups, slots)] + [("", slots[-1])]
    table = spark.createDataFrame(rows, "__g string, slots array<long>").select("__g", F.posexplode("slots").alias("__i", "slot"))
    numbered = named.withColumn("__i", F.row_number().over(W.partitionBy("__g").orderBy(ordinal)) - 1)
    return numbered.join(table, ["__g", "__i"]).drop("__g", "__i")
