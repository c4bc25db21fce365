"""Mixes of several sources by target weights.

The tokens of each source are packed, in pseudorandom document order, into
blocks of fixed length.  A mix has so many slots of one block as its size asks
for; every source gets its number of slots, at most ``max_repeats`` passes over
its blocks.  Each output shard draws the source counts of its slots from a
multinomial distribution, with a generator of its own.  The draws of all shards
together miss the sources' numbers by a little, so a correction follows: slots
drawn too many, chosen by a pseudorandom permutation, go to sources drawn too
few, and every number is met exactly.  Slot numbers go through a pseudorandom
permutation of the source's block numbers, a new one for each pass, and blocks
are joined by number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from postloom.session import cut, ship, small_enough

BLOCK_TOKENS = 128
SHARD_SLOTS = 1024
SEED = 20_260_625
#: Documents in one range of the pseudorandom order in which each source is summed up.
RANGE_ROWS = 20_000
#: Shards that are drawn together and summed up together.
SHARD_CHUNK = 256


def _mix64(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each index under the keyed permutation of 0..size-1.

    A four-round Feistel network over the least even number of bits, walked
    until the value falls inside; it is a bijection for every key.
    """
    index, size, key = (np.asarray(x, dtype=np.int64) for x in np.broadcast_arrays(index, size, key))
    half = np.ceil(np.log2(np.maximum(size, 2)) / 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(value: np.ndarray, half: np.ndarray, mask: np.ndarray, key: np.ndarray) -> np.ndarray:
        left, right = value >> half, value & mask
        for r in range(4):
            with np.errstate(over="ignore"):
                mixed = _mix64(right + key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r * 0x632BE5AB))
            left, right = right, left ^ (mixed & mask)
        return left << half | right

    value = index.astype(np.uint64)
    out = once(value, half, mask, key)
    outside = out >= size.astype(np.uint64)
    while outside.any():
        out[outside] = once(out[outside], half[outside], mask[outside], key[outside])
        outside = out >= size.astype(np.uint64)
    return out.astype(np.int64)


def packed(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(source, block, doc_id, start, tokens): the piece of each document in each block.

    ``docs`` has doc_id, source and n_tokens.  Documents without source or
    tokens hold nothing.  Sums run in two steps, within ranges of the order
    and over the ranges, so a source of any size is never in one task.
    """
    order = F.xxhash64("doc_id", F.lit(SEED))
    held = docs.filter("source is not null and n_tokens > 0").select("source", "doc_id", "n_tokens", order.alias("o"))
    ranges = max(1, -(-held.count() // RANGE_ROWS))
    held = held.withColumn("range", F.floor((F.col("o").cast("double") / 2.0**64 + 0.5) * ranges).cast("int"))
    sums = held.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range"))
    before = sums.withColumn("before", F.sum("in_range").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)))
    before = cut(before.select("source", "range", F.coalesce("before", F.lit(0)).alias("before")))
    placed = held.join(F.broadcast(before) if small_enough(before, 80) else before, ["source", "range"])
    within = F.sum("n_tokens").over(W.partitionBy("source", "range").orderBy("o", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    at = placed.withColumn("from", F.col("before") + within - F.col("n_tokens")).withColumn("to", F.col("from") + F.col("n_tokens"))
    split = at.withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / block_tokens), F.floor((F.col("to") - 1) / block_tokens))))
    first = F.greatest(F.col("from"), F.col("block") * block_tokens)
    last = F.least(F.col("to"), (F.col("block") + 1) * block_tokens)
    return split.select("source", "block", "doc_id", (first - F.col("from")).alias("start"), (last - first).alias("tokens"))


def slot_plan(targets: DataFrame, sources: DataFrame, total_tokens: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Slots of each source in each mix, by target and by what the source can give.

    ``sources``: source, source_tokens.  Weights that are null or negative
    count as 0; a mix without positive weight gets nothing.
    """
    weight = F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))
    mix = W.partitionBy("mix_name")
    plan = (
        targets.select("mix_name", "source_name", weight.alias("w"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"), "corpus_fraction")
        .withColumn("all_w", F.sum("w").over(mix))
        .withColumn("target_share", F.when(F.col("all_w") > 0, F.col("w") / F.col("all_w")).otherwise(0.0))
        .withColumn("mix_tokens", F.round(F.coalesce("corpus_fraction", F.lit(0.0)) * total_tokens).cast("bigint"))
        .withColumn("target_tokens", F.round(F.col("target_share") * F.col("mix_tokens")).cast("bigint"))
    )
    held = plan.join(sources.withColumnRenamed("source", "source_name"), "source_name", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    blocks = F.ceil(F.col("source_tokens") / block_tokens)
    wanted = F.round(F.col("target_tokens") / block_tokens).cast("bigint")
    return held.withColumn("blocks", blocks.cast("bigint")).withColumn("slots", F.least(wanted, F.col("blocks") * F.col("max_repeats"))).withColumn("short", F.col("slots") < wanted)


def shard_counts(mix_name: str, shard: int, size: int, shares: np.ndarray) -> np.ndarray:
    """Slots of each source in one shard: a multinomial draw, the same each time it is made."""
    seed = [SEED, shard, *mix_name.encode("utf-8")]
    return np.random.Generator(np.random.Philox(np.random.SeedSequence(seed))).multinomial(size, shares)


def corrected(number: np.ndarray, source: np.ndarray, drawn_slots: np.ndarray, slots: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """(source, number within it) of slots after the correction.

    ``number`` counts a source's drawn slots over all shards.  Of a source that
    was drawn too often those slots stay whose permuted number falls below its
    ``slots``; the others are numbered, permuted, and fill up the sources that
    were drawn too rarely.
    """
    over = np.maximum(drawn_slots - slots, 0)
    under = np.maximum(slots - drawn_slots, 0)
    place = permute(number, drawn_slots[source], key + source)
    freed = place >= slots[source]
    start = np.concatenate([[0], np.cumsum(over)])[source]
    given = permute(np.where(freed, start + place - slots[source], 0), np.full(len(number), max(1, int(over.sum()))), np.full(len(number), key))
    ends = np.cumsum(under)
    taker = np.minimum(np.searchsorted(ends, given, side="right"), len(slots) - 1)
    filled = drawn_slots[taker] + given - (ends[taker] - under[taker])
    return np.where(freed, taker, source), np.where(freed, filled, place)


def drawn(plan: DataFrame) -> DataFrame:
    """(mix_name, source, shard, position, block, turn): one row for each slot.

    ``plan`` has one row for each target, so the sources of a mix are few; the
    shards are many and are drawn and summed up in chunks of ``SHARD_CHUNK``.
    """
    sources = plan.filter("slots > 0").groupBy("mix_name").agg(F.array_sort(F.collect_list(F.struct("source_name", "slots", "blocks"))).alias("sources"), F.sum("slots").alias("mix_slots"))
    last = F.floor((F.col("mix_slots") - 1) / (SHARD_SLOTS * SHARD_CHUNK))
    chunks = sources.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    ship(chunks.sparkSession)
    parts = max(1, chunks.sparkSession.sparkContext.defaultParallelism)

    def draw(mix_name: str, chunk: int, mix_slots: int, slots: np.ndarray) -> tuple[range, list[int], np.ndarray]:
        shards = range(chunk * SHARD_CHUNK, min((chunk + 1) * SHARD_CHUNK, -(-mix_slots // SHARD_SLOTS)))
        sizes = [min(SHARD_SLOTS, mix_slots - k * SHARD_SLOTS) for k in shards]
        return shards, sizes, np.array([shard_counts(mix_name, k, n, slots / slots.sum()) for k, n in zip(shards, sizes)], dtype=np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                _, _, counts = draw(r.mix_name, r.chunk, r.mix_slots, np.array([x["slots"] for x in r.sources], dtype=np.int64))
                yield pd.DataFrame({"mix_name": r.mix_name, "chunk": r.chunk, "counts": [counts.sum(axis=0).tolist()]})

    spread = chunks.repartition(parts, "mix_name", "chunk")
    counted = cut(spread.mapInPandas(count, "mix_name string, chunk long, counts array<bigint>"))
    # slots drawn before each chunk, and in all: one row for a chunk of shards, summed up by source
    each = counted.select("mix_name", "chunk", F.posexplode("counts").alias("at", "n"))
    run = W.partitionBy("mix_name", "at").orderBy("chunk")
    summed = each.withColumn("before", F.sum("n").over(run.rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).withColumn("total", F.sum("n").over(W.partitionBy("mix_name", "at")))
    sums = summed.groupBy("mix_name", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "before", "total"))).alias("sums"))

    def run_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                names = np.array([x["source_name"] for x in r.sources], dtype=object)
                slots, blocks = (np.array([x[k] for x in r.sources], dtype=np.int64) for k in ("slots", "blocks"))
                before, total = (np.array([x[k] for x in r.sums], dtype=np.int64) for k in ("before", "total"))
                shards, sizes, counts = draw(r.mix_name, r.chunk, r.mix_slots, slots)
                keys = np.array([zlib.crc32(f"{r.mix_name}\x1f{n}".encode()) % 1_000_003 for n in names], dtype=np.int64)
                mix_key = zlib.crc32(r.mix_name.encode()) % 1_000_003
                for shard, size, here in zip(shards, sizes, counts):
                    source = np.repeat(np.arange(len(names)), here)
                    within = np.arange(size) - np.repeat(np.cumsum(here) - here, here)
                    source, number = corrected(before[source] + within, source, total, slots, mix_key)
                    before = before + here
                    turn = number // blocks[source]
                    block = permute(number % blocks[source], blocks[source], keys[source] + turn * 7919)
                    position = shard * SHARD_SLOTS + permute(np.arange(size), np.full(size, size), np.full(size, mix_key + shard))
                    yield pd.DataFrame({"mix_name": r.mix_name, "source": names[source], "shard": shard, "position": position, "block": block, "turn": turn + 1})

    return chunks.join(sums, ["mix_name", "chunk"]).repartition(parts, "mix_name", "chunk").mapInPandas(run_chunks, "mix_name string, source string, shard long, position long, block long, turn long")


def mixes(docs: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(pieces, shares) of every mix.

    ``pieces``: mix_name, shard, position, source, block, turn, doc_id, start,
    tokens; the pieces of one position are one block of the output.
    ``shares``: one row for each target, with what was reached beside it.
    ``docs`` has doc_id, source, n_tokens.
    """
    docs = cut(docs.select("doc_id", "source", "n_tokens"))
    total = docs.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first().t
    docs = docs.join(targets.select(F.col("source_name").alias("source")).distinct(), "source", "left_semi")
    sources = docs.filter("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"))
    plan = cut(slot_plan(targets, sources, total, block_tokens))
    # both sides grow with the corpus, so neither is ever broadcast
    pieces = drawn(plan).hint("merge").join(packed(docs, block_tokens), ["source", "block"]).select("mix_name", "shard", "position", "source", "block", "turn", "doc_id", "start", "tokens")
    reached = pieces.groupBy("mix_name", F.col("source").alias("source_name")).agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.max("turn").alias("repeats"))
    mix = W.partitionBy("mix_name")
    shares = (
        plan.select("mix_name", "source_name", "target_share", "mix_tokens", "target_tokens", "source_tokens", "max_repeats", "short")
        .join(reached, ["mix_name", "source_name"], "left")
        .fillna(0, ["tokens", "documents", "repeats"])
        .withColumn("reached_tokens", F.sum("tokens").over(mix))
        .withColumn("actual_share", F.when(F.col("reached_tokens") > 0, F.col("tokens") / F.col("reached_tokens")).otherwise(0.0))
        .withColumn("size_share", F.when(F.col("mix_tokens") > 0, F.col("tokens") / F.col("mix_tokens")).otherwise(0.0))
        .drop("reached_tokens")
    )
    return pieces, shares
