"""Queries of the training-data operators over the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import boilerplate, canonical, encode, mix, mojibake, names, pivots, residue
from postloom.llm.aliases import ALIASES
from postloom.llm.titles import title_parts
from postloom.operators.lists import explode_packed
from postloom.session import cut, read_table, small_enough, spread_out


def _mapped(values: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (kind, value) with their term, checkpointed."""
    entries = canonical.reference_entries(read_table(spark, sf_dir, "canonical_terms"), ALIASES)
    return cut(canonical.map_values(values, entries))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of new batches that repeat a posting, with that posting's first row.

    History is accepted first; the new batches then meet its tables only.
    """
    rows = spread_out(read_table(spark, sf_dir, "upload_rows").select("row_id", "batch_no", "title", "company", "city", "job_link"))
    rows = rows.withColumn("ord", F.struct("batch_no", "row_id"))
    terms = read_table(spark, sf_dir, "canonical_terms")
    _, history = pivots.accept_postings(rows.filter("batch_no = 0"), terms, ALIASES)
    found, _ = pivots.accept_postings(rows.filter("batch_no >= 1"), terms, ALIASES, history)
    return found.filter("first <> ord").select(F.col("first.row_id").alias("row_id_a"), F.col("ord.row_id").alias("row_id_b"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term that each title and each value of skills means, or -1."""
    rows = spread_out(read_table(spark, sf_dir, "upload_rows").select("row_id", "title", "city", "skills"))
    titles = rows.filter(F.trim(F.regexp_replace("title", "[\\s\\u00a0]+", " ")) != "").select(
        "row_id", F.lit("title").alias("field_name"), F.lit(1).alias("pos"), F.lit("title").alias("kind"), title_parts(F.col("title"), F.col("city"))["role"].alias("value")
    )
    skills = explode_packed(rows, ["row_id"], ["skills"]).select("row_id", "field_name", "pos", F.lit("skill").alias("kind"), F.lower("item").alias("value"))
    cells = cut(titles.unionByName(skills))
    mapped = _mapped(cells.filter("value <> ''"), spark, sf_dir).select("kind", "value", "term_id")
    if small_enough(mapped, 60):
        mapped = F.broadcast(mapped)
    return cells.join(mapped, ["kind", "value"], "left").select("row_id", "field_name", "pos", F.coalesce("term_id", F.lit(canonical.UNMATCHED)).cast("long").alias("term_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of upload_rows.description that are page furniture."""
    return boilerplate.furniture(read_table(spark, sf_dir, "upload_rows"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of upload_rows with residue, filler, error or script messages."""
    return residue.residue(read_table(spark, sf_dir, "upload_rows"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of upload_rows.company that name one organisation."""
    rows = read_table(spark, sf_dir, "upload_rows")
    return names.name_pairs(names.link_names(rows.select(F.col("company").alias("name"))))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every documents.text by byte_bpe_50k, without special tokens."""
    return encode.encoded(read_table(spark, sf_dir, "documents"))


def _mixes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = spread_out(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", encode.token_count(F.col("text")).alias("n_tokens"))
    return mix.mixes(docs, read_table(spark, sf_dir, "mix_targets"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents that make up each mix of mix_targets."""
    return _mixes(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares reached beside the targets, for each mix and source."""
    return _mixes(spark, sf_dir)[1]


def p8_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share that each source is to hold of each mix."""
    none = spark.createDataFrame([], "source string, source_tokens bigint")
    plan = mix.slot_plan(read_table(spark, sf_dir, "mix_targets"), none, 0)
    return plan.select("mix_name", "source_name", F.round("target_share", 9).alias("target_share"), "max_repeats")


P8_TARGETS_SQL = """
WITH w AS (SELECT mix_name, source_name, greatest(coalesce(target_weight, 0), 0) AS w, CAST(greatest(coalesce(max_repeats, 0), 0) AS INTEGER) AS max_repeats FROM mix_targets),
t AS (SELECT mix_name, sum(w) AS all_w FROM w GROUP BY mix_name)
SELECT mix_name, source_name, round(CASE WHEN all_w > 0 THEN w / all_w ELSE 0 END, 9) AS target_share, max_repeats FROM w JOIN t USING (mix_name)
"""


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was, wholly or in part, read in a wrong encoding."""
    return mojibake.restored(read_table(spark, sf_dir, "documents")).filter("damaged").select("doc_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with its garbled lines restored where they can be."""
    return mojibake.restored(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares,
    "p8_targets": p8_targets,
    "p9_found": p9_found,
    "p9_restored": p9_restored,
}
SQL: dict[str, str] = {"p8_targets": P8_TARGETS_SQL}
