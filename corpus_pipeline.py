"""From raw documents to tokens: quality rules, line dedup, near duplicates, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result is written
as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import bpe, decontamination, line_dedup, parity_join, quality_rules
from tidelake.llm.queries import TOKENIZER_FILE
from tidelake.llm.tables import table, written

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled cutoffs keep."""
    return quality_rules.kept_only(docs.select(*DOCUMENT), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the repeated lines; those of which nothing is left go."""
    cleaned = line_dedup.dedup_lines(docs.select(*DOCUMENT))
    emptied = (F.col("n_dropped") > 0) & (F.trim("text") == "")
    return cleaned.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, and all documents in none.

    Documents without an id stay. Of rows that repeat both id and text one stays; of rows of one id with
    several texts each goes or stays by its own text.
    """
    docs = docs.select(*DOCUMENT).withColumn("_version", F.xxhash64("text"))
    groups = parity_join.grouped(docs.select("doc_id", "text"))
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("_doc"), F.col("version").alias("_gone")).distinct()
    kept = docs.join(gone, (F.col("doc_id") == F.col("_doc")) & (F.col("_version") == F.col("_gone")), "left_anti")
    named = kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return named.unionByName(kept.where("doc_id IS NULL")).select(*DOCUMENT)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontamination.without_leaks(docs.select(*DOCUMENT), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    coded = bpe.encode_decode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER_FILE)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express SimHash candidates or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
