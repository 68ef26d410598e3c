"""A corpus pipeline: language, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes all documents its predecessor kept, and its result is written and read back before the next.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.language import fit, identify
from stationlake.llm.near_duplicates import near_duplicates
from stationlake.llm.packing import pack_documents
from stationlake.llm.phrases import decontaminate
from stationlake.llm.queries_python import SEQUENCE, tokenizer_file
from stationlake.llm.registry import table
from stationlake.llm.shared import staged
from stationlake.llm.substrings import remove_repeats

#: Bits per byte in the best language from which on a text counts as no language (alike bytes cost 8 and more).
MOST_BITS = 7.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; learned from their own labels. Null texts, texts without a letter, and
    those that no language explains go. Without any label nothing but those without a letter go."""
    judged = identify(docs, fit(docs))
    unknown = (F.col("lang_pred") == "und") & F.col("bits_per_byte").isNull()
    if docs.filter("lang IS NOT NULL AND text <> ''").isEmpty():
        unknown = ~F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    noise = F.coalesce(F.col("bits_per_byte") > MOST_BITS, F.lit(False))
    return judged.filter(~unknown & ~noise).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id. Rows without an id stay; equal rows are
    one; rows that share an id but not the text are told apart."""
    leaders = near_duplicates(docs, size=5, percent=80).filter("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(leaders, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of words that stand earlier in the corpus. A document that loses no
    word keeps its text as it is; one that loses all of them goes."""
    cut = remove_repeats(docs, size=20)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return (
        cut.filter("n_words = 0 OR n_removed < n_words")
        .withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*docs.columns)
    )


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of ten words of a benchmark item."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.filter("NOT contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place."""
    placed = pack_documents(docs, tokenizer_file(), SEQUENCE)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]

#: Tokenization has no SQL; the tests run the stages against plain versions of them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
