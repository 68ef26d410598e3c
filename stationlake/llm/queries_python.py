"""Queries of the operators whose inner loops are numpy, pandas or Arrow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.language import fit, identify
from stationlake.llm.lm import score_texts
from stationlake.llm.near_duplicates import near_duplicates
from stationlake.llm.packing import pack_documents
from stationlake.llm.registry import query, table
from stationlake.llm.sharding import shard_table
from stationlake.llm.substrings import remove_repeats
from stationlake.llm.warc import archive_pages

SHARDS = 16
SEQUENCE = 2048


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard_table(spark, f"{sf_dir}/documents.parquet", SHARDS, seed=1)
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


OP4_SQL = """
WITH hashed AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, unhex(sha1(coalesce(html, ''))) AS digest FROM pages
), bits AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, digest,
         min(page_id) OVER (PARTITION BY digest) AS first FROM hashed
)
SELECT page_id, payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + CAST('0b' || substr(CAST(CAST(digest AS BIT) AS VARCHAR), 1 + 5 * i, 5) AS INT), 1), '' ORDER BY i)
        FROM range(32) AS places(i)) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""


@query(OP4_SQL)
def op4_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), SEQUENCE)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    trees = fit(docs.filter(~held_out))
    return identify(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, hash(list_slice(w, i, i + 19)) AS h, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY h, m ORDER BY doc_id, i) > 1
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 20)))) AS places FROM repeated GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed, unnest(w) AS word,
         generate_subscripts(w, 1) AS i, places
  FROM words LEFT JOIN gone USING (doc_id)
), joined AS (
  SELECT doc_id, any_value(n_removed) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE places IS NULL OR NOT list_contains(places, i)) AS text
  FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN joined USING (doc_id)
"""


@query(OP8_SQL)
def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"), size=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=90)


@query()
def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    trains = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    return score_texts(table(spark, sf_dir, "documents"), trains)
