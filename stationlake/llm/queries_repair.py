"""Queries of the tokenizer, the repair of conversations and the spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.bpe import decode_ids, encode_texts
from stationlake.llm.conversations import damaged, repair_conversations
from stationlake.llm.registry import query, table
from stationlake.llm.shared import staged
from stationlake.llm.spelling import spelling_variants, vocabulary


def byte_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, byte_tokenizer_file()).drop("text")
    decoded = decode_ids(encoded, byte_tokenizer_file())
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


#: The cheapest repair by states row after row, with crc32 by its table.
OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bits
), keyed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, bits[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
         unnest(CASE k WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM keyed
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), steps(letter, p, q) AS (
  VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)
), inserts(p, q, c, e) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (2, 3, 3, 'I'),
         (3, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')
), edits AS (
  SELECT conv_id, i, p, p AS q, 4 AS c, 'D' AS e FROM judged, range(4) AS places(p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K' FROM judged JOIN steps ON letter = initial
  WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R' FROM judged, steps
  WHERE coalesce(fault, '') NOT IN ('blank', 'duplicate') AND letter <> 's'
), paths AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, q, {'cost': CAST(c AS BIGINT), 'audit': e} AS best
  FROM conversations, inserts WHERE p = 0
  UNION ALL
  SELECT paths.conv_id, paths.i + 1, n.q,
         min({'cost': CAST(best.cost + x.c + n.c AS BIGINT), 'audit': best.audit || x.e || n.e})
  FROM paths JOIN edits x ON x.conv_id IS NOT DISTINCT FROM paths.conv_id AND x.i = paths.i + 1 AND x.p = paths.q
  JOIN inserts n ON n.p = x.q GROUP BY paths.conv_id, paths.i + 1, n.q
), ends AS (
  SELECT conv_id, max(i) AS n FROM placed GROUP BY conv_id
), won AS (
  SELECT paths.conv_id, min(best) AS best FROM paths LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM paths.conv_id
  WHERE i = coalesce(n, 0) AND q IN (0, 3) GROUP BY paths.conv_id
), letters AS (
  SELECT conv_id, substr(best.audit, CAST(place AS INT), 1) AS e, place FROM (SELECT *, unnest(range(1, length(best.audit) + 1)) AS place FROM won)
), numbered AS (
  SELECT *, count(*) FILTER (WHERE e <> 'I') OVER w AS i, count(*) FILTER (WHERE e <> 'D') OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), kept AS (
  SELECT l.conv_id, place, e, o, CASE WHEN e <> 'I' THEN text ELSE '' END AS text, role, initial,
         max(CASE WHEN o = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS s
  FROM numbered l LEFT JOIN placed r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i WHERE e <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o + s) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY place) AS whole FROM kept GROUP BY conv_id
), faults AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
)
SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM won w LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@query(OP12_SQL)
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = repair_conversations(damaged(table(spark, sf_dir, "conversations")))
    return repaired.drop("n_rows")


@query()
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(staged(vocabulary(table(spark, sf_dir, "documents")), "vocabulary"))
