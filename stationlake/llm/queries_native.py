"""Queries of the operators that are DataFrame plans from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm.phrases import decontaminate
from stationlake.llm.quality import judge_quality
from stationlake.llm.registry import query, table
from stationlake.llm.url_rules import judge_urls

#: Host, path and verdict of the rules.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), split AS (
  SELECT page_id,
         coalesce({LOWER_SQL.format("regexp_extract(rest, '^[^/?#]*')")}, '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, host, path, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(r_host || r_path) DESC NULLS LAST) AS place
  FROM split LEFT JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), base AS (
  SELECT doc_id, len(w) AS n_words, len(list_distinct(lines)) AS n_different, len(lines) AS n_lines,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols
  FROM words
), windows AS (
  SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS three
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), measured AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_lines - n_different AS n_dup_lines, n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 50 * n_words
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 100 * n_dup_lines > 40 * n_lines) AS kept
FROM measured
"""

OP9_WORDS = (
    r"list_filter(regexp_split_to_array(" + LOWER_SQL.format("coalesce(text, '')")
    + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)
OP9_SQL = f"""
WITH items AS (
  SELECT item_id, {OP9_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, list_slice(w, i, least(i + 9, len(w))) AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(phrase) AS size FROM windows
), docs AS (
  SELECT doc_id, {OP9_WORDS} AS w FROM documents
), places AS (
  SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)
), hits AS (
  SELECT doc_id, item, i, size FROM places JOIN windows USING (phrase)
), hit_words AS (
  SELECT doc_id, count(DISTINCT word_at) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word_at FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query(OP2_SQL)
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(OP3_SQL)
def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = judge_quality(table(spark, sf_dir, "documents"), complete=shown)
    base = F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    return judged.select("doc_id", *shown, base.alias("base_failed"), "kept")


@query(OP9_SQL)
def op9_benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )
