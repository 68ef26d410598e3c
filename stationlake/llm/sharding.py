"""A uniform random shuffle into shards of exact size, by a communication matrix.

The rows of a Parquet table are dealt in three steps. (1) How many rows each block of the table sends to
each shard is drawn first: the matrix is multivariate hypergeometric given the rows of the blocks and the
sizes of the shards, which is the law it has when all rows are shuffled together. (2) Each block
permutes its rows and deals them out along its line of the matrix: a row knows its place in the file, so
this needs no exchange. (3) Rows go to their shards, where they are permuted again.

Shard sizes are exact (at most one apart) and every assignment is equally likely. All draws come from
the seed, the block's number and the row's place, so a task that is run again deals the same.

Scale: the driver holds one line of ``shards`` counts per block of ``block_rows`` rows. There is one
exchange of whole rows. Inside a shard rows go to buckets by a random number; a bucket holds about ``bucket_rows``
rows, and slots are gapless because buckets are counted first. Neither step looks at the contents, so
copies, hot sources and keys have no effect.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import packed, shared_folder

BLOCK_ROWS = 1 << 20
BUCKET_ROWS = 1 << 14


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Successes in ``draws`` draws without replacement; populations may be of any size.

    By inversion over the support within 12 standard deviations and 50 of the mean (what lies outside has a
    probability below 1e-30).
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mean = draws * (good / total)
    spread = np.sqrt(max(mean * (bad / total) * (total - draws) / max(total - 1, 1), 0.0))
    low, high = max(low, int(mean - 12 * spread - 50)), min(high, int(mean + 12 * spread + 50))
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_p = np.concatenate(([0.0], np.cumsum(ratio)))
    p = np.cumsum(np.exp(log_p - log_p.max()))
    return low + int(np.searchsorted(p, rng.random() * p[-1], side="right"))


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(blocks: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Line i: how many rows block i sends to each shard; lines and columns add up to blocks and sizes."""
    matrix = np.zeros((len(blocks), len(sizes)), dtype=np.int64)
    rng, left = np.random.default_rng(seed), list(sizes)
    for i, rows in enumerate(blocks):
        rest = sum(left)
        for j, room in enumerate(left):
            rest -= room
            matrix[i, j] = taken = hypergeometric(rng, room, rest, rows)
            left[j] -= taken
            rows -= taken
    return matrix


def shard_table(
    spark: SparkSession,
    path: str,
    shards: int,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of the Parquet table at path with shard (0 to shards - 1) and slot (0, 1, ... in each shard).

    Rows are told apart by file and place, so repeated rows, nulls and empty or long texts need no care; an
    empty table gives an empty result. Columns of the table named like a result are replaced.
    """
    table = spark.read.parquet(path)
    place = packed(table.select("*"), "row").select(
        "row",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    ) if table.columns else table
    counted = (
        place.groupBy("file", F.expr(f"at div {block_rows}").alias("block"))
        .count().orderBy("file", "block").collect()
    )
    rows = sum(c["count"] for c in counted)
    sizes = shard_sizes(rows, shards)
    matrix = communication_matrix([c["count"] for c in counted], sizes, seed)
    lines = {(c["file"], c["block"]): (i, matrix[i]) for i, c in enumerate(counted)}
    known = spark.sparkContext.broadcast(lines)
    held: dict = {}

    def dealt(file: str, block: int) -> np.ndarray:
        if (file, block) not in held:
            held.clear()
            number, line = known.value[file, block]
            labels = np.repeat(np.arange(shards, dtype=np.int32), line)
            held[file, block] = np.random.default_rng([seed, number]).permutation(labels)
        return held[file, block]

    @F.pandas_udf("int")
    def shard_of(file: pd.Series, at: pd.Series) -> pd.Series:
        out = np.empty(len(at), dtype=np.int32)
        block, spot = np.divmod(at.to_numpy(), block_rows)
        for (name, number), index in pd.Series(np.arange(len(at))).groupby([file.to_numpy(), block]).groups.items():
            out[index] = dealt(name, int(number))[spot[index]]
        return pd.Series(out)

    buckets = max(1, -(-rows // (shards * bucket_rows)))
    rank = F.xxhash64(F.lit(seed), "file", "at")
    sent = place.select(
        "row",
        shard_of("file", "at").alias("shard"),
        F.pmod(F.shiftrightunsigned(rank, 20), F.lit(buckets)).cast("int").alias("bucket"),
        rank.alias("rank"),
        "file",
        "at",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sent.groupBy("shard", "bucket").count()
        .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("rank", "file", "at")
    placed = sent.withColumn("number", F.row_number().over(inside) - 1).join(offsets, ["shard", "bucket"])
    others = [F.col(f"row.`{c}`") for c in table.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*others, "shard", (F.col("offset") + F.col("number")).cast("long").alias("slot"))


def shard_frame(docs: DataFrame, shards: int, seed: int = 0, **sizes: int) -> DataFrame:
    """As shard_table, for rows that are not a table yet: they are written to the shared folder first."""
    path = shared_folder(docs.sparkSession, "to-shard")
    docs.write.parquet(path)
    return shard_table(docs.sparkSession, path, shards, seed, **sizes)
