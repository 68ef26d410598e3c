"""What Python workers hold at a time."""

import ctypes
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationlake.llm import shared, substrings
from stationlake.llm.near_duplicates import SHINGLE_WORDS, Shingles


def test_rows_go_to_workers_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    rows = spark.range(0, 3000, numPartitions=1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    most = shared.staged(rows.mapInArrow(sizes, "bytes long"), "sizes").agg(F.max("bytes")).first()[0]
    assert most < 2 * shared.SLICE_BYTES
    assert spark.conf.get(name) == before


def test_words_remembered_are_bounded():
    shingles = Shingles(3)
    shingles(" ".join(map(str, range(250_000))).encode())
    assert len(shingles.known) <= SHINGLE_WORDS == 100_000


def resident():
    """MB of the process's own memory."""
    with open("/proc/self/status") as status:
        return int(re.search(r"RssAnon:\s+(\d+)", status.read())[1]) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="glibc only")
def test_workers_give_back_what_a_task_held():
    def run(batches):
        held = [bytes(5000) for _ in range(20_000)]
        top = [bytes(5000)]  # freed memory below what is still held stays with the C library
        yield from batches
        del held
        kept.extend(top)

    kept, before = [], resident()
    assert list(shared.thrifty(run)([1])) == [1]
    assert resident() < before + 30


def test_repeated_windows_are_found_in_little_memory():
    rng = np.random.default_rng(4)
    count = 300_000
    batch = pa.RecordBatch.from_pydict(
        {
            "doc_key": pa.array(range(300), pa.int64()), "mark": pa.array([0] * 300, pa.int32()),
            "text": [" ".join(map(str, row)) for row in rng.integers(0, 1000, (300, count // 300))],
        }
    )
    run = substrings._questions(20, 4)
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most / count < 75  # bytes a window


def test_first_windows_by_document_then_start():
    rng = np.random.default_rng(6)
    ids, starts = rng.integers(-3, 9, 2000), rng.integers(0, 9, 2000).astype(np.int32)
    hashes = rng.integers(0, 300, 2000).astype(np.uint64)
    first = {}
    for h, *place in zip(hashes.tolist(), ids.tolist(), starts.tolist(), strict=True):
        first[h] = min(first.get(h, place), place)
    expected = [i for i in range(2000) if [ids[i], starts[i]] != first[int(hashes[i])]]
    assert sorted(substrings._repeats(ids, starts, hashes).tolist()) == expected


def test_texts_are_cut_once(spark):
    docs = spark.createDataFrame([(1, "a b", None, None, 3)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.repeated_passages(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_shuffles_of_staged_rows_are_deleted(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"shuffle_\d+", files.mkString(" ")))

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(name)
    assert shared.staged(spark.range(100).repartition(3, "id"), "rows").count() == 100
    for _ in range(100):
        left = shuffles() - before
        if len(left) <= 1:  # that of the count
            break
        time.sleep(0.1)
    assert len(left) <= 1 and spark.conf.get(name) == setting
