"""Removal of repeated runs of words.

Every window of ``size`` words has a Rabin-Karp hash. A window is repeated when the same words also start earlier: in a
document of smaller id, or earlier in the same document. Words covered by a repeated window are removed; the repeated windows
of a document are merged into maximal intervals.

Which occurrence of a hash is the first is found by a shuffle on the hash, in packed form. A task gathers a few million
windows, keeps the first of each hash (of the others it knows already that they are repeated) and sends those, dealt
over buckets by hash, as arrays: 8 bytes of hash, and place and document as small differences. A bucket sorts what it has
got by hash, document and place, and answers with the places that are not first, packed and dealt over parts of the
documents. A part puts the places of a document together, and they meet the document by id and text.

Scale: a window that a third of all documents share reaches its bucket once per task, not once per document. Buckets
hold about BUCKET_WINDOWS windows, their number follows the input. Nothing is collected or broadcast. Two different windows
share a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.hashing import WordHashes, rabin_karp
from stationlake.llm.shared import packed, slices, staged, thrifty

#: Windows a task combines before it sends them, and windows of a bucket, about.
CHUNK_WINDOWS = 2_000_000
BUCKET_WINDOWS = 3_000_000
LAST_ID, LAST_START = (1 << 63) - 1, (1 << 31) - 1

PACKED = pa.schema(
    [("bucket", pa.int32())]
    + [(name, pa.binary()) for name in ("docs", "marks", "sizes", "sizes_more", "steps", "steps_more", "hashes")]
)
PACKED_SQL = "bucket int, " + ", ".join(f"{f.name} binary" for f in PACKED if f.name != "bucket")
ANSWER = pa.schema([("doc_key", pa.int64()), ("mark", pa.int32()), ("starts", pa.binary())])


def _small(values: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers from 0 on in a byte each; 255 stands for a larger one, which follows in the second part."""
    return np.minimum(values, 255).astype(np.uint8).tobytes(), values[values >= 255].astype("<u4").tobytes()


def _large(small: bytes, more: bytes) -> np.ndarray:
    values = np.frombuffer(small, np.uint8).astype(np.int64)
    values[values == 255] = np.frombuffer(more, "<u4")
    return values


def _pack(bucket: int, doc: np.ndarray, ids: np.ndarray, marks: np.ndarray, start: np.ndarray, hashes) -> tuple:
    """Windows in the order of (doc, start) as one row. doc: index into ids and marks."""
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    steps = np.diff(start, prepend=0)
    steps[first] = start[first]
    sizes = np.diff(np.append(first, len(doc)))
    there = doc[first]
    return (
        bucket, ids[there].tobytes(), marks[there].tobytes(), *_small(sizes), *_small(steps),
        b"" if hashes is None else hashes.tobytes(),
    )


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes, steps = _large(row["sizes"], row["sizes_more"]), _large(row["steps"], row["steps_more"])
    ends = np.cumsum(sizes)
    total = np.cumsum(steps)
    before = np.concatenate(([0], total[ends[:-1] - 1]))
    starts = total - np.repeat(before, sizes)
    ids, marks = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["marks"], "<i4")
    return np.repeat(ids, sizes), np.repeat(marks, sizes), starts.astype(np.int32), np.frombuffer(row["hashes"], "<u8")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows one by one: a packed row holds up to millions of windows."""
    return (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows))


def _firsts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """order, which sorts the hashes and keeps equal ones as they are; where in it each hash begins, and its number."""
    order = np.argsort(hashes, kind="stable").astype(np.int32)
    sorted_ = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
    return order, first, np.diff(np.append(first, len(order)))


def _repeats(ids: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows are not at the first (id, start) of their hash, as their indices."""
    order, first, sizes = _firsts(hashes)
    d = ids[order]
    later = d != np.repeat(np.minimum.reduceat(d, first), sizes)
    del d
    s = starts[order]
    s[later] = LAST_START
    later |= s != np.repeat(np.minimum.reduceat(s, first), sizes)
    return order[later]


def _questions(size: int, buckets: int):
    """Rows (doc_key, mark, text) to packed rows; buckets below 0: places that are known to be repeated."""

    def send(chunk: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple]:
        # Millions of windows: numbers of 32 bits, and what is done with is let go.
        chunk.sort(key=lambda x: x[0])
        ids = np.array([c[0] for c in chunk], dtype="<i8")
        marks = np.array([c[1] for c in chunk], dtype="<i4")
        counts = np.array([len(c[2]) for c in chunk])
        hashes = np.concatenate([c[2] for c in chunk])
        chunk.clear()
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        start = np.arange(len(doc), dtype=np.int32)
        start -= np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)
        # Documents are in order, so the first index of a hash is its first place (ties: equal rows).
        order, lead, sizes = _firsts(hashes)
        head = np.repeat(order[lead], sizes)
        same = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1])), dtype=np.int32)  # number of the id
        later = start[order] != start[head]
        later |= same[doc[order]] != same[doc[head]]
        again = np.zeros(len(hashes), dtype=bool)
        again[order] = later
        del order, head, later
        if again.any():
            yield _pack(-1 - int(ids[0] % buckets), doc[again], ids, marks, start[again], None)
        # Equal rows at the first place all ask, so that each gets its answer.
        ask = np.flatnonzero(~again).astype(np.int32)
        bucket = ((hashes[ask] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
        dealt = np.argsort(bucket, kind="stable").astype(np.int32)
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(bucket[dealt]) != 0)))
        for begin, end in zip(cuts, np.append(cuts[1:], len(dealt)), strict=True):
            part = ask[dealt[begin:end]]
            yield _pack(int(bucket[dealt[begin]]), doc[part], ids, marks, start[part], hashes[part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk, windows = WordHashes(), [], 0
        for batch in (part for b in batches for part in slices(b, "text")):
            for key, mark, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                batch.column(2).cast(pa.binary()).to_pylist(), strict=True,
            ):
                hashes = rabin_karp(known.of(text.split()), size)
                if len(hashes):
                    chunk.append((key, mark, hashes))
                    windows += len(hashes)
                if windows >= CHUNK_WINDOWS:
                    for row in send(chunk):
                        yield _batch([row], PACKED)
                    windows = 0
        if chunk:
            for row in send(chunk):
                yield _batch([row], PACKED)

    return run


def _ordered(ids: np.ndarray, marks: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places in the order of (id, mark, start), each once, and where a new document begins."""
    order = np.lexsort((starts, marks, ids))
    ids, marks, starts = ids[order], marks[order], starts[order]
    new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])))
    once = new | np.concatenate(([True], starts[1:] != starts[:-1]))
    return ids[once], marks[once], starts[once], new[once]


def _part(ids: np.ndarray, marks: np.ndarray, parts: int) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= marks.astype(np.int64).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def _answers(parts: int):
    """Packed rows sorted by bucket to packed places that are repeated; their bucket is a part of the documents."""

    def told(ids: np.ndarray, marks: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, marks, starts, new = _ordered(ids, marks, starts)
        there = np.flatnonzero(new)
        doc = np.cumsum(new) - 1
        part = _part(ids[there], marks[there], parts)[doc]
        dealt = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(part[dealt]) != 0)))
        for begin, end in zip(cuts, np.append(cuts[1:], len(dealt)), strict=True):
            some = dealt[begin:end]
            row = _pack(int(part[some[0]]), doc[some], ids[there], marks[there], starts[some], None)
            yield _batch([row], PACKED)

    def closed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = zip(*held, strict=True)
        held.clear()
        ids, marks, starts, hashes = (np.concatenate(c) for c in columns)
        found = _repeats(ids, starts, hashes)
        del hashes
        if len(found):
            yield from told(ids[found], marks[found], starts[found])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = [], None
        for batch in batches:
            for row in _rows(batch):
                if row["bucket"] < 0:
                    yield from told(*_unpack(row)[:3])
                    continue
                if row["bucket"] != bucket and held:
                    yield from closed(held)
                bucket = row["bucket"]
                held.append(_unpack(row))
        if held:
            yield from closed(held)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed places sorted by part to one row (doc_key, mark, places) for each document."""

    def closed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, marks, starts, new = _ordered(*(np.concatenate(c) for c in zip(*held, strict=True)))
        cuts = np.append(np.flatnonzero(new), len(ids))
        raw = starts.astype("<u4").tobytes()
        for begin in range(0, len(cuts) - 1, 5000):
            some = cuts[begin : begin + 5001]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[some[:-1]], pa.int64()),
                    pa.array(marks[some[:-1]], pa.int32()),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(some[:-1], some[1:], strict=True)], pa.binary()),
                ],
                schema=ANSWER,
            )

    held, part = [], None
    for batch in batches:
        for row in _rows(batch):
            if row["bucket"] != part and held:
                yield from closed(held)
                held = []
            part = row["bucket"]
            held.append(_unpack(row)[:3])
    if held:
        yield from closed(held)


def repeated_windows(docs: DataFrame, size: int, buckets: int | None = None) -> DataFrame:
    """(doc_key, mark, starts) from rows (doc_key, mark, text): the places of repeated windows, as
    an array of little-endian 32-bit numbers; one row per document that has any."""
    if buckets is None:
        octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(1, -(-octets // (6 * BUCKET_WINDOWS)))
    return (
        docs.mapInArrow(thrifty(_questions(size, buckets)), PACKED_SQL)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(thrifty(_answers(buckets)), PACKED_SQL)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(thrifty(_gathered), "doc_key long, mark int, starts binary")
    )


def remove_repeats(
    docs: DataFrame, size: int = 20, key: str = "doc_id", text: str = "text", buckets: int | None = None
) -> DataFrame:
    """docs with n_words, n_removed, kept (the words left, joined by one space) and spans.

    spans are the removed intervals [start, end) in words. key is a whole number; rows with one key count as the
    same document, and equal places of it are not earlier than each other, so equal rows get equal results. A
    null key comes after all others. A null or empty text has no words. Columns of docs named like a result are replaced.
    """
    results = ("n_words", "n_removed", "kept", "spans")
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    rows = packed(docs, "row").select(
        "row",
        F.coalesce(F.col(f"row.`{key}`").cast("long"), F.lit(LAST_ID)).alias("doc_key"),
        F.hash(body).alias("mark"),  # tells rows of one key apart
        body.alias("text"),
    )
    found = staged(repeated_windows(rows.select("doc_key", "mark", "text"), size, buckets), "repeated")

    @F.arrow_udf("n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>")
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        totals, removed, kept, spans = [], [], [], []
        for value, place in zip(texts.cast(pa.binary()).to_pylist(), places.to_pylist(), strict=True):
            words = value.split()
            gone: list[dict] = []
            if place:
                change = np.zeros(len(words) + 1, dtype=np.int64)
                starts = np.frombuffer(place, "<u4")
                change[starts] += 1
                change[starts + size] -= 1
                covered = np.cumsum(change)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
                gone = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                left, at = [], 0
                for span in gone:
                    left += words[at : span["start"]]
                    at = span["end"]
                left += words[at:]
            else:
                left = words
            totals.append(len(words))
            removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
            spans.append(gone)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.StructArray.from_arrays(
            [
                pa.array(totals, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array(spans, kind),
            ],
            names=list(results),
        )

    # A filter on the results would be moved below them, and texts be cut once for it and once more for the rows it keeps.
    once = cut.asNondeterministic()
    done = rows.join(found, ["doc_key", "mark"], "left").withColumn("cut", once("text", "starts"))
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in results]
    return done.select(*others, "cut.*")
