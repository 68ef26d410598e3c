"""Near duplicates by Jaccard similarity of word shingles, through a count-vector R-tree.

The elements of a document's set (hashes of its distinct shingles) are counted in a few hash groups; the counts are a
point, and the sum of the smaller coordinates of two points bounds what the sets can share. An R-tree over points finds
the pairs whose bound allows a link (see ``rtree``). A few groups tell little about large sets, and nothing about copies that
are almost similar enough; what the tree finds is therefore tested on finer groups, as many as the set needs, of which
only the parity of the count is kept. What is left is verified on the sets themselves.

One tree over all points would be one task, and trees over parts of the points would have to be joined part with part. So the
top level of the index is made of slabs. Elements are ordered, those of rare groups first, and a set lies in the slab of
each of its first ``n - ceil(percent * n / 100) + 1`` elements: two sets that link share one of those. A slab is cut where the
sizes of its sets leave a gap that no link spans, and slabs with the same sets are one slab. Within a slab a tree is built and joined; a very large slab is cut into blocks, and each pair of blocks
is joined.

Links are only needed as far as they connect, so the join runs twice. First every point is verified against one of
its candidates in each slab (the smallest), and what links is merged. Then all candidates that still lie in different components
are verified: none is left out, but a group of thousands of copies does not cost the square of its size.

Equal sets are one point from the beginning. Sets are never shipped with the slabs: only candidates' texts are
read again. Elements are 64-bit hashes, as are names of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.graph import components
from stationlake.llm.hashing import WordHashes, mixed, rabin_karp
from stationlake.llm.rtree import Parities, RTree, join, least_shared
from stationlake.llm.shared import small_batches, staged, thrifty

#: Groups of the points, and of the frequencies that order the elements.
GROUPS = 128
FREQUENCY_GROUPS = 1 << 15
#: Finer groups per element, and how many there are at least and at most (powers of two); a bit each.
FINE_GROUPS, LEAST_FINE, MOST_FINE = 2, 1 << 9, 1 << 17
#: Words whose hash a task keeps at hand; a worker does not give back all of their memory when its task ends.
SHINGLE_WORDS = 100_000
#: Sets of a slab that one tree holds.
BLOCK_SETS = 4096
#: Links verified against one copy of a set.
CENTRE_LINKS = 5000


class Shingles:
    """The set of a text: sorted distinct hashes of its runs of ``size`` words, A-Z in lower case."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, WordHashes(SHINGLE_WORDS)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = self.known.of((text or b"").lower().split())
        if len(words) == 0:
            return np.empty(0, dtype=np.uint64)
        if len(words) < self.size:
            # A shorter text is one run, kept apart from shorter runs of other lengths.
            return mixed(rabin_karp(words, len(words)) + np.uint64(len(words)))
        return np.unique(rabin_karp(words, self.size))


def set_name(elements: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.frombuffer(xxhash.xxh3_64_digest(elements.tobytes()), ">i8")[0])


def _point_bytes(counts: np.ndarray) -> bytes:
    """A point in one byte per group where that is enough, else in four."""
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def _parity_bytes(elements: np.ndarray) -> bytes:
    """The parities of the finer groups' counts; the number of groups is the next power of two."""
    groups = min(max(LEAST_FINE, 1 << (FINE_GROUPS * len(elements) - 1).bit_length()), MOST_FINE)
    at = ((elements >> np.uint64(40)) & np.uint64(groups - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=groups) & 1, bitorder="little").tobytes()


def _points_of(rows: list[bytes]) -> np.ndarray:
    if all(len(r) == GROUPS for r in rows):
        return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), GROUPS)
    return np.stack([np.frombuffer(r, np.uint8 if len(r) == GROUPS else "<u4").astype(np.uint32) for r in rows])


def _frequencies(docs: DataFrame, size: int) -> np.ndarray:
    """How many elements of all sets fall into each frequency group; whole sets of all rows are counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, total = Shingles(size), np.zeros(FREQUENCY_GROUPS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found = shingles(text)
                total += np.bincount((found % np.uint64(FREQUENCY_GROUPS)).astype(np.int64), minlength=FREQUENCY_GROUPS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"slot": there.astype(np.int32), "n": total[there]},
            schema=pa.schema([("slot", pa.int32()), ("n", pa.int64())]),
        )

    counts = np.zeros(FREQUENCY_GROUPS, dtype=np.int64)
    # One row per group at most.
    with small_batches(docs.sparkSession):
        slots = docs.select("text").mapInArrow(thrifty(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    for row in slots:
        counts[row["slot"]] = row["n"]
    return counts


def _points(docs: DataFrame, size: int, percent: int, frequency: np.ndarray) -> DataFrame:
    """(doc_id, n, node, counts, parities, keys): the set's size and name, its point, finer groups, and its slabs."""
    known = docs.sparkSession.sparkContext.broadcast(frequency)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("counts", pa.binary()),
            ("parities", pa.binary()), ("keys", pa.list_(pa.int64())),
        ]
    )

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, often = Shingles(size), known.value
        for batch in batches:
            sizes, names, counts, parities, keys = [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                found = shingles(text)
                n = len(found)
                sizes.append(n)
                names.append(set_name(found))
                counts.append(_point_bytes(np.bincount((found >> np.uint64(32)).astype(np.int64) % GROUPS, minlength=GROUPS)))
                parities.append(_parity_bytes(found))
                rank = often[(found % np.uint64(FREQUENCY_GROUPS)).astype(np.int64)]
                least = -(-percent * n // 100)  # what any partner has to share
                first = n - least + 1 if n else 0
                keys.append(found[np.lexsort((found, rank))[:first]].view(np.int64))
            lengths = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(counts, pa.binary()),
                    pa.array(parities, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                ],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(
        thrifty(point), "doc_id long, n long, node long, counts binary, parities binary, keys array<long>"
    )


def _slabs(points: DataFrame, percent: int) -> DataFrame:
    """(slab, node) of slabs with at least two sets; slabs of the same sets are one.

    Of sets in the order of their sizes, those before and after a gap are too different to link: they are slabs apart.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("slab", pa.int64()), ("node", pa.int64())])
        held_key, held_n, held = (np.empty(0, np.int64) for _ in range(3))

        def out(key: np.ndarray, n: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
            apart = (key[1:] != key[:-1]) | (100 * n[:-1] < percent * n[1:])
            cuts = np.flatnonzero(np.concatenate(([True], apart)))
            sizes = np.diff(np.append(cuts, len(key)))
            many = sizes > 1
            if many.any():
                raw = node.tobytes()
                names = [set_name_bytes(raw[8 * a : 8 * (a + s)]) for a, s in zip(cuts[many], sizes[many], strict=True)]
                keep = np.repeat(many, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(names, np.int64), sizes[many])), pa.array(node[keep])], schema=schema
                )

        for batch in batches:
            key = np.concatenate((held_key, batch.column(0).to_numpy()))
            n = np.concatenate((held_n, batch.column(1).to_numpy()))
            node = np.concatenate((held, batch.column(2).to_numpy()))
            # The last key may go on in the next batch.
            end = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if end:
                yield from out(key[:end], n[:end], node[:end])
            held_key, held_n, held = key[end:], n[end:], node[end:]
        if len(held_key):
            yield from out(held_key, held_n, held)

    keys = points.select(F.explode("keys").alias("key"), "n", "node")
    return (
        keys.repartition("key").sortWithinPartitions("key", "n", "node")
        .mapInArrow(thrifty(merge), "slab long, node long")
        .distinct()
    )


def set_name_bytes(raw: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(raw), "big", signed=True)


def _dealt(slabs: DataFrame, points: DataFrame, block_sets: int) -> DataFrame:
    """(slab, low, high, block, node, n, counts, parities): each pair of blocks of a slab, with the points of both."""
    large = (
        slabs.groupBy("slab").count().filter(F.col("count") > block_sets)
        .select("slab", F.ceil(F.col("count") / block_sets).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int")
    placed = slabs.join(large, "slab", "left").withColumn("block", block)
    others = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return (
        placed.withColumn("other", others)
        .select("slab", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node")
        .join(points.select("node", "n", "counts", "parities"), "node")
    )


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _candidates(dealt: DataFrame, percent: int, all_pairs: bool) -> DataFrame:
    """Distinct (a, b), a < b, whose points allow a link and whose components differ.

    all_pairs: every one; else for each set and slab the smallest other set.
    """

    def one(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
        node, n, component = rows["node"], rows["n"], rows["component"]
        if (component == component[0]).all():
            return None
        counts = _points_of(rows["counts"])
        low = np.flatnonzero(rows["block"] == rows["low"][0])
        high = np.flatnonzero(rows["block"] != rows["low"][0])
        within = rows["low"][0] == rows["high"][0]
        n = n.astype(np.int64)
        if len(low) == 0 or not (within or len(high)):
            return None
        tree = RTree(n[low], counts[low])
        if within:
            pairs = ((low[i], low[j]) for i, j in join(tree, tree, percent))
        else:
            pairs = ((low[i], high[j]) for i, j in join(tree, RTree(n[high], counts[high]), percent))
        parities = Parities(rows["parities"])
        best = np.full(len(node), len(node), dtype=np.int64)  # points come sorted by node
        found = []
        for i, j in pairs:
            differ = component[i] != component[j]
            i, j = i[differ], j[differ]
            fits = n[i] + n[j] - parities.differences(i, j) >= 2 * least_shared(n[i], n[j], percent)
            i, j = i[fits], j[fits]
            if all_pairs:
                found.append((i, j))
            else:
                np.minimum.at(best, np.maximum(i, j), np.minimum(i, j))
        if not all_pairs:
            there = np.flatnonzero(best < len(node))
            return node[best[there]], node[there]
        if not found:
            return None
        i, j = (np.concatenate(c) for c in zip(*found, strict=True))
        return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def groups(table: pa.Table, last: bool) -> tuple[list[dict], pa.Table | None]:
            ids = [table.column(c).to_numpy() for c in ("slab", "low", "high")]
            if len(ids[0]) == 0:
                return [], None
            new = np.concatenate(([True], np.any([c[1:] != c[:-1] for c in ids], axis=0)))
            cuts = np.append(np.flatnonzero(new), len(new))
            done = len(cuts) - 1 if last else len(cuts) - 2
            columns = {
                c: table.column(c).to_pylist() if c in ("counts", "parities") else table.column(c).to_numpy()
                for c in table.column_names
            }
            made = [{c: v[cuts[k] : cuts[k + 1]] for c, v in columns.items()} for k in range(done)]
            return made, None if last else table.slice(cuts[done])

        def answer(made: list[dict]) -> Iterator[pa.RecordBatch]:
            parts = [p for p in map(one, made) if p is not None]
            if parts:
                a, b = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=PAIR)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            made, held = groups(held, False)
            yield from answer(made)
        if held is not None:
            yield from answer(groups(held, True)[0])

    return (
        dealt.repartition("slab", "low", "high")
        .sortWithinPartitions("slab", "low", "high", "node")
        .select("slab", "low", "high", "block", "node", "n", "component", "counts", "parities")
        .mapInArrow(thrifty(run), "a long, b long")
        .distinct()
    )


def _verified(pairs: DataFrame, points: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity, counted on the sets of their texts.

    Each set travels to the pairs it is the second of, and meets there one copy of the first per CENTRE_LINKS pairs.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / CENTRE_LINKS).cast("int").alias("parts"))
    dealt = pairs.join(degree, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    first = points.join(wanted, "node", "left_semi").select("node", "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            names, found = [], []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                elements = shingles(text)
                if set_name(elements) == node:  # rows that share an id may have other texts
                    names.append(node)
                    found.append(elements.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(found, pa.binary())],
                schema=pa.schema([("node", pa.int64()), ("elements", pa.binary())]),
            )

    known = staged(
        docs.join(first, "doc_id").select("node", "text")
        .mapInArrow(thrifty(sets), "node long, elements binary").dropDuplicates(["node"]),
        "sets",
    )
    centres = dealt.select("a", "part").distinct().join(known.withColumnRenamed("node", "a"), "a")
    ends = dealt.join(known.withColumnRenamed("node", "b"), "b")
    rows = centres.select("a", "part", F.lit(None).cast("long").alias("b"), "elements").unionByName(
        ends.select("a", "part", "b", "elements")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            a, b = [], []
            for one, other, raw in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                elements = np.frombuffer(raw, np.uint64)
                if other is None:
                    centre = elements
                    continue
                shared = len(np.intersect1d(centre, elements, assume_unique=True))
                if shared >= least_shared(len(centre), len(elements), percent):
                    a.append(one)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=PAIR)

    return (
        rows.repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
        .mapInArrow(thrifty(verify), "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """(key, n_shingles, component_id) for every row of docs.

    component_id is the smallest key reachable over links; two rows link when their sets of shingles of ``size`` words
    have a Jaccard similarity of percent / 100 or more. A text of fewer words is one shingle; a null text, or one without
    words, has an empty set and is linked with nothing. Equal texts have equal sets. key is a whole number; rows with the
    same key and text get the same result; a row with a null key has a null component_id and is linked with nothing.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    every = staged(_points(rows, size, percent, _frequencies(rows, size)), "points")
    linked = every.filter("n > 0 AND doc_id IS NOT NULL")
    # One point per set, under its smallest key.
    points = staged(
        linked.groupBy("node").agg(F.min(F.struct("doc_id", "n", "counts", "parities", "keys")).alias("p")).select("node", "p.*"),
        "sets-once",
    )
    slabs = _slabs(points, percent)
    dealt = staged(_dealt(staged(slabs, "slabs"), points, block_sets), "trees")
    once = staged(_candidates(dealt.withColumn("component", F.col("node")), percent, all_pairs=False), "candidates")
    links = staged(_verified(once, points, rows, size, percent), "links-once")
    merged = components(links, "a", "b")
    labelled = dealt.join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = staged(_candidates(labelled, percent, all_pairs=True).join(once, ["a", "b"], "left_anti"), "candidates")
    more = _verified(rest, points, rows, size, percent)
    classes = components(links.unionByName(more), "a", "b")
    named = points.select("node", "doc_id").join(classes, "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = named.join(smallest, "component").select("node", "component_id")
    alone = every.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", "n", F.col("doc_id").alias("component_id")
    )
    found = linked.select("doc_id", "n", "node").join(by_set, "node").select("doc_id", "n", "component_id")
    return found.unionByName(alone).select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id")
