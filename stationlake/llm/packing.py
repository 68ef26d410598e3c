"""Packing token pieces into sequences, by patterns fitted to the histogram of lengths.

Documents are turned into token ids, closed by an end id, and cut into pieces where they are longer than a
sequence. Only the histogram of piece lengths (one count per length) comes to the driver. There
all patterns of one to three lengths that fill a sequence exactly are listed, the repeat counts that
reproduce the histogram best are found by non-negative least squares, rounded down to whole numbers that
the histogram can pay for, and what is left over is packed best fit, longest first, in counts again.
Every piece then finds its place by its length and its number among the pieces of that length.

Scale: the plan's size depends on the sequence length, not on the data. Numbering pieces of one length is
done in blocks of measured count, so a length that a third of all pieces have is spread. Pieces are written once
to the shared folder; a rerun task reads the same numbers.
"""

from __future__ import annotations

import re
import struct
import zlib
from codecs import charmap_decode
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import slices, staged, thrifty

#: Pieces of one length that are numbered together.
BLOCK_PIECES = 50_000
#: Words whose ids a worker keeps at hand (half of them since the last turn-over), and the longest in bytes that is kept:
#: 100 to 130 MB. To learn a word again takes about as long as to look up ten.
CACHE_WORDS, KEPT_BYTES = 500_000, 48
#: Bytes of the tokenizer's byte-level alphabet, as characters of Latin-1: those that print stand for themselves, others for 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
HIDDEN = sorted(set(range(256)) - set(SHOWN))
ALPHABET = "".join(chr(b if b in SHOWN else 256 + HIDDEN.index(b)) for b in range(256))
#: Words whose parts are plain to see (letters of Latin-1, digits, signs that print), those of one part, and the parts.
LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[!-;=-@\\[-~{LETTERS}]+").fullmatch
ONE_PART = re.compile(f"[{LETTERS}]+").fullmatch
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+").findall
#: Words by which a tokenizer is tried: every plain character alone, between letters and twice, and the short forms.
TRIED = [f"{x}{c}{y}" for c in map(chr, range(33, 256)) if PLAIN(c) for x, y in (("", ""), ("th", "er"), ("", c), ("a'", "d"))]
TRIED += [f"{x}{y}" for x in ("it", "1", "$", "\u00c9t\u00e9") for y in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'x", "''s", "'l", ",.", "1'2")]
#: New words that the tokenizer is given at a time, and bytes of text that are held as words.
LEARNED_AT_ONCE, HELD_BYTES = 10_000, 2_000_000
#: A comma or full stop that ends a run of non-space characters. The sign comes first, so that the search looks for it alone.
CLOSING = re.compile(rb"([,.])(?<=[a-z0-9][,.])(?=[ \t-\r]|\Z)")


class WordIds:
    """Ids of a text, put together from the ids of its runs of non-space characters.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its runs.
    """

    def __init__(self, tokenizer_file: str) -> None:
        self.tokenizer, self.by_parts = tokenizer_of(tokenizer_file)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def learn(self, words: list[bytes]) -> None:
        """Add the ids of new words. Plain ones take the short way; of the others some at a time: the tokenizer's own
        results take a kilobyte a word."""
        rest = self.learn_plain(words) if self.by_parts else words
        for begin in range(0, len(rest), LEARNED_AT_ONCE):
            some = rest[begin : begin + LEARNED_AT_ONCE]
            texts = [w.decode("utf-8", "replace") for w in some]
            for word, one in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                self.known[word] = pack_ids(one.ids)

    def learn_plain(self, words: list[bytes]) -> list[bytes]:
        """Add the ids of words whose parts are plain to see; returns the others."""
        known, tokenize, rest = self.known, self.tokenizer.model.tokenize, []
        for word in words:
            if word.isalpha() and word.islower():  # ASCII letters
                known[word] = pack_ids([token.id for token in tokenize(word.decode())])
            elif ONE_PART(text := word.decode("utf-8", "replace")):
                known[word] = pack_ids([token.id for token in tokenize(shown(text.lower().encode()))])
            elif PLAIN(text):
                known[word] = pack_ids(plain_ids(tokenize, text))
            else:
                rest.append(word)
        return rest

    def of_texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of some texts as little-endian unsigned 32-bit numbers; new words are learned together.

        Lower case is part of the tokenizer; for ASCII it can be applied first. So can the cut before a comma or full
        stop that ends a run behind an ASCII letter or digit.
        """
        lists = [CLOSING.sub(rb" \1", text.lower()).split() for text in texts]
        words = set().union(*lists)
        # Words in use outlive a turn-over: they are looked up in both halves and put into the new one.
        if len(self.known) + len(words) > CACHE_WORDS // 2:
            self.older, self.known = self.known, {}
        new = words.difference(self.known)
        found = new.intersection(self.older)
        self.known.update(zip(found, map(self.older.__getitem__, found), strict=True))
        new -= found
        self.learn(list(new))
        ids = [b"".join(map(self.known.__getitem__, some)) for some in lists]
        for word in new:
            if len(word) > KEPT_BYTES:
                del self.known[word]
        if len(self.known) > CACHE_WORDS:  # of one very large text
            self.known = {}
        return ids

    def __call__(self, text: bytes) -> bytes:
        return self.of_texts([text])[0]


#: Of so few ids, as words have them.
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def pack_ids(ids: list[int]) -> bytes:
    return PACKERS[len(ids)](*ids) if len(ids) < len(PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


def shown(part: bytes) -> str:
    """Bytes in the tokenizer's alphabet."""
    return charmap_decode(part, "strict", ALPHABET)[0]


def plain_ids(tokenize, text: str) -> list[int]:
    """Ids of a plain word, given what a tokenizer's model makes of a part. The parts are cut here: the way through the
    whole tokenizer, which keeps track of every character, takes several times the time."""
    lowered = text.lower()
    parts = (lowered,) if ONE_PART(lowered) else PARTS(lowered)
    if not lowered.isascii():
        parts = [shown(part.encode()) for part in parts]
    return [token.id for part in parts for token in tokenize(part)]


@lru_cache(maxsize=1)
def tokenizer_of(tokenizer_file: str):
    """The tokenizer of this process, and whether it takes plain words by their parts; its size is the file's."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.encode_special_tokens = True
    encoded = tokenizer.encode_batch_fast(TRIED, add_special_tokens=False)
    return tokenizer, all(plain_ids(tokenizer.model.tokenize, t) == one.ids for t, one in zip(TRIED, encoded, strict=True))


@lru_cache(maxsize=1)
def words_of(tokenizer_file: str) -> WordIds:
    """The words this process knows, CACHE_WORDS at most: a task of 16 MB would else spend most of its time on learning them."""
    return WordIds(tokenizer_file)


def token_pieces(docs: DataFrame, key: str, text: str, tokenizer_file: str, length: int, end_id: int) -> DataFrame:
    """(key, piece, start, length, ids_crc32, tokens) of each row; a null text counts as empty."""
    kind = dict(docs.dtypes)[key]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_file)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in (part for b in batches for part in slices(b, b.schema.names[1], HELD_BYTES)):
            owners, pieces, starts, sizes, sums, values = [], [], [], [], [], []
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for row, ids in enumerate(words.of_texts(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    owners.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    sizes.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    values.append(part)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            tokens = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.frombuffer(b"".join(values), dtype="<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owners, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    tokens,
                ],
                names=["key", "piece", "start", "length", "ids_crc32", "tokens"],
            )

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(
        thrifty(cut), f"key {kind}, piece int, start long, length long, ids_crc32 long, tokens array<int>"
    )


def patterns_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All multisets of two or three of the lengths that add up to capacity; unused places are 0."""
    lengths = np.sort(lengths[lengths < capacity])
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    two = lengths[(2 * lengths >= capacity) & there[capacity - lengths]]
    found = [np.stack([two, capacity - two, np.zeros_like(two)], axis=1)]
    for a in lengths:  # a is the longest of three
        b = lengths[(lengths <= a) & (a + 2 * lengths >= capacity) & (a + lengths < capacity)]
        c = capacity - a - b
        fits = there[c] & (c > 0)
        found.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], axis=1))
    return np.concatenate(found).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts x of the patterns with least squares of (lengths used - histogram).

    Accelerated projected gradient; place 0 of the histogram stands for unused places and counts nothing.
    """
    if len(patterns) == 0:
        return np.zeros(0)
    bins, columns = len(histogram), patterns.T
    target = histogram.astype(np.float64)
    target[0] = 0.0

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(c, x, bins) for c in columns)
        total[0] = 0.0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[c] for c in columns)

    v = np.ones(len(patterns))  # the largest eigenvalue, by power iteration
    for _ in range(20):
        v = back(used(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1.0 / (1.05 * size)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(used(y) - target))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


def best_fit(histogram: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing in counts: {contents: how many sequences hold them}."""
    open_by_room: dict[int, Counter] = {}

    def put(contents: tuple[int, ...], count: int) -> None:
        room = capacity - sum(contents)
        open_by_room.setdefault(room, Counter())[contents] += count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = min((r for r in open_by_room if r >= length), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                    left %= each
                if left:
                    put((length,) * left, 1)
                    left = 0
                break
            group = open_by_room[room]
            contents, count = next(iter(group.items()))
            moved = min(count, left)
            group[contents] -= moved
            if not group[contents]:
                del group[contents]
                if not group:
                    del open_by_room[room]
            put((*contents, length), moved)
            left -= moved
    total: Counter = Counter()
    for group in open_by_room.values():
        total.update(group)
    return total


def plan_packing(histogram: dict[int, int], capacity: int) -> Counter:
    """{contents: how many sequences hold them}, which uses every counted length exactly."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan: Counter = Counter()
    if counts[capacity]:
        plan[(capacity,)] = int(counts[capacity])
        counts[capacity] = 0
    patterns = patterns_of(np.flatnonzero(counts), capacity)
    x = fit_counts(patterns, counts)
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        contents = tuple(int(v) for v in patterns[i] if v)
        need = Counter(contents)
        whole = min(int(x[i]), *(int(counts[v]) // m for v, m in need.items()))
        if whole > 0:
            plan[contents] += whole
            for v, m in need.items():
                counts[v] -= whole * m
    plan.update(best_fit({int(v): int(counts[v]) for v in np.flatnonzero(counts)}, capacity))
    return plan


def _places(plan: Counter, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """first: per length, where its numbers begin; then, sorted by number: begin, sequence, offset."""
    lengths, counts, sequences, offsets, base = [], [], [], [], 0
    for contents, repeats in sorted(plan.items()):
        offset = 0
        for length in contents:
            lengths.append(length)
            counts.append(repeats)
            sequences.append(base)
            offsets.append(offset)
            offset += length
        base += repeats
    order = np.argsort(np.array(lengths, dtype=np.int64), kind="stable")
    lengths, counts = np.array(lengths, dtype=np.int64)[order], np.array(counts, dtype=np.int64)[order]
    begin = np.cumsum(counts) - counts
    first = np.zeros(capacity + 1, dtype=np.int64)
    used, at = np.unique(lengths, return_index=True)
    first[used] = begin[at]
    return first, begin, np.array(sequences, dtype=np.int64)[order], np.array(offsets, dtype=np.int64)[order]


def pack_pieces(pieces: DataFrame, capacity: int, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """pieces (with a column length, 1 to capacity) with sequence_id and offset."""
    own = staged(pieces.withColumn("piece_row", F.monotonically_increasing_id()), "pieces")
    histogram = own.groupBy("length").count()
    found = {int(r["length"]): int(r["count"]) for r in histogram.collect()}
    first, begin, sequence, offset = _places(plan_packing(found, capacity), capacity)
    spark = pieces.sparkSession
    known = spark.sparkContext.broadcast((first, begin, sequence, offset))

    @F.pandas_udf("sequence_id long, offset long")
    def place_of(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        first, begin, sequence, offset = known.value
        at = first[length.to_numpy()] + number.to_numpy()
        slot = np.searchsorted(begin, at, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[slot] + (at - begin[slot]), "offset": offset[slot]})

    # At most one row per length: the size of this broadcast depends on the sequence length alone.
    blocks = F.ceil(F.col("count") / block_pieces).cast("int")
    sized = F.broadcast(histogram.select("length", blocks.alias("blocks")))
    dealt = own.join(sized, "length").withColumn(
        "block", F.pmod(F.xxhash64("piece_row"), F.col("blocks")).cast("int")
    )
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "block").count()
        .withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count")
    )
    inside = Window.partitionBy("length", "block").orderBy("piece_row")
    numbered = dealt.withColumn("inside", F.row_number().over(inside) - 1).join(starts, ["length", "block"])
    placed = numbered.withColumn("place", place_of("length", (F.col("before") + F.col("inside")).cast("long")))
    return placed.select(*[F.col(f"`{c}`") for c in pieces.columns], "place.*")


def pack_documents(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, tokens, sequence_id, offset.

    Only documents longer than a sequence are cut. A null or empty text is the end id alone. Each row is a document
    of its own, so repeated rows and null keys are packed like any other. No row of an empty table. Other columns of
    docs are not carried.
    """
    packed_rows = pack_pieces(token_pieces(docs, key, text, tokenizer_file, capacity, end_id), capacity)
    return packed_rows.withColumnRenamed("key", key)
