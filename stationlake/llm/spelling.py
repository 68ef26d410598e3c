"""Words of a corpus grouped with their spelling variants: near words, the form a word stands for, and its root.

Two words are near when one inserted, deleted or replaced letter makes one out of the other. Such words agree in the whole
first half or in the whole second half of either. So a word is searched twice in an FM-index of the delimited vocabulary:
its first half is matched exactly from the word's beginning and extended to the right with one error, its second
half from the word's end and extended to the left. An index for one direction is that of the words, for the other that of the
words reversed; an interval of suffix ranks stands for all words that go on from what was matched. While an interval
holds many words it is extended letter by letter, with an error tried at each place; once it is down to a few, these are
compared with the word itself.

Scale: the vocabulary is counted in Spark. Since halves have three letters at least (half the shortest word), words that can
be near share their first three or their last three; each word goes to those two shards, and a task indexes some
shards at a time, ``BLOCK_WORDS`` words or a little more. A shard with more than ``SHARD_WORDS`` words is cut into blocks of
which each is an index of its own, and its words are searched in all of them. What leaves a task is one row per word, not
the pairs. Forms are followed to the root in as many joins as the longest chain has links; as a form has at least ten times its
word's occurrences, that is fewer than the digits of the largest count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.shared import lower_ascii, staged

#: Fixed value: the letters of a run.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
#: Words indexed together, and from which on a shard is cut into several indexes.
BLOCK_WORDS, SHARD_WORDS = 60_000, 200_000
#: Intervals of up to this many words are compared word by word.
FEW = 16
#: States that are extended by all letters at a time.
STATES_AT_ONCE = 20_000


class Sequences:
    """Words as one array of code points."""

    def __init__(self, words: list[str]) -> None:
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def letter(self, which: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        return self.points[self.begins[which] + place]


class SuffixRanks:
    """FM-index of sorted, distinct words in the text ``$ word $ word $ … $``, read from the right to the left.

    Delimiters rank by their number, so rank j below the number of words is that of the delimiter before word j. A state is
    an interval [low, high) of suffix ranks; a step puts a letter before what was matched.
    """

    def __init__(self, words: list[str]) -> None:
        sequences = Sequences(words)
        self.alphabet = np.unique(sequences.points)
        n, size = len(words), len(sequences.points) + len(words) + 1
        text = np.zeros(size, dtype=np.int64)
        delimiters = np.concatenate((sequences.begins, [len(sequences.points)])) + np.arange(n + 1)
        inner = np.ones(size, dtype=bool)
        inner[delimiters] = False
        text[inner] = np.searchsorted(self.alphabet, sequences.points) + 1
        #: Letters to the end of the word; 0 at a delimiter.
        left = np.repeat(delimiters[1:], np.diff(delimiters))
        left = np.concatenate((left, [size - 1])) - np.arange(size)
        left[delimiters] = 0
        ranks = self._order(text, left)
        owner = np.cumsum(~inner) - 1
        before = text[ranks - 1]
        self.unknown = len(self.alphabet) + 2
        before[0] = self.unknown - 1  # nothing stands before the first delimiter
        self.size = size
        self.owner = np.minimum(owner[ranks], n - 1).astype(np.int32)
        self.keys = np.sort(before * np.int64(size) + np.arange(size))
        self.start = (0, n + 1)

    @staticmethod
    def _order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Suffixes in order: letters up to the delimiter, then the place."""
        size = len(text)
        width, ranked = 1, text
        bits = max(1, int(text.max()).bit_length())
        packed = text.copy()
        while (width * 2) * bits <= 62:
            shifted = np.zeros_like(packed)
            shifted[: size - width] = packed[width:]
            packed = (packed << (width * bits)) | np.where(left >= width, shifted, 0)
            width *= 2
        ranked = packed
        while True:
            order = np.argsort(ranked, kind="stable")
            ordered = ranked[order]
            fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            tied = np.concatenate((ordered[1:] == ordered[:-1], [False]))
            if not (tied & (left[order] >= width)).any():
                return order
            rank = np.empty(size, dtype=np.int64)
            rank[order] = fresh + 1
            shifted = np.zeros(size, dtype=np.int64)
            shifted[: size - width] = rank[width:]
            ranked = rank * np.int64(size + 2) + np.where(left >= width, shifted, 0)
            width *= 2

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Letters of the index for code points; ``unknown`` for those that no word has."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, self.unknown)

    def step(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code * np.int64(self.size)
        more = (code > 0).astype(np.int64)  # the first delimiter has no place among the keys
        return np.searchsorted(self.keys, base + low) + more, np.searchsorted(self.keys, base + high) + more


def _agree(
    a: Sequences, b: Sequences, x: np.ndarray, y: np.ndarray, at: np.ndarray, beside: np.ndarray, most: np.ndarray
) -> np.ndarray:
    """How many letters of a[x] from ``at`` agree with those of b[y] from ``beside``, ``most`` at most."""
    agreed = np.zeros(len(x), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    while len(live):
        done = agreed[live]
        same = a.letter(x[live], at[live] + done) == b.letter(y[live], beside[live] + done)
        live = live[same]
        agreed[live] += 1
        live = live[agreed[live] < most[live]]
    return agreed


def _near(a: Sequences, b: Sequences, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether a[x] and b[y] are one edit apart."""
    size, other = a.sizes[x], b.sizes[y]
    zero = np.zeros(len(x), dtype=np.int64)
    shorter = np.minimum(size, other)
    begin = _agree(a, b, x, y, zero, zero, shorter)
    at = np.minimum(begin + (size >= other), size)
    beside = np.minimum(begin + (other >= size), other)
    rest = size - at
    fits = (np.abs(size - other) <= 1) & ((size != other) | (begin < size)) & (rest == other - beside)
    return fits & (_agree(a, b, x, y, at, beside, np.where(fits, rest, 0)) >= rest)


def _exactly(
    index: SuffixRanks, asked: Sequences, codes: np.ndarray, q: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) where the rest of the query from ``at`` and the delimiter follow a state."""
    found_q, found_x = [], []
    while len(q):
        ends = at >= asked.sizes[q]
        code = np.zeros(len(q), dtype=np.int64)
        code[~ends] = codes[asked.begins[q[~ends]] + at[~ends]]
        low, high = index.step(code, low, high)
        there = low < high
        found_q.append(q[ends & there])
        found_x.append(low[ends & there])
        on = there & ~ends
        q, at, low, high = q[on], at[on] + 1, low[on], high[on]
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *found_q]), np.concatenate([empty, *found_x])


def search(words: Sequences, index: SuffixRanks, asked: Sequences, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (query, word) with ``exact`` leading letters in common and one edit in the rest, each once.

    ``words`` are the sequences whose reversals are indexed, in the order of the index.
    """
    codes = index.codes(asked.points) if len(asked.points) else asked.points
    q = np.arange(len(asked))
    low = np.full(len(q), index.start[0], dtype=np.int64)
    high = np.full(len(q), index.start[1], dtype=np.int64)
    for place in range(int(exact.max(initial=0))):
        on = np.flatnonzero((exact > place) & (low < high))
        low[on], high[on] = index.step(codes[asked.begins[on] + place], low[on], high[on])
    at = exact.copy()
    pairs_q, pairs_x = [], []
    letters = np.arange(1, len(index.alphabet) + 1)

    def keep(found: tuple[np.ndarray, np.ndarray]) -> None:
        pairs_q.append(found[0])
        pairs_x.append(found[1])

    while True:
        there = low < high
        q, at, low, high = q[there], at[there], low[there], high[there]
        few = high - low <= FEW
        counts = (high - low)[few]
        held = np.repeat(q[few], counts)
        rank = np.repeat(low[few] - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        owner = index.owner[rank].astype(np.int64)
        near = _near(asked, words, held, owner)
        keep((held[near], owner[near]))
        q, at, low, high = q[~few], at[~few], low[~few], high[~few]
        if not len(q):
            break
        for begin in range(0, len(q), STATES_AT_ONCE):
            part = slice(begin, begin + STATES_AT_ONCE)
            inside = at[part] < asked.sizes[q[part]]
            # The query has a letter more.
            keep(_exactly(index, asked, codes, q[part][inside], at[part][inside] + 1, low[part][inside], high[part][inside]))
            many = np.repeat(np.arange(len(inside)), len(letters))
            code = np.tile(letters, len(inside))
            own = np.full(len(inside), -1, dtype=np.int64)
            own[inside] = codes[asked.begins[q[part][inside]] + at[part][inside]]
            many, code = many[code != own[many]], code[code != own[many]]
            l, h = index.step(code, low[part][many], high[part][many])
            many, l, h = many[l < h], l[l < h], h[l < h]
            # The word has a letter more, or another one.
            keep(_exactly(index, asked, codes, q[part][many], at[part][many], l, h))
            other = inside[many]
            keep(_exactly(index, asked, codes, q[part][many[other]], at[part][many[other]] + 1, l[other], h[other]))
        on = at < asked.sizes[q]
        q, at, low, high = q[on], at[on], low[on], high[on]
        low, high = index.step(codes[asked.begins[q] + at], low, high)
        at = at + 1
    pairs = np.unique(np.concatenate(pairs_q) * np.int64(len(words) + 1) + np.concatenate(pairs_x))
    return pairs // (len(words) + 1), pairs % (len(words) + 1)


class Block:
    """One index over the words of some shards of a side (0: first halves agree, 1: second halves)."""

    def __init__(self, words: list[str], n: np.ndarray, side: int) -> None:
        # A search to the right is a search to the left in the words reversed, so words are held as they are searched.
        self.side = side
        held = [w[::-1] if side else w for w in words]
        turned = [w[::-1] for w in held]
        order = sorted(range(len(words)), key=turned.__getitem__)
        self.words = [words[i] for i in order]
        self.n = n[order]
        self.held = Sequences([held[i] for i in order])
        self.index = SuffixRanks([turned[i] for i in order])
        self.rank = np.empty(len(words), dtype=np.int64)
        self.rank[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))

    def near(self, words: list[str]) -> tuple[np.ndarray, list[int | None], list[str | None]]:
        """For each word how many words of the block are near it by this side, and n and word of the best of them.

        A pair that agrees in either half counts for the first side only.
        """
        asked = Sequences([w[::-1] if self.side else w for w in words])
        first = asked.sizes // 2
        q, x = search(self.held, self.index, asked, asked.sizes - first if self.side else first)
        if self.side and len(q):
            most = np.minimum(first[q], self.held.sizes[x])
            at, beside = asked.sizes[q] - 1, self.held.sizes[x] - 1
            common = np.zeros(len(q), dtype=np.int64)
            live = np.flatnonzero(most > 0)
            while len(live):
                done = common[live]
                same = asked.letter(q[live], at[live] - done) == self.held.letter(x[live], beside[live] - done)
                live = live[same]
                common[live] += 1
                live = live[common[live] < most[live]]
            q, x = q[common < first[q]], x[common < first[q]]
        counts = np.bincount(q, minlength=len(words))
        order = np.lexsort((self.rank[x], -self.n[x], q))
        best = order[np.concatenate(([True], q[order][1:] != q[order][:-1]))] if len(q) else order
        n: list[int | None] = [None] * len(words)
        form: list[str | None] = [None] * len(words)
        for i, j in zip(q[best].tolist(), x[best].tolist(), strict=True):
            n[i], form[i] = int(self.n[j]), self.words[j]
        return counts, n, form


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 7) -> DataFrame:
    """word and n: the runs of letters of all texts, A-Z in lower case, as the contract alters them.

    Where the crc32 of ``key:run`` is a multiple of 31, the letter at that number modulo the length is left out. Words
    have ``shortest`` letters and two occurrences at least. A null key is an empty text.
    """
    found = F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), found.alias("run"))
    # translate goes letter by letter: most runs are spared it.
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), lower_ascii(F.col("run"))).otherwise(F.col("run")))
    number = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = (F.col("number") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("number", number).select(
        F.when(F.col("number") % 31 == 0, cut).otherwise(F.col("run")).alias("word")
    )
    counted = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter("n >= 2")


FOUND = "word string, n long, n_near long, near_n long, near string"


def near_words(words: DataFrame, shortest: int = 7) -> DataFrame:
    """For words (word, n) n_near and, in ``near`` and ``near_n``, the near word of largest n (ties: the least)."""
    affix = max(1, shortest // 2)
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, affix).alias("affix")),
        F.struct(F.lit(1).alias("side"), F.substring("word", -affix, affix).alias("affix")),
    )
    dealt = words.select("word", "n", F.explode(sides).alias("shard")).select("word", "n", "shard.*")
    sizes = dealt.groupBy("side", "affix").count()
    # At most twice the words over SHARD_WORDS rows.
    large = F.broadcast(
        sizes.filter(F.col("count") > SHARD_WORDS).select(
            "side", "affix", F.ceil(F.col("count") / SHARD_WORDS).cast("int").alias("blocks")
        )
    )
    blocks = F.coalesce("blocks", F.lit(1))
    shards = (
        dealt.join(large, ["side", "affix"], "left")
        .withColumn("cut", F.col("blocks").isNotNull())
        .withColumn("own", F.pmod(F.xxhash64("word"), blocks))
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("cut", "side", "affix", "block", (F.col("own") == F.col("block")).alias("indexed"), "word", "n")
        .repartition("side", "affix", "block")
        .sortWithinPartitions("cut", "side", "affix", "block", F.desc("indexed"))
    )

    def answered(block: Block, words: list[str], n: np.ndarray) -> pa.RecordBatch:
        counts, near_n, near = block.near(words)
        return pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(n), pa.array(counts), pa.array(near_n, pa.int64()), pa.array(near, pa.string())],
            names=["word", "n", "n_near", "near_n", "near"],
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cut = batch.column("cut").to_numpy(zero_copy_only=False)
            whole = int(np.searchsorted(cut, True))
            if whole:
                held.append(batch.slice(0, whole))
                if sum(b.num_rows for b in held) >= BLOCK_WORDS:
                    held = yield from _whole_shards(held, answered, False)
            if whole < batch.num_rows:
                yield from _whole_shards(held, answered, True)
                held = []
                yield from _cut_shards(batch.slice(whole), batches, answered)
        yield from _whole_shards(held, answered, True)

    return shards.mapInArrow(find, FOUND)


def _boundaries(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Where the rows of another shard begin, 0 first."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in names:
        column = table.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _whole_shards(held: list[pa.RecordBatch], answered, last: bool) -> Iterator[pa.RecordBatch]:
    """Answers for complete shards, some at a time; returns the rows that may go on."""
    if not held:
        return []
    table = pa.Table.from_batches(held).combine_chunks()
    begins = _boundaries(table, ("side", "affix"))
    stops = [*begins[1:].tolist(), *([table.num_rows] if last else [])]
    side = table.column("side").to_numpy()
    done = 0
    for i, stop in enumerate(stops):
        # A block ends with its side, with enough words, or with the last complete shard.
        turns = stop < table.num_rows and side[stop] != side[done]
        if stop - done < BLOCK_WORDS and not turns and i + 1 < len(stops):
            continue
        part = table.slice(done, stop - done)
        words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
        yield answered(Block(words, n, int(side[done])), words, n)
        done = stop
    return table.slice(done).to_batches() if done < table.num_rows else []


def _cut_shards(batch: pa.RecordBatch, batches: Iterator[pa.RecordBatch], answered) -> Iterator[pa.RecordBatch]:
    """Answers for blocks of cut shards: the indexed words of a block come first, then the others to search in it."""
    key, block = None, None
    words: list[str] = []
    n: list[int] = []
    while batch is not None:
        table = pa.Table.from_batches([batch])
        begins = [*_boundaries(table, ("side", "affix", "block", "indexed")).tolist(), table.num_rows]
        for begin, stop in zip(begins[:-1], begins[1:], strict=True):
            part = table.slice(begin, stop - begin)
            side, affix, number, indexed = (part.column(c)[0].as_py() for c in ("side", "affix", "block", "indexed"))
            if (side, affix, number) != key:
                if words:
                    yield answered(Block(words, np.array(n), key[0]), words, np.array(n))
                key, block, words, n = (side, affix, number), None, [], []
            if indexed:
                words += part.column("word").to_pylist()
                n += part.column("n").to_pylist()
                continue
            if words:
                block = Block(words, np.array(n), side)
                yield answered(block, words, np.array(n))
                words, n = [], []
            asked = part.column("word").to_pylist()
            if block is not None:  # else no word of the shard fell into this block
                yield answered(block, asked, part.column("n").to_numpy())
        batch = next(batches, None)
    if words:
        yield answered(Block(words, np.array(n), key[0]), words, np.array(n))


def spelling_variants(words: DataFrame, shortest: int = 7, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary of distinct words (word, n).

    ``shortest`` is a lower bound of the words' lengths in code points (2 at least). The form is the near word of
    largest n (ties: the least by code points) if that is ``times`` n of the word or more, else null; the root is where
    following forms ends, the word itself if it has none. A null word is left out; no words give no rows.
    """
    parts = near_words(words.filter("word IS NOT NULL"), shortest)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("order"), "near")))
    joined = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    has = -F.col("best.order") >= times * F.col("n")
    found = staged(
        joined.select(
            "word",
            F.when(has, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(has, -F.col("best.order")).alias("form_n"),
        ),
        "forms",
    )
    links = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    following = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
    going, ended = links, []
    while True:
        # Only words whose root so far has a form of its own go on.
        after = staged(going.join(following, "root", "left"), "roots")
        ended.append(after.filter("next IS NULL").select("word", "root"))
        going = after.filter("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if going.isEmpty():
            break
    roots = ended[0]
    for part in ended[1:]:
        roots = roots.unionByName(part)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
