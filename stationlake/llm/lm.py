"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Words are counted over all training texts. The most frequent ones have a class of their own, all others share one. Each
of those, down to words seen once, has a code: its rank by frequency, written as band, step and column. With V such
words there are about the cube root of V of each, so vectors follow the vocabulary while their tables stay small.
The last two words predict the next: their vectors, each the sum of that of the class and those of the code,
weighted place by place, are added up to a query, whose product with each class's vector, plus the class's bias, is its
score. Inside the shared class the query scores the bands and one unknown word, plus the band's vector the
steps of the band, plus the step's vector the columns. Training of classes needs no normalisation: in each batch the true
next classes are told from noise classes drawn by frequency; bands, steps and columns are few, and are trained by
likelihood from the smoothed counts on. Scoring normalises every level, over all classes in each context, so that token
probabilities add up to one over all words and one unknown word.

Scale. Texts are dealt to chunks of a few million words. A chunk asks once for each of its different words,
with its own training count; counts are added up per word by a shuffle, and the totals go back to the chunks that
asked. So no table of all words is broadcast, and a word in every text moves once per chunk; codes go the same
way. Texts are read and cut into words once: from then on they are the places of their words among those of the chunk. Training goes in rounds over the chunks, which follow from the rows alone: each chunk of a round trains on all its
training texts, in the order of their hashes, from the average of the round before, and parameters are averaged by words
seen, one grouped sum per parameter. Broadcast are the parameters, whose size follows the cube root of the number of words, and one
count per band and step, the square of that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import CLEARED, slices, small_batches, staged, thrifty

#: Words with a class of their own; the end, all other words, and the start come on top.
FREQUENT = 1000
#: Length of the vectors, words of context, noise classes and words of a training batch.
SIZE = 16
CONTEXT = 2
NOISE = 64
BATCH = 1024
#: Parameters that the numbers of a word's code add to its vector as a context.
CODE_CONTEXTS = ("context_band", "context_step", "context_column")
#: Words that are ranked in one task, about.
RANKED_WORDS = 500_000
RATE = 0.1
#: Words of a chunk, about.
CHUNK_WORDS = 2_000_000
#: Rounds of training at most; a chunk takes part in one of them.
ROUNDS = 4
#: Rows of words in a batch.
_ROWS = 100_000
#: Scores that are summed up are base 2 logarithms.
LOG2E = np.float32(1 / math.log(2))
#: numpy has exp2 in wide instructions with these alone, where it takes half the time of exp; else twice that time.
FAST_EXP2 = bool({"AVX512_SKX", "X86_V4"} & set(np.show_config(mode="dicts")["SIMD Extensions"].get("found", ())))
#: Products of powers of 2 stay in the range of 32-bit numbers if their exponents add up to this at most.
MOST_EXPONENT = 110
#: Contexts whose products are made at a time: two tables of that many rows stay in the cache of a core.
PRODUCTS = 64
#: Name of the end of a text; no word holds a line feed.
END = xxhash.xxh3_64_intdigest(b"\n")

_NUMBERED = "chunk int, place int, word long, n long, key long, order long, trains boolean, ids binary"
_NUMBERED_SCHEMA = pa.schema(
    [
        ("chunk", pa.int32()), ("place", pa.int32()), ("word", pa.int64()), ("n", pa.int64()), ("key", pa.int64()),
        ("order", pa.int64()), ("trains", pa.bool_()), ("ids", pa.binary()),
    ]
)


def _lowered(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


class _Places(dict):
    """Places of words among the different ones of their chunk, in the order they are met; first is the end of a text."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place

    def of(self, text: bytes | None) -> np.ndarray:
        words = _lowered(text)
        out = np.zeros(len(words) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return out


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on: most of the last ones are 0 and take no room on disk."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _of_planes(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    ends = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return zip([0, *ends[:-1]], ends, strict=True) if len(values) else iter(())


def _number_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, key, order, text, trains) sorted by chunk to two kinds of rows: (chunk, key, order, trains, ids) for each text, with
    the places of its words in the chunk, and (chunk, place, word, n) for each different word of a chunk, with its training count.
    """
    chunk, places, counts = None, _Places(), np.zeros(0, np.int64)

    def out(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        arrays = [columns.get(field.name, pa.nulls(rows, field.type)) for field in _NUMBERED_SCHEMA]
        return pa.RecordBatch.from_arrays(arrays, schema=_NUMBERED_SCHEMA)

    def words() -> Iterator[pa.RecordBatch]:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places)).view(np.int64)
        for begin in range(0, len(hashes), _ROWS):
            some = hashes[begin : begin + _ROWS]
            yield out(
                len(some), chunk=pa.array(np.full(len(some), chunk, np.int32)), word=pa.array(some),
                place=pa.array(np.arange(begin, begin + len(some), dtype=np.int32)), n=pa.array(counts[begin : begin + _ROWS]),
            )

    for whole in batches:
        own = whole.column("chunk").to_numpy()
        for begin, end in _runs(own):
            if own[begin] != chunk:
                if chunk is not None:
                    yield from words()
                chunk, places, counts = own[begin], _Places(), np.zeros(0, np.int64)
            for batch in slices(whole.slice(begin, end - begin), "text"):
                ids = [places.of(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
                counted = [one for one, trains in zip(ids, batch.column("trains").to_pylist(), strict=True) if trains]
                counts = np.append(counts, np.zeros(len(places) - len(counts), np.int64))
                if counted:
                    counts += np.bincount(np.concatenate(counted), minlength=len(places))
                yield out(
                    len(ids), ids=pa.array([_planes(one) for one in ids], pa.binary()),
                    **{name: batch.column(name) for name in ("chunk", "key", "order", "trains")},
                )
    if chunk is not None:
        yield from words()


def _pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, word, total, rank) sorted by chunk and place to a row for each chunk, with an array of each."""
    chunk, held = None, []

    def out() -> pa.RecordBatch:
        arrays = [pa.array([_planes(np.concatenate(column))], pa.binary()) for column in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *arrays], names=["chunk", "word", "total", "rank"])

    for batch in batches:
        own, *columns = (batch.column(name).to_numpy() for name in ("chunk", "word", "total", "rank"))
        for begin, end in _runs(own):
            if own[begin] != chunk:
                if chunk is not None:
                    yield out()
                chunk, held = own[begin], []
            held.append([column[begin:end] for column in columns])
    if chunk is not None:
        yield out()


def _arrays(words: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word, total and rank by place, of the one row of a chunk."""
    return tuple(_of_planes(words[name][0].as_py(), np.int64) for name in ("word", "total", "rank"))


def _places(texts: pa.Table) -> Iterator[np.ndarray]:
    """The places of the words of each text."""
    for ids in texts["ids"]:
        yield _of_planes(ids.as_py(), np.int32)


class Codes:
    """Words without a class of their own: rank = row * columns + column, row = band * steps + step."""

    def __init__(self, words: int, columns: int, rows: np.ndarray) -> None:
        """rows: training counts of the rows, of which there are as many as the words fill."""
        self.words, self.columns = words, columns
        self.steps = math.isqrt(max(len(rows) - 1, 0)) + 1
        self.bands = -(-len(rows) // self.steps)
        smoothed = np.zeros(self.bands * self.steps)
        smoothed[: len(rows)] = rows + 0.5 * np.minimum(columns, words - columns * np.arange(len(rows)))
        steps = smoothed.reshape(self.bands, self.steps)
        bands = np.append(steps.sum(axis=1), 0.5)  # the last one is the unknown word
        with np.errstate(divide="ignore"):
            self.band_logs = np.log(bands / bands.sum()).astype(np.float32)
            self.step_logs = np.maximum(np.log2(steps / bands[:-1, None]), -1e30).astype(np.float32)


class Model:
    """Parameters, and the numbers of the words: 0 .. K-1 frequent words, K the end, K+1 the unknown word, K+2 the start,
    then all words with a code. K+1 is also the class of the latter."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, codes: Codes | None = None, seed: int = 3) -> None:
        """frequent: hashes; counts: training counts of the frequent words, the end and all other words."""
        self.codes = codes = codes or Codes(0, 1, np.empty(0))
        self.frequent = {int(h): i for i, h in enumerate(frequent.view(np.uint64))}
        self.k = len(frequent)
        share = (counts + 0.5) / (counts + 0.5).sum()
        rng = np.random.default_rng(seed)
        rows = self.k + 3
        self.noise = share

        def zeros(*shape: int) -> np.ndarray:
            return np.zeros(shape, dtype=np.float32)

        def drawn(count: int) -> np.ndarray:
            return rng.normal(0, 0.1, (count, SIZE)).astype(np.float32)

        parts = {
            "context": drawn(rows),
            "target": zeros(self.k + 2, SIZE),
            "weight": np.ones((CONTEXT, SIZE), dtype=np.float32),
            "bias": np.log(share).astype(np.float32),
            # The last row stands for words without a code, and stays 0.
            "context_band": np.append(drawn(codes.bands), zeros(1, SIZE), 0),
            "context_step": np.append(drawn(codes.steps), zeros(1, SIZE), 0),
            "context_column": np.append(drawn(codes.columns), zeros(1, SIZE), 0),
            "band": zeros(codes.bands + 1, SIZE),
            "band_bias": zeros(codes.bands + 1),
            "step_band": zeros(codes.bands, SIZE),
            "step": zeros(codes.steps, SIZE),
            "step_bias": zeros(codes.steps),
            "column_step": zeros(codes.steps, SIZE),
            "column": zeros(codes.columns, SIZE),
            "column_bias": zeros(codes.columns),
        }
        # Tables of vectors come first: all their rows are one table in a flat copy.
        self.parts = dict(sorted(parts.items(), key=lambda part: part[1].ndim, reverse=True))

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts.values()])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for name, part in self.parts.items():
            self.parts[name] = flat[at : at + part.size].reshape(part.shape).astype(np.float32)
            at += part.size

    def copy(self) -> Model:
        own = object.__new__(Model)
        own.__dict__.update(self.__dict__ | {"parts": {k: v.copy() for k, v in self.parts.items()}})
        return own

    def numbers(self, hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Numbers of the words with these hashes and ranks (-1: no code)."""
        hashes = hashes.view(np.uint64)
        out = np.where(ranks >= 0, self.k + 3 + ranks, self.k + 1)
        without = np.flatnonzero(ranks < 0)
        out[without] = [self.frequent.get(h, self.k + 1) for h in hashes[without].tolist()]
        out[hashes == np.uint64(END)] = self.k
        return out

    def split(self, ids: np.ndarray) -> tuple[np.ndarray, ...]:
        """Class, band, step and column of each number; words without a code have those after the last."""
        codes, coded = self.codes, ids > self.k + 2
        rank = np.where(coded, ids - self.k - 3, 0)
        if codes.words < 1 << 31:
            rank = rank.astype(np.int32)  # divided in a tenth of the time
        row = rank // codes.columns  # several times faster than divmod
        column = rank - row * codes.columns
        band = row // codes.steps
        step = row - band * codes.steps
        return (
            np.where(coded, self.k + 1, ids),
            np.where(coded, band, codes.bands),
            np.where(coded, step, codes.steps),
            np.where(coded, column, codes.columns),
        )

    def contexts(self, ids: np.ndarray) -> np.ndarray:
        """The CONTEXT words before each place, the nearest first; starts before the text."""
        padded = np.concatenate((np.full(CONTEXT, self.k + 2, ids.dtype), ids))
        return np.stack([padded[CONTEXT - 1 - i : len(padded) - 1 - i] for i in range(CONTEXT)], axis=1)

    def vectors(self, split: tuple[np.ndarray, ...]) -> np.ndarray:
        p = self.parts
        out = p["context"].take(split[0], axis=0)
        for name, at in zip(CODE_CONTEXTS, split[1:], strict=True):
            out += p[name].take(at, axis=0)
        return out

    def query(self, contexts: np.ndarray) -> np.ndarray:
        return self.split_query([self.split(contexts[:, i]) for i in range(CONTEXT)])

    def split_query(self, splits: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        """splits: what split gives for the words at each place of the contexts."""
        return sum(self.vectors(split) * self.parts["weight"][i] for i, split in enumerate(splits))

    def band_scores(self, query: np.ndarray) -> np.ndarray:
        p = self.parts
        return _products(query, p["band"], p["band_bias"] + self.codes.band_logs)

    def step_scores(self, query: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is asked of the steps of the given bands, and their scores."""
        p = self.parts
        asked = query + p["step_band"][band]
        scores = _products(asked, p["step"], p["step_bias"])
        scores += self.codes.step_logs.take(band, axis=0)
        return asked, scores

    def column_scores(self, asked: np.ndarray, band: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the columns of the given steps; asked: what was asked of the steps."""
        p, codes = self.parts, self.codes
        asked = asked + p["column_step"][step]
        scores = _products(asked, p["column"], p["column_bias"])
        filled = codes.words - (band * codes.steps + step) * codes.columns
        for place in np.flatnonzero(filled < codes.columns):  # in the last row
            scores[place, filled[place] :] = -1e30
        return asked, scores

    def log_totals(self, query: np.ndarray) -> np.ndarray:
        """Log of the sum of exp(score) over all classes, per query."""
        table = np.append(self.parts["target"].T, self.parts["bias"][None], 0) * LOG2E
        query = _with_ones(query)
        out = np.empty(len(query), dtype=np.float32)
        piece = max(64, (1 << 17) // table.shape[1])
        scores, exps = np.empty((2, piece, table.shape[1]), np.float32)
        for begin in range(0, len(query), piece):
            n = len(part := query[begin : begin + piece])
            out[begin : begin + n] = _log_sums(np.matmul(part, table, out=scores[:n]), exps[:n])
        return out / LOG2E

    def log_probabilities(self, ids: np.ndarray, contexts: np.ndarray, sums: ClassSums | None = None) -> np.ndarray:
        """Natural log of the normalised probability of each word after its context; sums: those of this model."""
        splits = [self.split(contexts[:, i]) for i in range(CONTEXT)]
        query = self.split_query(splits)
        classes, band, step, column = self.split(ids)
        p = self.parts
        out = np.einsum("ij,ij->i", query, p["target"].take(classes, axis=0)) + p["bias"][classes]
        out -= (sums or ClassSums(self)).logs(splits, query)
        others = np.flatnonzero(classes == self.k + 1)
        for begin in range(0, len(others), 512):
            places = others[begin : begin + 512]
            asked = query[places]
            _add_logs(out, places, self.band_scores(asked), band[places])
            coded = ids[places] > self.k + 2
            places, asked = places[coded], asked[coded]
            asked, scores = self.step_scores(asked, band[places])
            _add_logs(out, places, scores, step[places])
            _add_logs(out, places, self.column_scores(asked, band[places], step[places])[1], column[places])
        return out

    class_log_probabilities = log_probabilities


class ClassSums:
    """Sums of exp(score) over the classes after any context of a model, whose parameters stay as they are.

    The score of a class is a sum of what each word of the context adds, and that of what its class and each number of its code
    add. So its power is a product of powers, which are made once for each class and number of a code, not for each context.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        p, table = model.parts, model.parts["target"].T * LOG2E
        #: By place in the context and name: the powers of all classes, and the largest exponent among them.
        self.powers: list[dict[str, np.ndarray]] = []
        self.most: list[dict[str, np.ndarray]] = []
        with np.errstate(over="ignore", invalid="ignore"):
            for i in range(CONTEXT):
                scores = {name: (p[name] * p["weight"][i]) @ table for name in ("context", *CODE_CONTEXTS)}
                if i == 0:
                    scores["context"] += p["bias"] * LOG2E
                without = sum(scores[name][-1] for name in CODE_CONTEXTS)
                scores["context_band"] += scores["context"][model.k + 1]  # words with a code are of that class
                scores["context"] += without
                self.most.append({name: np.abs(each).max(axis=1) for name, each in scores.items()})
                self.powers.append({name: _exp2(each, out=each) for name, each in scores.items()})
            self.pairs = self.powers[0]["context"] @ self.powers[1]["context"].T

    def logs(self, splits: list[tuple[np.ndarray, ...]], query: np.ndarray) -> np.ndarray:
        """Natural logs of the sums; splits: what Model.split gives for the words at each place of the contexts."""
        coded = [split[1] < self.model.codes.bands for split in splits]
        sums = np.empty(len(query), np.float32)
        with np.errstate(all="ignore"):
            places = np.flatnonzero(~coded[0] & ~coded[1])
            sums[places] = self.pairs[splits[0][0][places], splits[1][0][places]]
            self._of_codes(sums, splits, np.flatnonzero(coded[0] & ~coded[1]), 0, ("context",))
            self._of_codes(sums, splits, np.flatnonzero(coded[1] & ~coded[0]), 1, ("context",))
            self._of_codes(sums, splits, np.flatnonzero(coded[0] & coded[1]), 0, CODE_CONTEXTS)
            out = np.log2(sums) / LOG2E
        exponents = np.zeros(len(query), np.float32)
        for most, split, has_code in zip(self.most, splits, coded, strict=True):
            of_codes = sum(most[name][at] for name, at in zip(CODE_CONTEXTS, split[1:], strict=True))
            exponents += np.where(has_code, of_codes, most["context"][split[0]])
        far = np.flatnonzero(~(exponents <= MOST_EXPONENT))
        if len(far):
            out[far] = self.model.log_totals(query[far])
        return out

    def _of_codes(
        self, sums: np.ndarray, splits: list[tuple[np.ndarray, ...]], places: np.ndarray, side: int, others: tuple[str, ...]
    ) -> None:
        """Put the sums at places, where the word at that side of the context has a code; others: tables of the other word."""
        own, other = splits[side], splits[1 - side]
        places = places[np.argsort(own[1][places], kind="stable")]
        band = own[1][places]
        factors = [(self.powers[side][name], at[places]) for name, at in zip(CODE_CONTEXTS[1:], own[2:], strict=True)]
        of_other = other[:1] if len(others) == 1 else other[1:]
        factors += [(self.powers[1 - side][name], at[places]) for name, at in zip(others, of_other, strict=True)]
        room = np.empty((2, PRODUCTS, len(self.model.noise)), self.pairs.dtype)
        for first, last in _runs(band):
            of_band = self.powers[side]["context_band"][band[first]]
            for begin in range(first, last, PRODUCTS):
                end = min(begin + PRODUCTS, last)
                product, factor = room[:, : end - begin]
                for i, (table, at) in enumerate(factors):
                    # Any place is in the table; numpy would copy the rows once more to make sure.
                    table.take(at[begin:end], axis=0, out=factor if i else product, mode="clip")
                    if i:
                        product *= factor
                sums[places[begin:end]] = product @ of_band


def _add_logs(out: np.ndarray, places: np.ndarray, scores: np.ndarray, true: np.ndarray) -> None:
    """Add the natural log probability of the true one among the scores of each row."""
    if len(places):
        out[places] += (scores[np.arange(len(places)), true] - _log_sums(scores)) / LOG2E


def _with_ones(rows: np.ndarray) -> np.ndarray:
    """rows with a last column of ones, for which a product adds a bias, or sums."""
    out = np.empty((len(rows), rows.shape[1] + 1), np.float32)
    out[:, :-1] = rows
    out[:, -1] = 1
    return out


def _products(asked: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Products with the rows of the table, plus the bias, as base 2 logarithms."""
    return _with_ones(asked) @ (np.append(table.T, bias[None], 0) * LOG2E)


def _exp2(scores: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    if FAST_EXP2:
        return np.exp2(scores, out=out)
    out = np.multiply(scores, np.float32(math.log(2)), out=out)
    return np.exp(out, out=out)


def _exps(scores: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """2 to the power of score - shift, their sums by rows, and the shift. The shift is 0, unless a sum is too large or too
    small for that: then it is the largest score of each row."""
    ones = np.ones(scores.shape[1], np.float32)
    with np.errstate(over="ignore", invalid="ignore"):
        exps = _exp2(scores, out)
        sums = exps @ ones
    if len(sums) and not (sums.min() > 1e-30 and sums.max() < 1e30):
        shift = scores.max(axis=1)
        exps = _exp2(scores - shift[:, None], out)
        return exps, exps @ ones, shift
    return exps, sums, 0.0


def _log_sums(scores: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Base 2 log of the sum of the scores' powers of 2 in each row; out: room for as many numbers."""
    _, sums, shift = _exps(scores, out)
    return np.log2(sums) + shift


class Trainer:
    """Noise-contrastive steps with one set of noise classes per batch, likelihood steps below the classes, and
    per-parameter step sizes.

    The parameters of the model lie in one flat array, and so do their slopes and step sizes.
    """

    def __init__(self, model: Model, seed: int | list[int]) -> None:
        self.model, self.rng = model, np.random.default_rng(seed)
        self.log_noise = (np.log(model.noise) + np.log(NOISE)).astype(np.float32)
        self.cumulative = np.cumsum(model.noise)
        self.flat = model.flat
        self.slopes, self.squares = np.zeros_like(self.flat), np.full_like(self.flat, 1e-2)
        self.room = np.empty((2, len(self.flat)), np.float32)
        self.d: dict[str, np.ndarray] = {}
        self.row_of: dict[str, int] = {}
        at = 0
        for name, part in model.parts.items():
            own = slice(at, at + part.size)
            model.parts[name] = self.flat[own].reshape(part.shape)
            self.d[name] = self.slopes[own].reshape(part.shape)
            if part.ndim == 2:
                self.row_of[name] = at // SIZE
                rows = (at + part.size) // SIZE
            at += part.size
        self.rows = self.slopes[: rows * SIZE].reshape(rows, SIZE)
        # Numbers of 16 bits are sorted by radix.
        self.kind = np.uint16 if rows < 1 << 16 else np.int64

    def _apply(self) -> None:
        square, change = self.room
        np.multiply(self.slopes, self.slopes, out=square)
        self.squares += square
        np.sqrt(self.squares, out=square)
        np.multiply(self.slopes, np.float32(RATE), out=change)
        change /= square
        self.flat += change

    def step(self, ids: np.ndarray, contexts: np.ndarray) -> None:
        split = self.model.split(np.concatenate((ids, contexts.T.ravel())))
        self.split_step(np.stack(split).reshape(4, CONTEXT + 1, len(ids)))

    def split_step(self, split: np.ndarray) -> None:
        """split: class, band, step and column of the words and of each word of their contexts."""
        model, p, d, n = self.model, self.model.parts, self.d, split.shape[2]
        noise = np.minimum(
            np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1]), len(self.cumulative) - 1
        )
        self.slopes.fill(0)
        places, rows = [], []

        def add(name: str, at: np.ndarray, slopes: np.ndarray) -> None:
            places.append((at + self.row_of[name]).astype(self.kind))
            rows.append(slopes)

        classes = split[0, 0]
        vectors = [model.vectors(tuple(split[:, 1 + i])) for i in range(CONTEXT)]
        query = sum(v * p["weight"][i] for i, v in enumerate(vectors))
        target, others = p["target"].take(classes, axis=0), p["target"][noise]
        true = np.einsum("ij,ij->i", query, target) + p["bias"][classes] - self.log_noise[classes]
        asked = _with_ones(query)
        down = asked @ (np.append(-others.T, (self.log_noise[noise] - p["bias"][noise])[None], 0) * LOG2E)
        up = 1 / (1 + np.exp(np.clip(true, -30, 30))) / n  # slopes of the log likelihood
        np.clip(down, -30 * LOG2E, 30 * LOG2E, out=down)
        _exp2(down, out=down)
        down += 1
        np.divide(np.float32(-1 / n), down, out=down)
        d_query = up[:, None] * target
        d_query += down @ others
        add("target", classes, up[:, None] * query)
        of_noise = down.T @ asked
        add("target", noise, of_noise[:, :-1])
        d["bias"] += np.bincount(classes, up, len(d["bias"]))
        d["bias"] += np.bincount(noise, of_noise[:, -1], len(d["bias"]))
        coded = np.flatnonzero(split[1, 0] < model.codes.bands)
        if len(coded):
            (band, step, column), asked = split[1:, 0, coded], query[coded]
            d_coded = self._likelihood("band", asked, model.band_scores(asked), band, n)
            asked, scores = model.step_scores(asked, band)
            d_asked = self._likelihood("step", asked, scores, step, n)
            asked, scores = model.column_scores(asked, band, step)
            d_column = self._likelihood("column", asked, scores, column, n)
            add("column_step", step, d_column)
            d_asked += d_column
            add("step_band", band, d_asked)
            d_coded += d_asked
            d_query[coded] += d_coded
        for i in range(CONTEXT):
            d_vector = d_query * p["weight"][i]
            add("context", split[0, 1 + i], d_vector)
            own = np.flatnonzero(split[1, 1 + i] < model.codes.bands)
            if len(own):
                of_codes = d_vector.take(own, axis=0)
                for name, at in zip(CODE_CONTEXTS, split[1:, 1 + i], strict=True):
                    add(name, at[own], of_codes)
            d["weight"][i] = np.einsum("ij,ij->j", d_query, vectors[i])
        _scatter(self.rows, np.concatenate(places), np.concatenate(rows))
        self._apply()

    def _likelihood(self, name: str, asked: np.ndarray, scores: np.ndarray, true: np.ndarray, n: int) -> np.ndarray:
        """Adds the slopes for the true ones among the scores, and returns that for what was asked; all over n."""
        slope, sums, _ = _exps(scores)
        slope[np.arange(len(true)), true] -= sums
        share = (-1 / (sums * np.float32(n)))[:, None]  # of fewer numbers than slope has
        asked = _with_ones(asked)
        asked *= share
        summed = slope.T @ asked
        self.d[name] += summed[:, :-1]
        self.d[f"{name}_bias"] += summed[:, -1]
        back = slope @ self.model.parts[name]
        back *= share
        return back


def _scatter(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to out at the given places."""
    order = np.argsort(at, kind="stable")
    places = at[order]
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    out[places[first]] += np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def _trained(dealt: DataFrame, known: DataFrame, model: Model) -> np.ndarray:
    """Parameters averaged over the chunks of dealt (chunk, order, ids), weighted by words; known: see _pack_words."""
    shared = dealt.sparkSession.sparkContext.broadcast(model)

    def train(texts: pa.Table, words: pa.Table) -> pa.Table:
        own, seen = shared.value.copy(), 0
        if len(texts):
            trainer = Trainer(own, seed=[5, words["chunk"][0].as_py()])
            hashes, _, ranks = _arrays(words)
            numbers = own.numbers(hashes, ranks)
            ids, contexts, held = [], [], 0
            for places in _places(texts.sort_by("order")):
                one = numbers[places]
                ids.append(one)
                contexts.append(own.contexts(one))
                held += len(one)
                if held >= 16 * BATCH:
                    seen += _epoch(trainer, np.concatenate(ids), np.concatenate(contexts))
                    ids, contexts, held = [], [], 0
            if held:
                seen += _epoch(trainer, np.concatenate(ids), np.concatenate(contexts))
        flat = own.flat.astype(np.float64) if seen else np.empty(0)
        return pa.table(
            {
                "at": pa.array(np.arange(len(flat), dtype=np.int32)), "value": pa.array(flat * seen),
                "seen": pa.array(np.full(len(flat), seen, dtype=np.int64)),
            }
        )

    summed = (
        dealt.select("chunk", "order", "ids").groupBy("chunk").cogroup(known.groupBy("chunk"))
        .applyInArrow(train, "at int, value double, seen long")
        .groupBy("at").agg((F.sum("value") / F.sum("seen")).alias("value"))
    )
    with small_batches(dealt.sparkSession, CLEARED):
        summed = summed.collect()
    flat = model.flat.astype(np.float64)
    for row in summed:  # one row per parameter
        flat[row["at"]] = row["value"]
    return flat


def _epoch(trainer: Trainer, ids: np.ndarray, contexts: np.ndarray) -> int:
    order = trainer.rng.permutation(len(ids))
    split = trainer.model.split(np.concatenate((ids[order], contexts[order].T.ravel())))
    split = np.stack(split).reshape(4, CONTEXT + 1, len(ids))
    for begin in range(0, len(order), BATCH):
        trainer.split_step(split[:, :, begin : begin + BATCH])
    return len(ids)


def _coded(once: DataFrame, apart: list[int], words: int) -> tuple[DataFrame, Codes]:
    """once, each counted word with its total, with the rank of each, -1 for those apart, which have no code; and the codes.

    words: how many of them aren't apart.
    """
    own = F.broadcast(once.sparkSession.createDataFrame(pa.table({"word": pa.array(apart, pa.int64())})))
    without = once.join(own, "word", "left_semi").select("word", "total", F.lit(-1).cast("long").alias("rank"))
    if not words:
        return without, Codes(0, 1, np.empty(0))
    order = F.desc("total"), F.col("word")
    parts = -(-words // RANKED_WORDS)
    rare = staged(
        once.join(own, "word", "left_anti")
        .repartitionByRange(parts, *order).select("word", "total", F.spark_partition_id().alias("part")),
        "rare",
    )
    sizes = {r["part"]: r["count"] for r in rare.groupBy("part").count().collect()}
    begins, at = [], 0
    for part in sorted(sizes):
        begins += [F.lit(part), F.lit(at).cast("long")]
        at += sizes[part]
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    ranked = staged(rare.select("word", "total", (F.create_map(*begins)[F.col("part")] + within).alias("rank")), "ranked")
    columns = math.ceil(words ** (1 / 3))
    rows = np.zeros(-(-words // columns))
    for r in ranked.groupBy(F.floor(F.col("rank") / columns).alias("row")).agg(F.sum("total").alias("total")).collect():
        rows[r["row"]] = r["total"]
    return ranked.unionByName(without), Codes(words, columns, rows)


def score_texts(
    docs: DataFrame, trains: Column, key: str = "doc_id", text: str = "text", chunk_words: int = CHUNK_WORDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    trains: condition over docs that is true for training rows (null: not). A token is a word in lower case (A-Z), and the end
    of each text. base_score and score are base 10 logarithms of the text's probability, by single words and by the
    model. A null or empty text is the end alone. Equal rows get equal results; without any training row all
    words are unknown and both scores follow from the smoothing. The result holds no other columns of docs.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(trains, F.lit(False)).alias("trains"),
    )
    octets = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-octets // (6 * chunk_words)))
    order = F.xxhash64("key", "text").alias("order")
    numbered = staged(
        rows.select(F.pmod(order, F.lit(chunks)).cast("int").alias("chunk"), "key", order, "text", "trains")
        .repartition(chunks, "chunk").sortWithinPartitions("chunk").mapInArrow(thrifty(_number_words), _NUMBERED),
        "numbered",
    )
    dealt = numbered.filter("place IS NULL").select("chunk", "key", "order", "trains", "ids")
    asked = numbered.filter("place IS NOT NULL").select("chunk", "place", "word", "n")
    once = staged(asked.filter("n > 0").groupBy("word").agg(F.sum("n").alias("total")), "words")
    end = int(np.uint64(END).view(np.int64))
    sums = once.agg(
        F.sum("total").alias("tokens"), F.count("*").alias("words"),
        F.sum(F.when(F.col("word") == end, F.col("total"))).alias("ends"),
    ).first()
    tokens, words, ends = sums["tokens"] or 0, sums["words"], sums["ends"] or 0
    top = once.filter(F.col("word") != end).orderBy(F.desc("total"), "word").limit(frequent).collect()
    ranked, codes = _coded(once, [end, *(r["word"] for r in top)], words - len(top) - (ends > 0))
    known = asked.join(ranked, "word", "left").select(
        "chunk", "place", "word", F.coalesce("total", F.lit(0).cast("long")).alias("total"),
        F.coalesce("rank", F.lit(-1).cast("long")).alias("rank"),
    )
    known = staged(
        known.repartition(chunks, "chunk").sortWithinPartitions("chunk", "place").select("chunk", "word", "total", "rank")
        .mapInArrow(thrifty(_pack_words), "chunk int, word binary, total binary, rank binary"),
        "known",
    )
    model = Model(
        np.array([r["word"] for r in top], dtype=np.int64),
        np.array([*(r["total"] for r in top), ends, tokens - ends - sum(r["total"] for r in top)], dtype=np.float64),
        codes,
    )
    rounds = min(ROUNDS, chunks)
    for i in range(rounds):
        own = F.pmod("chunk", F.lit(rounds)) == i
        model.put(_trained(dealt.filter("trains").filter(own), known.filter(own), model))
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pa.Table, words_of: pa.Table) -> pa.Table:
        model = shared.value
        hashes, totals, ranks = _arrays(words_of)
        sums, numbers = ClassSums(model), model.numbers(hashes, ranks)
        base_of = np.log10((totals + 0.5) / (tokens + 0.5 * (words + 1)))
        out: list[list] = [[], [], [], []]
        held, lengths = [], []

        def flush() -> None:
            places = np.concatenate(held)
            ids = [numbers[h] for h in held]
            logs = model.log_probabilities(np.concatenate(ids), np.concatenate([model.contexts(i) for i in ids]), sums)
            starts = np.cumsum([0, *lengths[:-1]])
            out[0].extend(lengths)
            out[1].extend(np.add.reduceat((totals[places] > 0).astype(np.int64), starts))
            out[2].extend(np.add.reduceat(base_of[places], starts))
            out[3].extend(np.add.reduceat(logs.astype(np.float64) / np.log(10), starts))
            held.clear()
            lengths.clear()

        for places in _places(texts):
            held.append(places)
            lengths.append(len(places))
            if sum(lengths) >= 200_000:
                flush()
        if held:
            flush()
        return pa.table(
            {
                "key": texts["key"], "trains": texts["trains"], "n_tokens": pa.array(out[0], pa.int64()),
                "n_known": pa.array(out[1], pa.int64()), "base_score": pa.array(out[2], pa.float64()),
                "score": pa.array(out[3], pa.float64()),
            }
        )

    scored = (
        dealt.select("chunk", "key", "trains", "ids").groupBy("chunk").cogroup(known.groupBy("chunk"))
        .applyInArrow(score, "key long, trains boolean, n_tokens long, n_known long, base_score double, score double")
    )
    return scored.select(
        F.col("key").alias(key), (~F.col("trains")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
