"""Byte-pair encoding and decoding without running the merges.

A token sequence is what the merges give exactly when each token is what the merges give for its own bytes and every
two neighbours stay apart when they stand alone. So a word is covered by longest token matches (Aho-Corasick), the
neighbours are checked, and only where two don't go together a shorter match is tried, going back as far as
needed; a place from which nothing fits is never tried again, so the time is linear in the word. Whether two tokens go
together follows from the table of merges: undo the later one of the merges that made the right edge of the first and the
left edge of the second, over and over, and see whether two pieces that meet would have merged earlier.

All new words of some rows are covered in one pass of the automaton and checked as arrays; those that fail are searched
together, one step of all of them at a time. Decoding looks up the bytes of tokens in one block by an offset table.

Scale: no shuffle. A task holds the tokenizer's tables and at most ``KNOWN_WORDS`` words; texts are taken some
megabytes at a time, longer ones in runs of words.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stationlake.llm.shared import SLICE_BYTES, slices

#: Words a task keeps at hand, and the longest that is kept.
KNOWN_WORDS, KEPT_LENGTH = 300_000, 48
#: Words up to this many bytes are searched together, and how many of them are.
SHORT, LEARNED_AT_ONCE = 48, 20_000
#: Ids that are decoded at a time.
IDS_AT_ONCE = 500_000
#: Words of one long text that are worked on at a time.
WORDS_AT_ONCE = 100_000
#: Fixed value: the words of a text before merging, as the tokenizer's file names them ("ByteLevel").
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stands between words while they are covered; it is no byte.
BETWEEN = "Ā"
NEVER = np.int64(2**40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself where it prints, else the next from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """The tables of a byte-level tokenizer file."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as source:
            described = json.load(source)
        model, added = described["model"], described["added_tokens"]
        kind = described["pre_tokenizer"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or described["normalizer"] is not None:
            raise ValueError("not a plain byte-level tokenizer")
        byte_of = byte_letters()
        self.vocab = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
        self.size = 1 + max([*self.vocab.values(), *(t["id"] for t in added)])
        self.left = np.arange(self.size)
        self.right = np.arange(self.size)
        codes, made = [], []
        for merge in model["merges"]:
            first, second = merge if isinstance(merge, list) else merge.split(" ")
            a, b = (self.vocab[bytes(byte_of[c] for c in part)] for part in (first, second))
            token = self.vocab[bytes(byte_of[c] for c in first + second)]
            if made and token <= made[-1]:
                raise ValueError("ids do not follow the order of merges")
            self.left[token], self.right[token] = a, b
            codes.append(a * self.size + b)
            made.append(token)
        #: Tokens below this id are single bytes.
        self.first_merge = min(made, default=self.size)
        order = np.argsort(np.array(codes, dtype=np.int64))
        self.codes = np.array(codes, dtype=np.int64)[order]
        self.made = np.array(made, dtype=np.int64)[order]
        self.special = {t["content"]: t["id"] for t in added}
        self._index_bytes()

    def _index_bytes(self) -> None:
        parts = [b""] * self.size
        for token, i in self.vocab.items():
            parts[i] = token
        for token, i in self.special.items():
            parts[i] = token.encode()
        self.block = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        merged = np.arange(self.size)[self.left != np.arange(self.size)]
        whole = self.apart(self.left[merged], self.right[merged], merged)
        never = set(merged[~whole].tolist())
        #: Tokens that the merges can give, by their bytes as Latin-1 text.
        self.tokens = {t.decode("latin-1"): i for t, i in self.vocab.items() if i not in never}
        self.longest = max(map(len, self.tokens))

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for token, i in self.tokens.items():
            found.add_word(token, i)
        found.make_automaton()
        return found

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that two tokens merge to, or ``NEVER``."""
        if not len(self.codes):
            return np.full(len(a), NEVER)
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.made[at], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether the bytes of a and b together give just (a, b), as far as merges ``before`` a token go."""
        edge_a, edge_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        limit = np.full(len(edge_a), NEVER) if before is None else np.array(before, dtype=np.int64)
        good = np.ones(len(edge_a), dtype=bool)
        live = np.arange(len(edge_a))
        while len(live):
            x, y = edge_a[live], edge_b[live]
            meet = self.merged(x, y) < limit[live]
            good[live[meet]] = False
            live = live[~meet & (np.maximum(x, y) >= self.first_merge)]
            x, y = edge_a[live], edge_b[live]
            # The later of both merges is undone first; of equal ones the right one, since merges go from the left.
            undo_a = x > y
            limit[live] = np.where(undo_a, x, y + 1)
            edge_a[live] = np.where(undo_a, self.right[x], x)
            edge_b[live] = np.where(undo_a, y, self.left[y])
        return good

    def decode(self, ids: bytes) -> bytes:
        """The bytes of tokens given as little-endian unsigned 32-bit ids; ids that are no token have none."""
        out = []
        for at in range(0, len(ids), 4 * IDS_AT_ONCE):
            part = np.frombuffer(ids[at : at + 4 * IDS_AT_ONCE], dtype="<u4").astype(np.int64)
            part = part[part < self.size]
            begin = self.offsets[part]
            sizes = self.offsets[part + 1] - begin
            ends = np.cumsum(sizes)
            if len(ends):
                out.append(self.block[np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def byte_pairs(file: str) -> BytePairs:
    """The tables, once per process; their size is the file's."""
    return BytePairs(file)


class Encoder:
    """Ids of texts; keeps a bounded number of words."""

    def __init__(self, tables: BytePairs) -> None:
        self.tables = tables
        self.known: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(WORDS)
        special = sorted(tables.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def _apart(self, a: int, b: int) -> bool:
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) > KNOWN_WORDS:
                self.fits.clear()
            found = bool(self.tables.apart(np.array([a]), np.array([b]))[0])
            self.fits[a, b] = found
        return found

    def search(self, word: str) -> bytes:
        """Ids of one word (bytes as Latin-1 text), by longest matches with steps back."""
        tokens, longest = self.tables.tokens, self.tables.longest
        path: list[str] = []
        dead: set[int] = set()
        at, reach = 0, longest
        while at < len(word):
            last = tokens[path[-1]] if path else None
            for size in range(min(reach, len(word) - at), 0, -1):
                part = word[at : at + size]
                if part in tokens and at + size not in dead and (last is None or self._apart(last, tokens[part])):
                    path.append(part)
                    at, reach = at + size, longest
                    break
            else:  # nothing fits here: never come back, and try a shorter token before
                dead.add(at)
                back = path.pop()
                at, reach = at - len(back), len(back) - 1
        return np.array([tokens[part] for part in path], dtype="<u4").tobytes()

    def search_short(self, words: list[str]) -> list[bytes]:
        """As :meth:`search` for many words of at most ``SHORT`` bytes, one step of all of them at a time."""
        tables = self.tables
        found = list(tables.automaton.iter(BETWEEN.join(words)))
        ends = np.array([e for e, _ in found], dtype=np.int64) + 1
        ids = np.array([i for _, i in found], dtype=np.int64)
        begins = ends - (tables.offsets[ids + 1] - tables.offsets[ids])
        order = np.lexsort((-ends, begins))  # by place, the longest match first
        ends, ids, begins = ends[order], ids[order], begins[order]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        stops = np.cumsum(sizes + 1) - 1
        first = np.searchsorted(begins, np.arange(int(stops[-1]) + 2))
        dead = np.zeros(int(stops[-1]) + 1, dtype=bool)
        at = stops - sizes
        tried = first[at]
        depth = np.zeros(len(words), dtype=np.int64)
        path = np.zeros((len(words), SHORT + 1), dtype=np.int64)
        live = np.arange(len(words))
        while len(live):
            over = tried[live] >= first[at[live] + 1]
            stuck = live[over]
            dead[at[stuck]] = True
            depth[stuck] -= 1
            back = path[stuck, depth[stuck]]
            at[stuck], tried[stuck] = begins[back], back + 1
            going = live[~over]
            match = tried[going]
            fits = ~dead[ends[match]]
            check = np.flatnonzero(fits & (depth[going] > 0))
            last = ids[path[going[check], depth[going[check]] - 1]]
            fits[check] = tables.apart(last, ids[match[check]])
            tried[going[~fits]] += 1
            going, match = going[fits], match[fits]
            path[going, depth[going]] = match
            depth[going] += 1
            at[going] = ends[match]
            tried[going] = first[at[going]]
            live = live[at[live] < stops[live]]
        used = np.arange(SHORT + 1) < depth[:, None]
        raw = ids[path[used]].astype("<u4").tobytes()
        cuts = (4 * np.concatenate(([0], np.cumsum(depth)))).tolist()
        return [raw[begin:end] for begin, end in zip(cuts[:-1], cuts[1:], strict=True)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of many words, :data:`LEARNED_AT_ONCE` at a time."""
        learned: dict[str, bytes] = {}
        for begin in range(0, len(words), LEARNED_AT_ONCE):
            learned |= self.learn_together(words[begin : begin + LEARNED_AT_ONCE])
        return learned

    def learn_together(self, words: list[str]) -> dict[str, bytes]:
        tables = self.tables
        texts = [w.encode("utf-8", "replace").decode("latin-1") for w in words]
        found = list(tables.automaton.iter_long(BETWEEN.join(texts)))
        ends = np.array([e for e, _ in found], dtype=np.int64) + 1
        ids = np.array([i for _, i in found], dtype=np.int64)
        begins = ends - (tables.offsets[ids + 1] - tables.offsets[ids])
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        stops = np.cumsum(sizes + 1) - 1
        owner = np.searchsorted(stops, begins, side="right")
        covered = np.bincount(owner, ends - begins, minlength=len(texts)) == sizes
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(ids[inside] * tables.size + ids[inside + 1], return_inverse=True)
        apart = tables.apart(pairs // tables.size, pairs % tables.size)[which]
        covered[owner[inside[~apart]]] = False
        raw = ids.astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(owner, np.arange(len(texts) + 1))).tolist()
        short = np.flatnonzero(~covered & (sizes <= SHORT)).tolist()
        searched = dict(zip(short, self.search_short([texts[i] for i in short]) if short else [], strict=True))
        learned = {}
        for i, (word, whole) in enumerate(zip(words, covered.tolist(), strict=True)):
            if whole:
                learned[word] = raw[cuts[i] : cuts[i + 1]]
            else:
                learned[word] = searched[i] if i in searched else self.search(texts[i])
        return learned

    def of_words(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of lists of words."""
        new = [w for w in set().union(*lists) if w not in self.known]
        fresh = self.learn(new) if new else {}
        if len(self.known) + len(fresh) > KNOWN_WORDS:
            # Words met before may be among those dropped: learn them again with the new ones.
            self.known = {}
            fresh |= self.learn([w for w in set().union(*lists) if w not in fresh])
        self.known.update(fresh)
        ids = [b"".join(map(self.known.__getitem__, words)) for words in lists]
        for word in fresh:
            if len(word) > KEPT_LENGTH:
                del self.known[word]
        return ids

    def of_text(self, text: str) -> bytes:
        """Ids of one text of any length, some words at a time."""
        out = []
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                out.append(np.array([self.tables.special[part]], dtype="<u4").tobytes())
                continue
            words = (m.group() for m in self.split.finditer(part))
            while some := list(islice(words, WORDS_AT_ONCE)):
                out += self.of_words([some])
        return b"".join(out)

    def of_texts(self, texts: list[str]) -> list[bytes]:
        plain = [len(t) < SLICE_BYTES and not (self.cut and self.cut.search(t)) for t in texts]
        together = iter(self.of_words([self.split.findall(t) for t, p in zip(texts, plain, strict=True) if p]))
        return [next(together) if p else self.of_text(t) for t, p in zip(texts, plain, strict=True)]


def encode_texts(docs: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """docs with ``n_tokens`` (long) and ``ids`` (binary: little-endian unsigned 32-bit numbers) of the whole texts.

    The ids are those of the tokenizer's library without special tokens added; the text of a special token counts as
    that token, as it does there. Null and empty texts have no ids. Each row is encoded on its own, so repeated rows and
    null keys don't matter; an empty table gives none. Columns of docs named ``n_tokens`` or ``ids`` give way to the
    new ones. Bytes that are no UTF-8 count as U+FFFD.
    """
    carried = docs.drop("n_tokens", "ids")
    schema = T.StructType(
        [*carried.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(byte_pairs(tokenizer_file))
        for batch in (part for b in batches for part in slices(b, text)):
            contents = batch.column(text).cast(pa.binary()).to_pylist()
            found = encoder.of_texts([(c or b"").decode("utf-8", "replace") for c in contents])
            counts = pa.array([len(ids) // 4 for ids in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, counts, pa.array(found, pa.binary())], names=[*batch.schema.names, "n_tokens", "ids"]
            )

    return carried.mapInArrow(encode, schema)


def decode_ids(encoded: DataFrame, tokenizer_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """encoded with the text of ``ids`` in column ``into``, special tokens included.

    Null ids have an empty text, ids that are no token are left out, and bytes that are no UTF-8 become U+FFFD. A
    column already named ``into`` gives way.
    """
    carried = encoded.drop(into)
    schema = T.StructType([*carried.schema.fields, T.StructField(into, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = byte_pairs(tokenizer_file)
        for batch in (part for b in batches for part in slices(b, ids)):
            texts = [tables.decode(i or b"").decode("utf-8", "replace") for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts)], names=[*batch.schema.names, into])

    return carried.mapInArrow(decode, schema)
