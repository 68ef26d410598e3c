"""Language identification by prediction by partial matching.

For each language the context trees of a bounded sample of labelled texts are counted: after every run of up to ORDER
bytes, which byte came next how often. The statistics are then frozen. A byte's code length in a language is that of
its longest context: with n occurrences and q different next bytes, a byte seen c times costs -log2(c / (n + q)), any other
an escape of -log2(q / (n + q)) and its cost in the next shorter context; below the empty context all 256
bytes are alike. A text's code length is the sum over its bytes, and the language with the shortest wins.

With frozen statistics a byte's cost depends on itself and the ORDER bytes before it only. So the trees are kept as sorted
tables of byte strings with the cost in every language, and a text is scored by binary search in numpy. Scoring is
row by row without a shuffle; the tables' size is bounded by the sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.shared import packed

#: Bytes of context.
ORDER = 3
#: Different labelled texts of each language that are fitted on, and bytes of all of them at most.
SAMPLE_ROWS = 400
SAMPLE_BYTES = 8 << 20


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """The last ``size`` bytes up to each byte as one number; bytes before the text are 0."""
    out = np.zeros(len(data), dtype=np.uint32)
    for back in range(min(size, len(data))):
        out[back:] |= data[: len(data) - back].astype(np.uint32) << np.uint32(8 * back)
    return out


def _bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text.lower(), dtype=np.uint8)


class ContextTrees:
    """Frozen statistics: code lengths in bits, per language, of a byte after its context."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER) -> None:
        self.langs = sorted(samples)
        self.order = order
        count = len(self.langs)
        counted = []  # per language and size: grams with their counts
        for lang in self.langs:
            texts = [_bytes(t) for t in samples[lang] if t]
            by_size = []
            for size in range(1, order + 2):
                grams = np.concatenate([_grams(t, size) for t in texts]) if texts else np.zeros(0, np.uint32)
                by_size.append(np.unique(grams, return_counts=True))
            counted.append(by_size)
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        lower = np.full((1, count), 8.0)  # all bytes alike
        for level in range(order + 1 if self.langs else 0):
            grams = np.unique(np.concatenate([c[level][0] for c in counted]))
            contexts = np.unique(grams >> np.uint32(8)) if level else np.zeros(1, np.uint32)
            escapes = np.zeros((len(contexts), count))
            costs = np.zeros((len(grams), count))
            below = self._cost(grams & np.uint32(256**level - 1), level - 1) if level else np.repeat(lower, len(grams), 0)
            for k in range(count):
                own, times = counted[k][level]
                at = np.searchsorted(contexts, own >> np.uint32(8)) if level else np.zeros(len(own), np.int64)
                n = np.bincount(at, times, len(contexts))
                q = np.bincount(at, minlength=len(contexts)).astype(float)
                known = n > 0
                escapes[known, k] = np.log2((n + q)[known] / q[known])
                where = np.searchsorted(contexts, grams >> np.uint32(8)) if level else np.zeros(len(grams), np.int64)
                costs[:, k] = escapes[where, k] + below[:, k]
                costs[np.searchsorted(grams, own), k] = np.log2((n + q)[at] / times)
            self.grams.append(grams)
            self.costs.append(costs.astype(np.float32))
            self.contexts.append(contexts)
            self.escapes.append(escapes.astype(np.float32))

    def _cost(self, grams: np.ndarray, level: int) -> np.ndarray:
        """Bits of each gram's last byte in each language, from contexts of up to ``level`` bytes."""
        if level < 0:
            return np.full((len(grams), len(self.langs)), 8.0, dtype=np.float32)
        table = self.grams[level]
        if len(table) == 0:
            return self._cost(grams & np.uint32(256**level - 1), level - 1)
        at = np.minimum(np.searchsorted(table, grams), len(table) - 1)
        cost = self.costs[level][at]
        new = np.flatnonzero(table[at] != grams)
        if len(new):
            less = grams[new]
            cost[new] = self._cost(less & np.uint32(256**level - 1), level - 1)
            contexts = self.contexts[level]
            before = less >> np.uint32(8) if level else np.zeros(len(less), np.uint32)
            where = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
            cost[new] += np.where((contexts[where] == before)[:, None], self.escapes[level][where], np.float32(0))
        return cost

    def bits(self, text: bytes, piece: int = 1 << 18) -> np.ndarray:
        """The code length of the text in each language."""
        grams, total = _grams(_bytes(text), self.order + 1), np.zeros(len(self.langs))
        for begin in range(0, len(grams), piece):
            total += self._cost(grams[begin : begin + piece], self.order).sum(axis=0, dtype=np.float64)
        return total


def fit(
    labelled: DataFrame, text: str = "text", lang: str = "lang",
    sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, seed: int = 11,
) -> ContextTrees:
    """Trees from the first sample_rows different texts of each language in the order of a hash of the text.

    Copies of a text count once, before anything is drawn. Whole texts are taken in that order as long as the language's
    share of sample_bytes holds them (the first always), so every labelled language is learned.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL AND text <> ''"
    )
    hashed = F.xxhash64(F.lit(seed), "text")
    different = rows.select("lang", hashed.alias("hashed")).distinct()
    counts = {r["lang"]: r["count"] for r in different.groupBy("lang").count().collect()}
    if not counts:
        return ContextTrees({})
    # So many that sample_rows of them are there whatever the hashes; the driver keeps the first.
    ample = sample_rows + 10 * sample_rows**0.5 + 50
    draw = F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, ample / n))])
    budget = sample_bytes // len(counts)
    drawn = rows.filter(draw < share[F.col("lang")]).select("lang", "text", draw.alias("draw"))
    distinct = drawn.groupBy("lang", "text").agg(F.min("draw").alias("draw"))
    samples: dict[str, list[bytes]] = {k: [] for k in counts}
    size, seen = dict.fromkeys(counts, 0), dict.fromkeys(counts, 0)
    for row in distinct.orderBy("draw", "lang", "text").toLocalIterator():
        data, lang = row["text"].encode(), row["lang"]
        seen[lang] += 1
        if seen[lang] <= sample_rows and (size[lang] + len(data) <= budget or not samples[lang]):
            samples[lang].append(data)
            size[lang] += len(data)
    return ContextTrees(samples)


def identify(docs: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """docs with lang_pred, score and bits_per_byte.

    score is the share of the winning language among all, each weighted by 2 ** -(code length); equal lengths go to
    the first name. A text that is null, empty or without a letter is ``und`` with score 0 and no
    bits_per_byte, and so is every text where no language was learned. Copies get equal results. Columns of docs
    named like a result are replaced.
    """
    results = ("lang_pred", "score", "bits_per_byte")
    known = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("lang_pred string, score double, bits_per_byte double")
    def predict(texts: pa.Array) -> pa.Array:
        model = known.value
        names, scores, rates = [], [], []
        for value in (v for at in range(0, len(texts), 500) for v in texts.slice(at, 500).cast(pa.binary()).to_pylist()):
            if not value:
                names.append("und"), scores.append(0.0), rates.append(None)
                continue
            bits = model.bits(value)
            best = int(bits.argmin())
            names.append(model.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()))
            rates.append(float(bits[best] / len(value)))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
            names=["lang_pred", "score", "bits_per_byte"],
        )

    body = F.col(f"row.`{text}`")
    letters = F.when(body.rlike("\\p{L}"), body)
    judged = packed(docs, "row")
    if trees.langs:
        judged = judged.withColumn("p", predict(F.coalesce(letters, F.lit(""))))
    else:
        judged = judged.withColumn(
            "p", F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_byte"))
        )
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in results]
    return judged.select(*others, "p.*")
