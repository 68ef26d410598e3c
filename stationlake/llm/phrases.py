"""Benchmark passages in a corpus, by a positional inverted index.

Items are cut into windows of consecutive words. How often each word of the items occurs in the
corpus is counted, and of every window the two rarest words are chosen. For the chosen words
only (no one asks for the others) the corpus is indexed: a list of places per word and text, written
to the shared folder. A window's two lists are intersected after each place has been moved
back by the word's place in the window; a place that is left over is a phrase when the
words around it, kept with the rarest word's posting, are the window's. The lists also answer
proximity: the two words near each other, in any order.

Scale: a text stands for all its copies (md5), so lists do not grow with copies, and results are
joined to the rows by it; no text is shuffled. Of the corpus only places of chosen words are shuffled.
The chosen words are broadcast; windows are taken in blocks of a measured size, so that a
broadcast keeps below BLOCK_BYTES however many items there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import lower_ascii, packed, staged, words_between

#: Fixed value: what stands between words (everything below 0x80 that is no digit or letter).
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Bytes of window text that one pass over the corpus serves.
BLOCK_BYTES = 8 << 20


def phrase_words(text: Column) -> Column:
    return words_between(lower_ascii(text), BETWEEN)


def windows_of(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(item_id text, words) for every distinct window; an item of fewer words is one window."""
    words = items.select(
        F.col(f"`{item_id}`").cast("string").alias("item_id"), phrase_words(F.col(f"`{text}`")).alias("all")
    ).filter(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - size + 1, F.lit(1)))
    return (
        words.select("item_id", "all", F.explode(starts).alias("at"))
        .select("item_id", F.slice("all", F.col("at"), size).alias("words"))
        .distinct()
    )


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """Key and words of each row that has words."""
    return docs.select(
        F.md5(F.col(f"`{text}`")).alias("text_key"), phrase_words(F.col(f"`{text}`")).alias("words")
    )


def frequencies(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of the vocabulary occurs in the texts (0 if it doesn't)."""
    counts = (
        texts.select(F.explode("words").alias("term"))
        .join(F.broadcast(vocabulary), "term", "left_semi")
        .groupBy("term")
        .count()
    )
    return vocabulary.join(counts, "term", "left").select(
        "term", F.coalesce("count", F.lit(0)).alias("count")
    )


def rarest_two(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows with the places and words of their two rarest words (one word: twice that)."""
    placed = windows.select(
        "item_id", "words", F.posexplode("words").alias("offset", "term")
    ).join(counts, "term")
    rank = F.struct(F.col("count"), F.col("offset"), F.col("term"))
    two = placed.groupBy("item_id", "words").agg(
        F.slice(F.sort_array(F.collect_list(rank)), 1, 2).alias("rare")
    )
    first, second = F.col("rare")[0], F.coalesce(F.get("rare", F.lit(1)), F.get("rare", F.lit(0)))
    return two.select(
        "item_id",
        "words",
        first["term"].alias("term"),
        first["offset"].alias("offset"),
        first["count"].alias("count"),
        second["term"].alias("term2"),
        second["offset"].alias("offset2"),
        second["count"].alias("count2"),
    )


def build_index(texts: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """(term, text_key, places) with places an array of (at, first, around), for the words of chosen.

    chosen: (term, anchor). around holds the words within size - 1 places of an anchor, from place ``first``.
    """
    start = F.greatest(F.col("at") - (size - 1), F.lit(0))
    around = F.when(F.col("anchor"), F.slice("words", start + 1, 2 * size - 1))
    return (
        texts.select("text_key", "words", F.posexplode("words").alias("at", "term"))
        .join(F.broadcast(chosen), "term")
        .select("term", "text_key", F.struct("at", start.alias("first"), around.alias("around")).alias("place"))
        .groupBy("term", "text_key")
        .agg(F.collect_set("place").alias("places"))
    )


def _joined(index: DataFrame, windows: DataFrame) -> DataFrame:
    first = index.select("term", "text_key", "places")
    second = index.select(
        F.col("term").alias("term2"), "text_key", F.transform("places", lambda p: p["at"]).alias("places2")
    )
    return first.join(windows, "term").join(second, ["term2", "text_key"])


def phrases(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(text_key, item_id, start, size) of every place where a window stands word by word."""
    both = _joined(index, windows).withColumn(
        "starts",
        F.array_intersect(
            F.transform("places", lambda p: p["at"] - F.col("offset")),
            F.transform("places2", lambda at: at - F.col("offset2")),
        ),
    )
    found = both.filter(F.size("starts") > 0).select(
        "text_key", "item_id", "words", "offset", "starts", F.explode("places").alias("place")
    )
    start = F.col("place.at") - F.col("offset")
    here = F.slice("place.around", F.greatest(start - F.col("place.first") + 1, F.lit(1)), F.size("words"))
    return found.filter(
        (start >= 0) & F.array_contains("starts", start) & (here == F.col("words"))
    ).select("text_key", "item_id", start.alias("start"), F.size("words").alias("size"))


def near(index: DataFrame, windows: DataFrame, within: int) -> DataFrame:
    """(text_key, item_id, words): texts where a window's two rarest words stand within so many words."""
    return (
        _joined(index, windows)
        .filter(
            F.exists(
                "places",
                lambda p: F.exists("places2", lambda at: F.abs(at - p["at"]) <= F.lit(within)),
            )
        )
        .select("text_key", "item_id", "words")
        .distinct()
    )


def _blocks(windows: DataFrame) -> list[DataFrame]:
    """Windows in blocks of about BLOCK_BYTES of text."""
    size = windows.agg(F.sum(F.octet_length(F.concat_ws(" ", "words")))).first()[0] or 0
    if size == 0:
        return []
    n = -(-size // BLOCK_BYTES)
    return [windows.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == i) for i in range(n)]


def index_for(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, size: int) -> list[tuple[DataFrame, DataFrame]]:
    """(index, windows) for each block of windows; the index is written to the shared folder."""
    texts = _texts(docs, text)
    made = []
    for block in _blocks(staged(windows_of(items, item_id, item_text, size), "windows")):
        vocabulary = block.select(F.explode("words").alias("term")).distinct()
        windows = staged(rarest_two(block, frequencies(texts, vocabulary)), "rare-words")
        # A window with a word the corpus lacks can't occur.
        windows = windows.filter("count > 0")
        chosen = (
            windows.select("term", F.lit(True).alias("anchor"))
            .unionByName(windows.select(F.col("term2").alias("term"), F.lit(False).alias("anchor")))
            .groupBy("term")
            .agg(F.max("anchor").alias("anchor"))
        )
        made.append((staged(build_index(texts, chosen, size), "postings"), windows))
    return made


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = 10,
) -> DataFrame:
    """docs with n_words, n_hit, items (sorted texts of item ids), spans and contaminated.

    spans are the maximal runs [start, end) of words inside some occurrence of a window; n_hit counts
    their words. A null or empty text has no words and no hits. Items without words find nothing; of
    items that share an id the windows count together; an item with a null id makes hits
    but is not listed. Rows with equal texts get equal results. Columns of docs named like a
    result are replaced.
    """
    results = ("n_words", "n_hit", "items", "spans", "contaminated")
    made = [phrases(*block) for block in index_for(docs, items, text, item_id, item_text, size)]
    rows = packed(docs, "row").select(
        "row",
        F.md5(F.col(f"row.`{text}`")).alias("text_key"),
        F.size(phrase_words(F.col(f"row.`{text}`"))).cast("long").alias("n_words"),
    )
    span = "array<struct<start:int,end:int>>"
    if made:
        found = reduce(DataFrame.unionByName, made)
        by_text = found.groupBy("text_key").agg(
            F.sort_array(F.collect_set(F.struct("start", "size"))).alias("at"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
        joined = F.aggregate(
            "at",
            F.lit(None).cast(span),
            lambda done, x: F.when(
                done.isNull(), F.array(F.struct(x["start"].alias("start"), (x["start"] + x["size"]).alias("end")))
            ).otherwise(_joined_spans(done, x)),
        )
        by_text = by_text.select("text_key", "items", joined.alias("spans"))
        rows = rows.join(by_text, "text_key", "left")
    else:
        rows = rows.withColumn("items", F.lit(None).cast("array<string>")).withColumn("spans", F.lit(None).cast(span))
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(span)))
    rows = rows.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    rows = rows.withColumn("n_hit", hit.cast("long")).withColumn("contaminated", F.col("n_hit") > 0)
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in results]
    return rows.select(*others, *results)


def _joined_spans(done: Column, x: Column) -> Column:
    """The spans so far with one more window, which begins no earlier than the last span."""
    last = F.element_at(done, -1)
    end = x["start"] + x["size"]
    return F.when(
        x["start"] <= last["end"],
        F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))),
        ),
    ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), end.alias("end")))))
