"""Quality rules as a short-circuit cascade.

Every rule reads a few measures of the text. On a sample of rows the cost of each rule (seconds
of work on the sample) and its selectivity (share of rows it rejects, among those the rules before it
let through) are estimated, and the rules are ordered by rejections per cost. In the cascade a
measure is only computed for rows that all rules before it have let through. The order changes the
work, never the verdict: a row is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.shared import packed, words_between

#: The characters that count as symbols, and the white space between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Rows the order of the rules is estimated on, about.
SAMPLE_ROWS = 2_000


def _only(alive: Column, value: Column) -> Column:
    return F.when(alive, value)


def _n_words(df: DataFrame, alive: Column) -> DataFrame:
    return df.withColumn("n_words", _only(alive, F.size("words").cast("long")))


def _word_chars(df: DataFrame, alive: Column) -> DataFrame:
    chars = F.length(F.translate("text", BLANKS, ""))
    return df.withColumn("word_chars", _only(alive, chars.cast("long")))


def _n_symbols(df: DataFrame, alive: Column) -> DataFrame:
    found = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    return df.withColumn("n_symbols", _only(alive, found.cast("long")))


def _with_lines(df: DataFrame, alive: Column) -> DataFrame:
    """Lines with a word; null where there is one line only, or nobody asks."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return df.withColumn("lines", _only(alive & (F.instr("text", "\n") > 0), lines))


def _n_dup_lines(df: DataFrame, alive: Column) -> DataFrame:
    """Lines with a word that equal an earlier line."""
    repeated = F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0))
    df = _with_lines(df, alive).withColumn("n_dup_lines", _only(alive, repeated.cast("long")))
    return df.drop("lines")


def _n_lines(df: DataFrame, alive: Column) -> DataFrame:
    """Lines with a word."""
    one = F.least(F.size("words"), F.lit(1))
    lines = F.coalesce(F.size("lines"), one).cast("long")
    return _with_lines(df, alive).withColumn("n_lines", _only(alive, lines)).drop("lines")


def _n_repeat_words(df: DataFrame, alive: Column) -> DataFrame:
    """Words in windows of three that are found at least twice.

    Windows stand for their 64-bit hash (chance of a false repeat in a text of n words: n**2 / 2**65).
    Texts without a repeat end after a hash set; else sorting brings equal windows together, and
    the starts of repeated ones, in order, give the words they cover. n log n in the words of a text.
    """
    windows = F.when(
        alive & (F.size("words") >= 4),
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
        ),
    )
    ordered = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
    )

    def again(x, k):
        return (F.get("ordered", k - 1)["h"] == x["h"]) | (F.get("ordered", k + 1)["h"] == x["h"])

    starts = F.sort_array(
        F.transform(
            F.filter("ordered", lambda x, k: F.coalesce(again(x, k), F.lit(False))), lambda x: x["at"]
        )
    )
    gains = F.transform(
        "starts", lambda at, k: F.coalesce(F.least(F.get("starts", k + 1) - at, F.lit(3)), F.lit(3))
    )
    covered = F.aggregate(gains, F.lit(0), lambda sum_, gain: sum_ + gain)
    return (
        df.withColumn("windows", windows)
        .withColumn("ordered", ordered)
        .withColumn("starts", starts)
        .withColumn("n_repeat_words", _only(alive, F.coalesce(covered, F.lit(0)).cast("long")))
        .drop("windows", "ordered", "starts")
    )


#: How each measure is added to rows with text (not null) and words.
MEASURES: dict[str, Callable[[DataFrame, Column], DataFrame]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_lines": _n_lines,
    "n_repeat_words": _n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """fails: SQL condition over the measures that rejects a row."""

    name: str
    measures: tuple[str, ...]
    fails: str


#: The first two are the base; the others allow for anything but plainly broken text.
RULES = (
    Rule("few_words", ("n_words",), "n_words < 50"),
    Rule("repeated_words", ("n_words", "n_repeat_words"), "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", ("n_words", "n_symbols"), "100 * n_symbols > 50 * n_words"),
    Rule("word_length", ("n_words", "word_chars"), "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), "100 * n_dup_lines > 40 * n_lines"),
)


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    return packed(docs, "row").withColumn("text", whole).withColumn("words", words_between(F.col("text")))


def _measured(df: DataFrame, names: Sequence[str], alive: Column) -> DataFrame:
    for name in names:
        if name not in df.columns:
            df = MEASURES[name](df, alive)
    return df


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    cost: float
    selectivity: float


def plan_cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> list[Estimate]:
    """The rules in the order of the cascade, with what was estimated on a sample of about sample_rows rows.

    Greedy: next comes the rule that rejects most of the sample's remaining rows per second. Rules
    that reject nothing come last, the cheapest of them first. An empty table keeps the given order.
    """
    rows = docs.count()
    if rows == 0:
        return [Estimate(rule, 0.0, 0.0) for rule in rules]
    sample = docs.select(text).sample(min(1.0, sample_rows / rows), seed=seed).persist()
    try:
        everything = _measured(_prepared(sample, text), [m for r in rules for m in r.measures], F.lit(True))
        failing = [F.coalesce(F.expr(rule.fails), F.lit(False)).cast("int").alias(rule.name) for rule in rules]
        patterns = [tuple(p) for p in everything.select(*failing).groupBy(*[r.name for r in rules]).count().collect()]
        cost = {}
        for rule in rules:
            one = _measured(_prepared(sample, text), rule.measures, F.lit(True))
            began = time.perf_counter()
            one.agg(F.sum(F.expr(rule.fails).cast("int"))).first()
            cost[rule.name] = time.perf_counter() - began
    finally:
        sample.unpersist()
    left, order, remaining = patterns, [], list(range(len(rules)))
    while remaining:
        total = sum(p[-1] for p in left) or 1
        share = {i: sum(p[-1] for p in left if p[i]) / total for i in remaining}
        best = max(remaining, key=lambda i: (share[i] / cost[rules[i].name], -cost[rules[i].name]))
        order.append(Estimate(rules[best], cost[rules[best].name], share[best]))
        left = [p for p in left if not p[best]]
        remaining.remove(best)
    return order


def judge_quality(
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    complete: Sequence[str] = (),
) -> DataFrame:
    """docs with kept, failed_rule and the measures of the rules.

    rules run in the order given; by default RULES in the order that ``plan_cascade`` finds. A measure
    no rule asked for any more is null, unless ``complete`` names it: then it is filled in
    afterwards. failed_rule is the first rule of the cascade that rejects the row. A null text counts as
    empty: no words, rejected by few_words. Columns of docs named like a result are replaced.
    """
    if rules is None:
        rules = [e.rule for e in plan_cascade(docs, RULES, text, sample_rows)]
    df = _prepared(docs, text).withColumn("failed_rule", F.lit(None).cast("string"))
    for rule in rules:
        df = _measured(df, rule.measures, F.col("failed_rule").isNull())
        df = df.withColumn(
            "failed_rule",
            F.when(F.col("failed_rule").isNotNull(), F.col("failed_rule")).when(F.expr(rule.fails), rule.name),
        )
    names = [m for m in MEASURES if m in df.columns]
    for name in complete:
        if name not in names:
            df, names = MEASURES[name](df, F.lit(True)), [*names, name]
        else:
            df = df.withColumnRenamed(name, "early")
            df = MEASURES[name](df, F.col("early").isNull())
            df = df.withColumn(name, F.coalesce("early", F.col(name))).drop("early")
    results = [*names, "kept", "failed_rule"]
    others = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in results]
    return df.withColumn("kept", F.col("failed_rule").isNull()).select(*others, *results)
