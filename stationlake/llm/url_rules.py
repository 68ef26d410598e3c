"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits a url when the url's host is the rule's host or one of its
subdomains and the url's path starts with the rule's path. The rule with the longest text
(host and path together) wins; of equally long ones that with the longer host, then the
greater text. Hosts are turned round (``com.example.www``), a url is looked up once below each of
its parent hosts, and there a path prefix is an interval of sorted paths. Intervals of one host
nest or are apart, so a sweep over the sorted starts, ends and urls needs a stack only: a start
makes its rule the active one, an end gives way to the rule around it. Which rule is around which is
worked out on the rules alone; the sweep itself is one running window.

Scale: urls are made distinct first, so a url that a third of all pages has is one row. A parent
host under which very many urls lie (``com``) is dealt over as many groups as its measured
count asks for, and only its own rules are repeated for them. Nothing is broadcast by this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.shared import lower_ascii, packed, without

#: Urls of one parent host that are swept together.
GROUP_ROWS = 200_000


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?``, ``#`` or end; A-Z in lower case."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _turned(host: Column) -> Column:
    return F.concat_ws(".", F.reverse(F.split(host, "\\.")))


def _usable(rules: DataFrame) -> DataFrame:
    """Distinct rules; of two with one host and path the greater verdict stays (block)."""
    path = F.coalesce(F.col("path"), F.lit(""))
    return (
        rules.filter(F.col("host").isNotNull() & (F.col("host") != "") & F.col("verdict").isNotNull())
        .select(lower_ascii(F.col("host")).alias("host"), path.alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )


def boundaries(rules: DataFrame) -> DataFrame:
    """Every start and end of a rule's interval, with the rule that is active from there on.

    Columns: turned (reversed host), edge (binary sort key), active (struct; its fields are null
    where no rule is active any more).
    """
    text = F.concat("host", "path")
    rule = F.struct(
        F.length(text).alias("size"),
        F.length("host").alias("host_size"),
        text.alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    begin = F.encode(F.col("path"), "UTF-8")
    # No UTF-8 text holds the byte FF: the end sorts behind all that starts with the path.
    events = rules.select(
        _turned(F.col("host")).alias("turned"),
        rule.alias("rule"),
        begin.alias("begin"),
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("step"), begin.alias("edge")),
                F.struct(F.lit(-1).alias("step"), F.concat(begin, F.unhex(F.lit("FF"))).alias("edge")),
            )
        ).alias("event"),
    ).select("turned", "rule", "begin", "event.*")
    sweep = Window.partitionBy("turned").orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    depth = events.withColumn("depth", F.sum("step").over(sweep))
    starts = depth.filter("step = 1").select("turned", "rule", "begin", "depth")
    # The rule around one of depth d is the last of depth d - 1 that began before it.
    asked = starts.select(
        "turned", "rule", "begin", (F.col("depth") - 1).alias("level"), F.lit(True).alias("asks")
    ).unionByName(
        starts.select("turned", "rule", "begin", F.col("depth").alias("level"), F.lit(False).alias("asks"))
    )
    stack = (
        Window.partitionBy("turned", "level")
        .orderBy("begin", "asks")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    around = F.last(F.when(~F.col("asks"), F.col("rule")), ignorenulls=True).over(stack)
    nested = asked.withColumn("around", around).filter("asks")
    none = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in _rule_fields()])
    return nested.select(
        "turned",
        F.explode(
            F.array(
                F.struct(F.col("begin").alias("edge"), F.col("rule").alias("active")),
                F.struct(
                    F.concat("begin", F.unhex(F.lit("FF"))).alias("edge"),
                    F.coalesce(F.col("around"), none).alias("active"),
                ),
            )
        ).alias("b"),
    ).select("turned", "b.edge", "b.active")


def _rule_fields() -> list[tuple[str, str]]:
    return [("size", "int"), ("host_size", "int"), ("rule", "string"), ("verdict", "string")]


def best_rules(urls: DataFrame, rules: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(host, path, rule, verdict) for each distinct (host, path) of urls that some rule fits."""
    usable = _usable(rules)
    longest = usable.agg(
        F.max(F.size(F.split("host", "\\."))).alias("labels"), F.max(F.length("path")).alias("path")
    ).first()
    labels, path_size = longest["labels"] or 1, longest["path"] or 0
    parts = F.split("host", "\\.")
    # Parent hosts of more labels than any rule has, and what is longer than any rule's path, can't matter.
    parents = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.concat_ws(".", F.reverse(F.slice(parts, -n, n))),
    )
    probes = (
        urls.filter("host <> ''").select("host", "path").distinct()
        .select("host", "path", F.explode(parents).alias("turned"))
    )
    edges = boundaries(usable)
    hosts = usable.select(_turned(F.col("host")).alias("turned")).distinct()
    spread = (
        probes.join(hosts, "turned", "left_semi").groupBy("turned")
        .agg(F.ceil(F.count("*") / group_rows).cast("int").alias("groups"))
    )
    swept_urls = probes.join(spread, "turned").select(
        "turned",
        F.pmod(F.xxhash64("host", "path"), F.col("groups")).cast("int").alias("group"),
        F.encode(F.substring("path", 1, path_size + 1), "UTF-8").alias("edge"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(edges.schema["active"].dataType).alias("active"),
        "host",
        "path",
    )
    swept_edges = edges.join(spread, "turned").select(
        "turned",
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
        "edge",
        F.lit(0).alias("kind"),
        "active",
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
    )
    sweep = (
        Window.partitionBy("turned", "group").orderBy("edge", "kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        swept_edges.unionByName(swept_urls)
        .withColumn("found", F.last("active", ignorenulls=True).over(sweep))
        .filter("kind = 1 AND found.rule IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("found").alias("found"))
        .select("host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """pages with host, path, rule and verdict for every row.

    rules has host, path and verdict (allow or block); rows without host or verdict are left out, a null
    path is empty, and a path means a prefix of any characters. Where no rule fits, rule is null and
    verdict is ``default``. A null url, and one without ``://``, has an empty host and path, and no rule
    fits it. Repeated rows stay. Columns of pages named like a result are replaced.
    """
    results = ("host", "path", "rule", "verdict")
    held = packed(pages, "row").select("row", host_of(F.col(f"row.`{url}`")).alias("host"), path_of(F.col(f"row.`{url}`")).alias("path"))
    best = best_rules(held, rules, group_rows)
    judged = held.join(best, ["host", "path"], "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit(default))
    )
    kept = [c for c in pages.columns if c.lower() not in results]
    return judged.select(*[F.col(f"row.`{c}`") for c in kept], *results)
