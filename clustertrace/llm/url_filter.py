"""Allow and block rules for URLs, matched by hashed host suffixes and path prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import put, text_or_empty

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, with A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What lies between the host and the next ``?`` or ``#``; else empty."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: str, path: str) -> Column:
    return F.sha2(F.concat(F.col(host), F.lit(" "), F.col(path)), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    prefix_digits: int = 8,
    broadcast_rules: int = 500_000,
) -> DataFrame:
    """Every row of ``pages`` with the columns ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``). A rule fits its host
    and all subdomains, if the path of the URL starts with the rule's. Of several that fit, the one
    with the longest ``host`` and ``path`` together decides, then the longer host, then ``block``.
    Without a fitting rule ``rule`` is NULL and ``verdict`` is ``default``.

    Each distinct pair of host and path is expanded into its host suffixes (of as many labels as rules have) times
    its path prefixes (of the lengths that rules have), which bounds them whatever the URL's length, joined with the
    rules on the first ``prefix_digits`` hexadecimal digits of a SHA-256, and confirmed by the full
    digest. Rules are broadcast only when counted at ``broadcast_rules`` or fewer, else shuffled.
    URLs that repeat are judged once: pairs are made distinct on the map side first.

    NULL and empty URLs, and those without ``://``, have empty host and path. Rules with a NULL or
    an empty host or a NULL path are void. Input columns named like a result column are replaced.
    """
    url = text_or_empty(F.col(f"`{url_col}`"))
    rows = put(pages, host=url_host(url), path=url_path(url))

    listed = (
        rules.filter("host <> '' AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max((F.col("verdict") == "block").cast("bigint")).alias("__block"))
        .withColumn("__digest", _digest("host", "path"))
        .withColumn("__prefix", F.substring("__digest", 1, prefix_digits))
    )
    n_labels = F.size(F.split("host", r"\."))
    levels = sorted(r[0] for r in listed.select(n_labels).distinct().collect())
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())
    n_rules = listed.limit(broadcast_rules + 1).count()
    side = listed.select("__digest", "__prefix", "__block")
    side = F.broadcast(side) if n_rules <= broadcast_rules else side

    labels = F.split("host", r"\.")
    deep = F.filter(F.array(*map(F.lit, levels)), lambda n: n <= F.size(labels))
    suffixes = F.transform(deep, lambda n: F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))

    distinct = rows.filter("host <> ''").select("host", "path").distinct()
    # The rule's host and path are parts of the URL's own, so their lengths are enough.
    order = (
        (F.length("__h") + F.length("__p")).cast("bigint") * F.lit(1 << 32)
        + F.length("__h").cast("bigint") * 2
        + F.col("__block")
    )
    best = (
        distinct.withColumn("__h", F.explode(suffixes))
        .withColumn("__p", F.explode(prefixes))
        .withColumn("__own", _digest("__h", "__p"))
        .withColumn("__prefix", F.substring("__own", 1, prefix_digits))
        .join(side, "__prefix")
        .filter(F.col("__own") == F.col("__digest"))
        .groupBy("host", "path")
        .agg(F.max(order).alias("__best"))
    )
    both = F.shiftright("__best", 32).cast("int")
    host_len = (F.col("__best").bitwiseAND(F.lit((1 << 32) - 1)) / 2).cast("int")
    rule = F.concat(
        F.substring(F.col("host"), F.length("host") - host_len + 1, host_len),
        F.substring(F.col("path"), F.lit(1), both - host_len),
    )
    verdict = F.when(F.col("__best") % 2 == 1, "block").otherwise("allow")
    found = F.col("__best").isNotNull()
    return put(
        rows.join(best, ["host", "path"], "left"),
        rule=F.when(found, rule),
        verdict=F.when(found, verdict).otherwise(default),
    ).drop("__best")
