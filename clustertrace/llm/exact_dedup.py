"""Exact deduplication by a 128-bit content hash, confirmed byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import stored, text_or_empty

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space replaced by one space; NULL is empty."""
    return F.regexp_replace(text_or_empty(text), WHITE_SPACE, " ")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """Every row of ``docs`` with the column ``duplicate``, a struct of its decision.

    ``duplicate`` holds ``keep_id`` (smallest id among equal texts), ``group_size``, ``kept`` and
    ``text_sha256`` (lowercase hex of the normalised text in UTF-8).

    Rows are grouped by ``digest`` (128 bits) and, inside a digest, by the text itself, so that the
    bytes are compared. Both steps have a map-side part: a group with a third of all rows costs a
    row per map task. Only the small summary by digest is joined back. Digests that hold more than
    one text, if there are any, are joined by digest and text instead.

    NULL and empty texts are equal. A row without an id is kept only if no row of its group has one,
    and ``keep_id`` is NULL then. Rows that repeat the smallest id with an equal text are all kept.
    An input column named ``duplicate`` is replaced; an empty table gives none.
    """
    rows = docs.select(
        *(F.col(f"`{c}`") for c in docs.columns if c.lower() != "duplicate"),
        normalised(text_col).alias("__text"),
    )
    # The SHA-256 is taken before the join, so that texts nobody asks for stay out of the shuffle.
    rows = rows.withColumns({"__hash": digest(F.col("__text")), "__sha": F.sha2("__text", 256)})
    texts = rows.groupBy("__hash", "__text").agg(
        F.min(f"`{id_col}`").alias("__keep"), F.count(F.lit(1)).alias("__size")
    )
    summary = stored(
        texts.groupBy("__hash").agg(
            F.min("__keep").alias("__keep"),
            F.sum("__size").alias("__size"),
            F.count(F.lit(1)).alias("__texts"),
        ),
        "exact",
    )
    one = summary.filter("__texts = 1").drop("__texts")
    several = summary.filter("__texts > 1").select("__hash")
    joined = rows.join(one, "__hash")
    if not several.isEmpty():
        among = rows.join(several, "__hash", "left_semi")
        exact = texts.join(several, "__hash", "left_semi")
        joined = joined.unionByName(among.join(exact, ["__hash", "__text"]))
    decision = F.struct(
        F.col("__keep").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col(f"`{id_col}`").eqNullSafe(F.col("__keep")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
    return joined.withColumn("duplicate", decision).drop("__hash", "__text", "__sha", "__keep", "__size")
