"""From raw documents to packed sequences: the corpus pipeline.

Each stage works on all that the one before kept, and returns the columns of ``documents``; the last
returns the pieces of the packed sequences. A stage that drops documents drops whole rows and leaves
the others as they are. Decisions go by a key made of all of a row, so rows without an id and rows that
share one are told apart. Of equal and of similar documents the one with the smallest id stays, one without an id only
where none has one, and one row of those that repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clustertrace.llm.exact_dedup import exact_duplicates
from clustertrace.llm.language_id import identify
from clustertrace.llm.ngram_join import similar_documents
from clustertrace.llm.queries import packed, table
from clustertrace.llm.shared import small_batches, stored
from clustertrace.llm.toxicity import fit, score

_KEY, _ROW, _AT, _WORD, _BITS = "__key", "__row", "__at", "__word", "__bits"
_TEXT, _LANGUAGE, _HOST, _ID = "text", "lang", "source", "doc_id"
_TOXIC = 0.5
#: Log of the bits that tell which rows a list of keys may hold: 262,144 words at most are sent to tasks.
_BITMAP = 24


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a digest of the whole row."""
    return docs.withColumn(_KEY, F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).cast("binary")))


def _split(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyed documents that aren't among ``keys`` for certain, and those that may be.

    A bitmap of the keys' hashes, of bounded size, tells them apart, so whole rows of the former needn't be shuffled
    however long the list is.
    """
    at = F.pmod(F.xxhash64(_KEY), F.lit(1 << _BITMAP))
    word, bit = F.shiftright(_AT, 6).alias(_WORD), (F.col(_AT) % 64).cast("int")
    set_bits = F.bit_or(F.expr(f"shiftleft(1L, CAST({_AT} % 64 AS INT))")).alias(_BITS)
    bitmap = keys.select(at.alias(_AT)).groupBy(word).agg(set_bits)
    rows = _keyed(docs).withColumn(_AT, at).withColumn(_WORD, word).join(F.broadcast(bitmap), _WORD, "left")
    listed = F.coalesce(F.getbit(_BITS, bit) == 1, F.lit(False))
    columns = [F.col(f"`{c}`") for c in (*docs.columns, _KEY)]
    return rows.filter(~listed).select(*columns), rows.filter(listed).select(*columns)


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose keys aren't listed; the list is written first, so that Spark knows its size."""
    dropped = stored(keys.distinct(), "dropped")
    clear, others = _split(docs, dropped)
    return clear.unionByName(others.join(dropped, _KEY, "left_anti")).drop(_KEY)


def _others(groups: DataFrame) -> DataFrame:
    """The keys of all rows but one of each ``group``; given with their ids as ``id``."""
    order = F.struct(F.col("id").isNull().alias("none"), "id", _KEY)
    first = groups.groupBy("group").agg(F.min(order)[_KEY].alias("first"), F.min(_KEY).alias("least"), F.max(_KEY).alias("most"))
    several = first.filter("least <> most").select("group", "first")
    return groups.join(several, "group").filter(F.col(_KEY) != F.col("first")).select(_KEY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in an identified language."""
    with small_batches(spark):
        found = identify(_keyed(docs).select(_KEY, _TEXT, _LANGUAGE, _HOST), id_col=_KEY)
        return _without(docs, found.filter("NOT kept").select(_KEY))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't find toxic."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    with small_batches(spark):
        scores = score(_keyed(docs).select(_KEY, _TEXT), model, id_col=_KEY)
        return _without(docs, scores.filter(F.col("score") >= _TOXIC).select(_KEY))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    found = exact_duplicates(_keyed(docs).select(_KEY, _ID, _TEXT))
    groups = stored(found.select(_KEY, F.col(_ID).alias("id"), F.col("duplicate.text_sha256").alias("group")), "equal")
    dropped = stored(_others(groups).distinct(), "dropped")
    # Rows that repeat as a whole share a key; one of them stays.
    repeated = groups.groupBy(_KEY).count().filter("count > 1").select(_KEY)
    clear, others = _split(docs, stored(dropped.unionByName(repeated), "listed"))
    once = others.join(dropped, _KEY, "left_anti").dropDuplicates([_KEY])
    return clear.unionByName(once).drop(_KEY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    with small_batches(spark):
        rows = _keyed(docs).withColumn(_ROW, F.xxhash64(_KEY))
        found = similar_documents(rows.select(_ROW, _TEXT), id_col=_ROW)
        found = found.select(_ROW, F.col("component_id").alias("group"))
        groups = found.join(rows.select(_ROW, _KEY, F.col(_ID).alias("id")), _ROW).select(_KEY, "id", "group")
        return _without(docs, _others(stored(groups, "similar")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    with small_batches(spark):
        return packed(docs)


STAGES = [
    ("language ID", language),
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("packing", packing),
]

#: SQL can't express the classifiers and the tokenizer; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
