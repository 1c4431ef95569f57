"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import give_back, stored
from clustertrace.llm.words import lower_latin, slices

_BITS = 16
_SPREAD = np.uint32(0x9E3779B1)


def letter_trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of the byte trigrams of lower-cased letters, at most one space at either end, and their texts."""
    low = lower_latin(data)
    low = np.where((low < 128) & ((low < 97) | (low > 122)), 32, low).astype(np.uint32)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if len(low) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = low[:-2], low[1:-1], low[2:]
    valid = (b != 32) & ((a != 32) | (c != 32)) & (text[:-2] == text[2:])
    value = (a << np.uint32(16) | b << np.uint32(8) | c) * _SPREAD >> np.uint32(32 - _BITS)
    return value[valid].astype(np.int64), text[:-2][valid]


@dataclass
class TextModel:
    """Log-probabilities of trigrams per language, in the order of ``languages``.

    ``merged`` names the language that stands for another declared one, whose texts are like its own.
    """

    languages: list[str]
    table: np.ndarray
    saturation: float
    merged: dict[str, str] = field(default_factory=dict)

    def log_likelihoods(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row per text with a column per language and a last one for none of them; and its trigrams.

        Neighbouring trigrams are no independent evidence: n of them count as n / (1 + n / saturation).
        None of the languages means that every table row is as likely.
        """
        n_classes = len(self.languages) + 1
        out, n = np.zeros((len(texts), n_classes)), np.zeros(len(texts))
        for first, data, bounds in slices(texts):
            rows, text = letter_trigrams(data, bounds)
            size = len(bounds) - 1
            counts = np.bincount(text, minlength=size)
            n[first : first + size] = counts
            weight = 1 / (1 + counts / self.saturation)
            for k in range(n_classes - 1):
                total = np.bincount(text, self.table[k][rows], size)
                out[first : first + size, k] = total * weight
            out[first : first + size, -1] = -np.log(1 << _BITS) * counts * weight
        return out, n


def canonical(tag: Column) -> Column:
    """A declared language as it is compared: its first subtag, lower-cased; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(tag.cast("string"), r"^\s*([^-_\s]*)", 1)), F.lit(""))


def _tables(samples: dict[str, np.ndarray], rows: dict[str, int], smoothing: float, alike: float, most_languages: int) -> tuple[list[str], np.ndarray, dict[str, str]]:
    """Languages with a log-table each, from counts of trigrams, and those that another one stands for.

    The languages come with the most declared first. One whose texts are nearly as likely in an earlier table as that
    language's own is merged into it: the difference per trigram, as a share of what the own texts are above none of
    the languages, is below ``alike``; half as much again may differ, divided by the root of the rows, as few rows differ by chance.
    """
    languages: list[str] = []
    counts: list[np.ndarray] = []
    logs: list[np.ndarray] = []
    merged: dict[str, str] = {}
    flat = -np.log(1 << _BITS)

    def log_table(own: np.ndarray) -> np.ndarray:
        # A table of few trigrams would be nearly flat, and noise as likely in it as in none of the languages.
        table = own + smoothing * min(own.sum() / (1 << _BITS), 1)
        return np.log(table / table.sum()).astype(np.float32)

    for language, own in samples.items():
        n = own.sum()
        at = np.flatnonzero(own)
        limit = alike * (1 + 0.5 / np.sqrt(max(1, rows[language])))
        gaps = []
        for count, log in zip(counts, logs, strict=True):
            inside = float(count @ log) / count.sum()
            gaps.append((inside - float(own[at] @ log[at]) / n) / (inside - flat))
        best = int(np.argmin(gaps)) if gaps else -1
        if gaps and gaps[best] < limit:
            merged[language] = languages[best]
            counts[best] = counts[best] + own
            logs[best] = log_table(counts[best])
        elif len(languages) < most_languages:
            languages.append(language)
            counts.append(own)
            logs.append(log_table(own))
    table = np.stack(logs) if logs else np.zeros((0, 1 << _BITS), np.float32)
    order = np.argsort(np.array(languages, object)) if languages else []
    return [languages[k] for k in order], table[order] if languages else table, merged


def fit_text(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str = "lang",
    rows_per_language: int = 400,
    max_bytes: int = 8_000_000,
    smoothing: float = 0.2,
    saturation: float = 40.0,
    alike: float = 0.12,
    common: int = 32,
    rare_rows: int = 12,
    most_declared: int = 2000,
    most_languages: int = 128,
) -> TextModel:
    """Trigram tables trained on a bounded sample, with the declared language as a label.

    Declarations are compared by ``canonical``, so ``EN`` and ``en-US`` are ``en``; an empty one is none. The ``most_declared``
    most frequent ones are sampled, however few rows they have. One whose texts are like those of a more frequent one
    (``alike``) is merged with it, such as a misspelt or a made-up one; of the others up to ``most_languages`` are
    languages, each of which takes 256 KB. Rows that declare anything else are still judged by their texts.

    The sample is the first ``rows_per_language`` different rows of each of the ``common`` most frequent declarations, and
    ``rare_rows`` of the others, in the order of a hash of id and text; the declarations take turns, the common ones first, until
    ``max_bytes`` are reached, a quarter of which is the others'. Of a long text, what follows its first
    letters is used, up to a fair share of the bytes.
    """
    spark = docs.sparkSession
    at = F.regexp_instr("text", F.lit(r"[a-zA-Z]{2}|[^\x00-\x7f]"))
    usable = (
        docs.select(F.col(f"`{id_col}`").alias("id"), canonical(F.col(f"`{declared_col}`")).alias("l"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .filter("l <> '' AND octet_length(text) >= 3")
        .withColumn("order", F.shiftrightunsigned(F.xxhash64("id", "text"), 1))
        .withColumn("digits", F.length(F.bin("order")))
        .withColumn("at", at)
        .filter("at > 0")
    )
    # The number of rows doubles with each binary digit of the hash, so few rows lie below a language's limit.
    tally = stored(usable.groupBy("l", "digits").count(), "languages-declared")
    top = tally.groupBy("l").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "l").limit(most_declared)
    rows = {r["l"]: r["n"] for r in top.collect()}
    by_digits: dict[str, list[tuple[int, int]]] = {}
    for r in tally.join(F.broadcast(top.select("l")), "l").collect():
        by_digits.setdefault(r["l"], []).append((r["digits"], r["count"]))
    if not rows:
        return TextModel([], np.zeros((0, 1 << _BITS), np.float32), saturation)
    declared = list(rows)
    n_rare = max(0, len(declared) - common)
    share = max_bytes if not n_rare else max_bytes - max_bytes // 4
    limits = []
    for k, language in enumerate(declared):
        digits, counts = zip(*sorted(by_digits[language]), strict=True)
        wanted = rows_per_language if k < common else rare_rows
        enough = int(np.searchsorted(np.cumsum(counts), wanted))
        longest = share // max(8, min(common, len(declared))) if k < common else max(300, max_bytes // 4 // n_rare // 2)
        limits.append((language, digits[min(enough, len(digits) - 1)], max(3, longest), wanted, int(k >= common)))
    places = F.broadcast(spark.createDataFrame(limits, "l string, most int, longest int, wanted int, rare int"))
    begin = F.substr("text", F.greatest(F.col("at") - 1, F.lit(1)), F.col("longest"))
    near = usable.join(places, "l").filter("digits <= most")
    cut = F.substr(begin.cast("binary"), F.lit(1), F.col("longest")).cast("string")
    near = stored(near.select("l", "order", "wanted", "rare", cut.alias("text")).dropDuplicates(["l", "order"]), "language-sample")
    sizes = near.select("l", "order", "wanted", "rare", F.octet_length("text").alias("n")).toPandas().sort_values(["l", "order"])
    sizes["turn"] = sizes.groupby("l").cumcount()
    sizes = sizes[sizes["turn"] < sizes["wanted"]].sort_values(["rare", "turn", "order", "l"])
    taken = sizes[sizes.groupby("rare")["n"].cumsum() <= np.where(sizes["rare"] == 0, share, max_bytes // 4)]
    last = taken.groupby("l")["order"].max()
    ends = spark.createDataFrame([(k, int(x)) for k, x in last.items()], "l string, last bigint")
    sample = near.join(F.broadcast(ends), "l").filter(F.col("order") <= F.col("last")).select("l", "text").toArrow()
    samples = {}
    for language in declared:
        own = np.zeros(1 << _BITS, np.float32)
        for _, data, bounds in slices(sample.filter(pc.equal(sample["l"], language))["text"].combine_chunks()):
            found, _ = letter_trigrams(data, bounds)
            own += np.bincount(found, minlength=1 << _BITS)
        if own.any():
            samples[language] = own
    languages, table, merged = _tables(samples, rows, smoothing, alike, most_languages)
    return TextModel(languages, table, saturation, merged)


def host_suffix(host: Column) -> Column:
    """What follows the last dot of a host, such as a country's code; empty where there is none."""
    return F.regexp_extract(host, r"\.([^.]*)$", 1)


def _softmax(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
    model: TextModel | None = None,
    prior_weight: float = 10.0,
    least_probability: float = 0.5,
) -> DataFrame:
    """Per row of ``docs`` the id column, ``language``, ``probability`` and ``kept``.

    The text's likelihoods give each row a first, soft language. These are summed by host, by suffix
    and over all, and a host's prior is its own sums smoothed with its suffix's prior (``prior_weight``
    rows of it), that one with the global prior; a row is taken out of its own host's sums. How often
    each language is declared as which, from the same sums, gives the likelihood of the declaration.
    The three are multiplied. All sums have a map-side part, so a hot host costs a row per map task.

    ``language`` is NULL and ``kept`` false where no language explains the text better than none
    (which is one of the classes), where the best has a probability below ``least_probability``, and
    for NULL or empty texts and texts without letters. Declarations are compared by ``canonical``, and those that
    the model has merged are one. A row is as wide as the model has languages, which is bounded. A NULL host is a host of its own and a NULL
    declaration a declaration of its own. An empty table gives no rows.
    """
    model = model or fit_text(docs, id_col, text_col, declared_col)
    n_classes = len(model.languages) + 1
    kind = docs.schema[id_col].dataType.simpleString()

    names_of = model.merged

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, n = model.log_likelihoods(batch.column(1))
            first = _softmax(logs) if len(logs) else logs
            offsets = pa.array(np.arange(len(logs) + 1, dtype=np.int32) * n_classes)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (logs, first)]
            said = [names_of.get(d, d) for d in batch.column(2).to_pylist()]
            arrays = [batch.column(0), pa.array(said, pa.string()), batch.column(3), *lists, pa.array(n > 0)]
            names = ["id", "declared", "host", "logs", "first", "has_text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        give_back()

    rows = docs.select(
        F.col(f"`{id_col}`"),
        F.col(f"`{text_col}`").cast("string"),
        canonical(F.col(f"`{declared_col}`")),
        F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")),
    )
    schema = f"id {kind}, declared string, host string, logs array<double>, first array<double>, has_text boolean"
    first = stored(rows.mapInArrow(likelihoods, schema), "language")

    def sums(by: DataFrame, *keys: str) -> DataFrame:
        each = [F.sum(F.when(F.col("has_text"), F.col("first")[k]).otherwise(0.0)) for k in range(n_classes)]
        return by.groupBy(*keys).agg(F.array(*each).alias("sums"))

    def total(column: str) -> Column:
        return F.aggregate(column, F.lit(0.0), lambda a, x: a + x)

    # Arrays are zipped, as what a lambda refers to is evaluated anew for each entry.
    def smoothed(own: str, wider: str) -> Column:
        n = F.array_repeat(total(own), n_classes)
        return F.transform(
            F.arrays_zip(F.col(own).alias("a"), F.col(wider).alias("b"), n.alias("n")),
            lambda x: (x["a"] + prior_weight * x["b"]) / (x["n"] + prior_weight),
        )

    hosts = stored(sums(first, "host").withColumn("suffix", host_suffix(F.col("host"))), "language-hosts")
    added = [F.sum(F.col("sums")[k]) for k in range(n_classes)]
    suffixes = hosts.groupBy("suffix").agg(F.array(*added).alias("suffix_sums"))
    overall = hosts.agg(F.array(*added).alias("s")).first()["s"]
    # An empty table has no sums.
    counts = np.array([x or 0.0 for x in overall]) + 1.0
    everywhere = F.array(*(F.lit(float(x)) for x in counts / counts.sum()))
    suffixes = suffixes.withColumn("everywhere", everywhere)
    suffixes = suffixes.select("suffix", smoothed("suffix_sums", "everywhere").alias("suffix_prior"))
    priors = stored(hosts.join(suffixes, "suffix").select("host", "sums", "suffix_prior"), "language-priors")

    # A declaration is one of the languages or something else.
    known = F.when(F.col("declared").isin(model.languages), F.col("declared")).otherwise("")
    said = {r["d"]: np.array(r["sums"]) for r in sums(first.withColumn("d", known), "d").collect()}
    names = [*model.languages, ""]
    tally = np.stack([said.get(d, np.zeros(n_classes)) for d in names]) + 0.5
    tally = np.log(tally / tally.sum(0, keepdims=True))
    said_logs = [(d, row.tolist()) for d, row in zip(names, tally, strict=True)]
    declared_logs = docs.sparkSession.createDataFrame(said_logs, "known string, said array<double>")

    own = F.transform("sums", lambda x, k: x - F.when(F.col("has_text"), F.col("first")[k]).otherwise(0.0))
    fused = (
        first.withColumn("known", known)
        .join(F.broadcast(declared_logs), "known")
        .join(priors, "host")
        .withColumn("sums", F.transform(own, lambda x: F.greatest(x, F.lit(0.0))))
        .withColumn("prior", smoothed("sums", "suffix_prior"))
        .withColumn("logs", F.transform(F.arrays_zip("logs", "prior", "said"), lambda x: x["logs"] + F.log(x["prior"]) + x["said"]))
        .withColumn("top", F.array_max("logs"))
        .withColumn("k", F.array_position("logs", F.col("top")).cast("int") - 1)
        .withColumn("probability", 1 / F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    )
    kept = F.col("has_text") & (F.col("k") < n_classes - 1) & (F.col("probability") >= least_probability)
    languages = F.array(*map(F.lit, names))
    return fused.select(
        F.col("id").alias(id_col),
        F.when(kept, languages[F.col("k")]).alias("language"),
        "probability",
        kept.alias("kept"),
    )
