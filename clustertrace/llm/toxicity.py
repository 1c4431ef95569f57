"""Toxicity scores from subword-bag embeddings and a linear softmax, trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import give_back
from clustertrace.llm.words import lower_latin, slices, word_hashes, word_spans

#: Lengths of the byte n-grams, and the weights that hash them.
GRAMS = (3, 4, 5, 6)
_STEP = np.uint32(0x01000193)
_SPREAD = np.uint32(0x9E3779B1)
#: So many zero vectors are averaged in, so that a segment of few n-grams needs more than one odd one.
PAD = 8


class Subwords:
    """The n-grams of words written ``<word>``, and the words, as rows of a table of ``2 ** bits`` entries.

    Words are lower-cased, and ASCII marks at their ends are left off.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, bits: int, segment: int) -> None:
        data = lower_latin(data)
        begins, ends, text = word_spans(data, bounds)
        low = data | 32
        core = np.flatnonzero((data >= 128) | ((data >= 48) & (data <= 57)) | ((low >= 97) & (low <= 122)))
        first, last = np.searchsorted(core, begins), np.searchsorted(core, ends) - 1
        some = first <= last
        text = text[some]
        begins, ends = core[first[some]], core[last[some]] + 1
        self.words = (word_hashes(data, begins, ends) >> np.uint64(64 - bits)).astype(np.uint32)
        lengths = ends - begins + 2
        self.starts = np.cumsum(lengths) - lengths  # of each word among the positions
        total = int(lengths.sum())
        inside = np.ones(total, bool)
        inside[self.starts] = False
        if total:
            inside[self.starts + lengths - 1] = False
        self.bytes = np.empty(total, np.uint8)
        self.bytes[self.starts], self.bytes[~inside] = ord("<"), ord(">")
        self.bytes[self.starts] = ord("<")
        spaced = np.zeros(len(data) + 1, np.int32)
        np.add.at(spaced, begins, 1)
        np.add.at(spaced, ends, -1)
        self.bytes[inside] = data[np.cumsum(spaced[:-1]) > 0]
        self.left = np.repeat(self.starts + lengths, lengths) - np.arange(total)  # bytes up to the word's end
        self.bits = bits
        # A segment is a run of words of one text.
        n_texts = len(bounds) - 1
        per_text = np.bincount(text, minlength=n_texts)
        within = np.arange(len(begins)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        heads = within % segment == 0
        self.segment_text = text[heads]
        self.segment_starts = self.starts[heads]
        self.n_texts = n_texts

    def tables(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length of n-gram the table row at every position and whether there is one; words at last."""
        value = np.zeros(len(self.bytes), np.uint32)
        for k in range(max(GRAMS)):
            value = value * _STEP
            value[: len(value) - k] += self.bytes[k:] if k else self.bytes
            if k + 1 in GRAMS:
                rows = ((value ^ np.uint32(k)) * _SPREAD) >> np.uint32(32 - self.bits)
                yield rows, self.left > k
        rows, valid = np.zeros(len(self.bytes), np.uint32), np.zeros(len(self.bytes), bool)
        rows[self.starts], valid[self.starts] = self.words, True
        yield rows, valid

    def segment_scores(self, weights: np.ndarray) -> np.ndarray:
        """Mean weight of the n-grams of each segment."""
        if not len(self.segment_starts):
            return np.empty(0)
        total, count = np.zeros(len(self.bytes)), np.zeros(len(self.bytes))
        for rows, valid in self.tables():
            total += np.where(valid, weights[rows], 0)
            count += valid
        return np.add.reduceat(total, self.segment_starts) / (np.add.reduceat(count, self.segment_starts) + PAD)


def largest_of_texts(scores: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Largest score among each text's segments, -inf for a text without words."""
    out = np.full(n_texts, -np.inf)
    if len(scores):
        heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[heads]] = np.maximum.reduceat(scores, heads)
    return out


def by_length(counts: np.ndarray, rise: float, usual: float) -> np.ndarray:
    """What the worst of so many segments scores more than the worst of a usual number, by chance."""
    return rise * np.log(np.maximum(counts, usual) / usual)


def tail_rise(scores: np.ndarray) -> float:
    """Mean excess over the 80 % quantile: the scale of an exponential tail, and so the rise of a maximum."""
    over = scores - np.quantile(scores, 0.8) if len(scores) else scores
    return float(over[over > 0].mean()) if (over > 0).any() else 0.0


@dataclass
class Model:
    """Weight of each n-gram's vector in the difference of the two logits, their bias, and what empty texts get.

    The worst of many segments scores higher by chance: by ``rise`` for each factor e in the number of segments
    beyond ``usual``, which is taken off again.
    """

    weights: np.ndarray
    bias: float
    empty: float
    bits: int
    segment: int
    rise: float = 0.0
    usual: float = 1.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of the toxic class in a text's most toxic segment, given how many it has."""
        out = np.empty(len(texts))
        for first, data, bounds in slices(texts):
            sub = Subwords(data, bounds, self.bits, self.segment)
            best = largest_of_texts(sub.segment_scores(self.weights), sub.segment_text, sub.n_texts)
            some = np.isfinite(best)
            counts = np.bincount(sub.segment_text, minlength=sub.n_texts)
            logit = np.where(some, best, 0) + self.bias - by_length(counts, self.rise, self.usual)
            logit = np.clip(logit, -500, 500)
            out[first : first + len(best)] = np.where(some, 1 / (1 + np.exp(-logit)), self.empty)
        return out


def train(
    texts: pa.Array,
    toxic: np.ndarray,
    bits: int = 18,
    size: int = 8,
    segment: int = 4,
    epochs: int = 12,
    batch: int = 2048,
    rate: float = 0.5,
    seed: int = 7,
    epoch_segments: int = 120_000,
    clean_segments: int = 30_000,
) -> Model:
    """Embeddings of ``size`` numbers per n-gram and a softmax over their mean, by Adagrad.

    An epoch uses at most ``epoch_segments`` segments, picked at random; from the third on, at most
    ``clean_segments`` random ones of clean texts are among them, besides the worst of each text.

    The unit is a segment of ``segment`` words. Labels are of texts, so the first epochs take every
    segment of a toxic text as toxic, and the later ones only its highest-scoring segment; of the
    other texts, random segments and the highest-scoring ones are taken. An eighth of the other texts is left
    out of all epochs and tells how their worst score rises with the number of segments. Without both classes the
    score is the share of toxic labels, 0 without labels. A text without words gets that share, below 0.5 at most.
    """
    toxic = np.asarray(toxic, bool)
    share = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(1 << bits, np.float32), 500.0 if share else -500.0, share, bits, segment)
    rng = np.random.default_rng(seed)
    parts = []
    for first, data, bounds in slices(texts):
        sub = Subwords(data, bounds, bits, segment)
        tables = list(sub.tables())
        rows = np.stack([r for r, _ in tables], 1).astype(np.int32)
        valid = np.stack([v for _, v in tables], 1)
        del tables
        per = valid.sum(1)
        counts = np.add.reduceat(per, sub.segment_starts) if len(sub.segment_starts) else np.empty(0, int)
        parts.append((rows[valid], counts, sub.segment_text + first))
    grams = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    owner = np.concatenate([p[2] for p in parts])
    del parts
    starts = np.cumsum(counts) - counts
    positive = toxic[owner]

    table = rng.normal(0, 0.1, (1 << bits, size)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (size, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_t, seen_s, seen_b = np.full_like(table, 1e-6), np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)

    def step(chosen: np.ndarray, label: np.ndarray) -> None:
        nonlocal table, softmax, bias
        n = counts[chosen]
        at = np.repeat(starts[chosen], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows, inverse = np.unique(grams[at], return_inverse=True)
        heads = np.cumsum(n) - n
        mean = np.add.reduceat(table[grams[at]], heads) / (n + PAD)[:, None]
        logits = mean @ softmax + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        back = np.repeat((p @ softmax.T) / (n + PAD)[:, None], n, axis=0)
        grad = np.stack([np.bincount(inverse, back[:, k], len(rows)) for k in range(size)], 1)
        seen_t[rows] += grad**2
        table[rows] -= (rate * grad / np.sqrt(seen_t[rows])).astype(np.float32)
        for value, seen, g in ((softmax, seen_s, mean.T @ p), (bias, seen_b, p.sum(0))):
            seen += g**2
            value -= (0.2 * rate * g / np.sqrt(seen)).astype(np.float32)

    def folded() -> tuple[np.ndarray, float]:
        return (table @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])

    def every_score() -> np.ndarray:
        weights, _ = folded()
        return np.add.reduceat(weights[grams], starts) / (counts + PAD)

    unseen = ~toxic & (rng.random(len(toxic)) < 0.125)
    of_toxic, of_clean = np.flatnonzero(positive), np.flatnonzero(~positive & ~unseen[owner])
    for epoch in range(epochs):
        if epoch < 2 or not len(of_clean):
            chosen = of_toxic
            clean = rng.choice(of_clean, min(len(of_clean), len(of_toxic)), replace=False)
        else:
            score = every_score()
            order = np.lexsort((score, owner))
            tops = order[np.append(owner[order][1:] != owner[order][:-1], True)]
            chosen = np.repeat(tops[positive[tops]], 4)
            clean = np.concatenate([tops[~(positive[tops] | unseen[owner[tops]])], rng.choice(of_clean, min(len(of_clean), clean_segments))])
        pick = np.concatenate([chosen, clean])
        label = np.concatenate([np.ones(len(chosen), int), np.zeros(len(clean), int)])
        order = rng.permutation(len(pick))[:epoch_segments]
        for k in range(0, len(order), batch):
            step(pick[order[k : k + batch]], label[order[k : k + batch]])

    weights, shift = folded()
    best = largest_of_texts(every_score() + shift, owner, len(toxic))
    some = np.isfinite(best)
    per_text = np.bincount(owner, minlength=len(toxic))
    rise, usual = tail_rise(best[some & unseen]), float(per_text[some].mean()) if some.any() else 1.0
    best = best - by_length(per_text, rise, usual)
    return Model(weights, shift - _cut(best[some], toxic[some]), min(share, 0.49), bits, segment, rise, usual)


def _cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap between scores that splits the classes with the fewest errors."""
    order = np.argsort(scores, kind="stable")
    wrong = np.concatenate([[0], np.cumsum(np.where(toxic[order], 1, -1))])
    at = int(np.argmin(wrong))
    low = scores[order[at - 1]] if at else scores[order[0]] - 1
    high = scores[order[at]] if at < len(order) else scores[order[-1]] + 1
    return float((low + high) / 2)


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: CRC-32 of the id as text, modulo 5, is 0. False for a NULL id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = 2000,
    max_bytes: int = 8_000_000,
    epoch_segments: int = 120_000,
    clean_segments: int = 30_000,
) -> Model:
    """A model trained on a bounded sample of labelled rows that are not held out.

    The sample is the first ``rows_per_class`` rows of each class in the order of a hash of the id,
    and of them whole texts of ``max_bytes`` together, none longer than an eighth of that. Of an id
    with several labels the largest counts. ``epoch_segments`` and ``clean_segments`` bound the
    segments of an epoch, as in ``train``.
    """
    usable = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__label"))
    usable = usable.dropna().withColumn("__order", F.xxhash64("__id")).filter(~held_out("__id"))
    usable = usable.groupBy("__id", "__order").agg(F.max("__label").alias("__label"))
    picked = None
    for label in (0, 1):
        part = usable.filter(F.col("__label") == label).orderBy("__order", "__id").limit(rows_per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    rows = rows.join(F.broadcast(picked), "__id").filter(F.octet_length("__text") <= max_bytes // 8)
    sizes = rows.select("__order", "__id", F.octet_length("__text").alias("n")).orderBy("__order", "__id").toPandas()
    taken = sizes[sizes["n"].cumsum() <= max_bytes]
    if not len(taken):
        return train(pa.array([], pa.string()), np.empty(0, bool))
    last = int(taken["__order"].iloc[-1])
    sample = rows.filter(F.col("__order") <= F.lit(last)).orderBy("__order", "__id", "__text").toArrow()
    sample = sample.combine_chunks()
    text = sample["__text"].combine_chunks() if len(sample) else pa.array([], pa.string())
    toxic = sample["__label"].to_numpy() == 1
    return train(text, toxic, epoch_segments=epoch_segments, clean_segments=clean_segments)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs`` the id column and ``score``, from whole texts; NULL and empty texts are scored too."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc", "score"])
        give_back()

    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(run, f"doc {kind}, score double").withColumnRenamed("doc", id_col)


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < threshold))
        give_back()

    return docs.mapInArrow(run, docs.schema)
