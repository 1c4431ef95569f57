"""Fingerprints of documents from their improbable features, and the likeness of fingerprints."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import give_back, put, stored, text_or_empty
from clustertrace.llm.words import utf8

#: Bytes of a feature, and positions of which the rarest feature gets a point.
WINDOW = 64
#: Classes of entropy, from 0 to that of 64 different bytes.
BINS = 1000
_FILTER_BYTES = 256
_FEATURE_BITS = 5
_AT_ONCE = 1 << 18
_NONE = np.int64(1) << 40


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The class of entropy of each run of ``WINDOW`` bytes, by its first byte.

    Per run the sum of ``c * log2(c)`` over the counts of its bytes is kept up while it moves, in whole units,
    so that a run has the same class wherever it lies.
    """
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int64)
    # How often a byte has occurred among the 63 before it, and occurs among the 63 after it.
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    c = np.arange(1, WINDOW + 1)
    parts = np.append(0, np.rint(c * np.log2(c) * (1 << 20))).astype(np.int64)
    gain = np.diff(parts)
    # The first run byte by byte, then a byte in and a byte out.
    inside = np.array([np.count_nonzero(data[:i] == data[i]) for i in range(WINDOW)])
    total = gain[inside].sum()
    moved = gain[before[WINDOW:]] - gain[after[: n - WINDOW]]
    sums = total + np.append(0, np.cumsum(moved))
    most = parts[WINDOW]  # 64 equal bytes
    return (most - sums) * BINS // (most + 1)


def _runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Whole texts laid end to end, about ``_AT_ONCE`` bytes or one longer text: index of the first, bytes, bounds."""
    data, bounds = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _AT_ONCE, "right")) - 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def _blocks(data: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Classes of entropy of a text in blocks: begin and end of the positions, and their classes."""
    n = len(data) - WINDOW + 1
    for begin in range(0, max(n, 0), _AT_ONCE):
        end = min(n, begin + _AT_ONCE)
        yield begin, end, entropy_bins(data[begin : end + WINDOW - 1])


def _valid(bounds: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of bytes that begins at each position lies within one text."""
    ends = np.repeat(bounds[1:], np.diff(bounds))[:n]
    return np.arange(n) + WINDOW <= ends


def fit_rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The rank of each class of entropy: 0 for the one that the fewest windows of all texts have.

    Classes that no window has come first; of equally rare ones the lower. Counts are summed per class,
    so ``BINS`` rows reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for _, data, bounds in _runs(batch.column(0)):
                for begin, end, bins in _blocks(data):
                    total += np.bincount(bins[_valid(bounds, len(data))[begin:end]], minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], names=["bin", "n"])
        give_back()

    rows = docs.select(text_or_empty(f"`{text_col}`")).mapInArrow(count, "bin bigint, n bigint")
    counts = np.zeros(BINS, np.int64)
    for bin_, n in rows.groupBy("bin").agg(F.sum("n")).collect():
        counts[bin_] = n
    ranks = np.empty(BINS, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(BINS)
    return ranks


def selected(keys: np.ndarray, least_points: int) -> np.ndarray:
    """Positions that are the smallest of at least ``least_points`` of the windows of 64 positions they lie in.

    ``keys`` are ranks by position, ``_NONE`` or more for none. Of equal ranks the first position wins. Windows that
    reach beyond either end count.
    """
    n = len(keys)
    if n == 0:
        return np.empty(0, np.int64)
    shift = int(n + 2 * WINDOW).bit_length()
    wide = np.full(n + 2 * (WINDOW - 1), int(_NONE) << shift, np.int64)
    wide[WINDOW - 1 : WINDOW - 1 + n] = np.minimum(keys, _NONE) << shift
    wide += np.arange(len(wide))
    size = 1
    while size < WINDOW:
        wide = np.minimum(wide[:-size], wide[size:])
        size *= 2
    best = wide[wide < int(_NONE) << shift] & ((1 << shift) - 1)
    points = np.bincount(best - (WINDOW - 1), minlength=n)
    return np.flatnonzero(points >= least_points)


def features(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray, least_bin: int, least_points: int) -> list[list[int]]:
    """64-bit hashes of the chosen features of each text, in order of their positions.

    A text without any, such as one of fewer bytes than a window, has one feature, the whole of it; an empty one none.
    """
    n_texts = len(bounds) - 1
    out: list[list[int]] = [[] for _ in range(n_texts)]
    raw = data.tobytes()
    valid = _valid(bounds, len(data))
    keys = np.full(len(data), _NONE, np.int64)
    for begin, end, bins in _blocks(data):
        own = np.where(bins >= least_bin, ranks[bins], _NONE)
        keys[begin:end] = np.where(valid[begin:end], own, _NONE)
    # Texts have no run over their last 63 bytes, so no window of positions reaches two texts.
    for begin in range(0, len(data), _AT_ONCE):
        end = min(len(data), begin + _AT_ONCE)
        low, high = max(0, begin - 2 * WINDOW), min(len(data), end + 2 * WINDOW)
        places = selected(keys[low:high], least_points) + low
        places = places[(places >= begin) & (places < end)]
        text = np.searchsorted(bounds, places, "right") - 1
        for t, p in zip(text.tolist(), places.tolist(), strict=True):
            out[t].append(xxhash.xxh3_64_intdigest(raw[p : p + WINDOW]))
    for t in np.flatnonzero(np.diff(bounds)).tolist():
        out[t] = out[t] or [xxhash.xxh3_64_intdigest(raw[bounds[t] : bounds[t + 1]])]
    return out


def bloom_filters(hashes: list[int], most: int) -> np.ndarray:
    """Filters of 2048 bits with up to ``most`` different features each, one after the other, a row each.

    A feature sets five bits. One that is in an earlier filter already isn't inserted again.
    """
    distinct = np.fromiter(dict.fromkeys(hashes), np.uint64)
    bits = 8 * _FILTER_BYTES
    out = np.zeros((-(-len(distinct) // most), bits), np.uint8)
    row = np.arange(len(distinct)) // most
    for k in range(_FEATURE_BITS):
        out[row, (distinct >> np.uint64(11 * k)) & np.uint64(bits - 1)] = 1
    return np.packbits(out, axis=1)


def _name(blooms: np.ndarray) -> str:
    return f"{len(blooms)}:{base64.b64encode(blooms.tobytes()).decode()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike two chains of filters are, 0 to 1.

    Two filters have as many bits in common as chance gives, and at most as many as the smaller has: what
    is above chance is divided by what can be. Each filter of the shorter chain (the first, if they are as long) counts with
    its most similar one, weighted by its bits. Equal chains are alike by 1; an empty one and another by 0.
    """
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if len(a) == 0 or len(b) == 0:
        return 0.0
    if (len(a), a.tobytes()) > (len(b), b.tobytes()):
        a, b = b, a
    ones_b = np.bitwise_count(b).sum(1, dtype=np.int64)
    total = weight = 0.0
    for one in a:
        n = int(np.bitwise_count(one).sum())
        common = np.zeros(len(b), np.int64)
        for begin in range(0, len(b), 4096):
            common[begin : begin + 4096] = np.bitwise_count(b[begin : begin + 4096] & one).sum(1, dtype=np.int64)
        chance = n * ones_b / (8 * _FILTER_BYTES)
        room = np.minimum(n, ones_b) - chance
        score = np.where(room > 0, (common - chance) / np.where(room > 0, room, 1), 0)
        total += n * min(1.0, max(0.0, float(score.max())))
        weight += n
    return total / weight


def _fingerprints(texts: list[str], fit: tuple) -> list[np.ndarray]:
    ranks, least_bin, least_points, most = fit
    out: list[np.ndarray] = []
    for _, data, bounds in _runs(pa.array(texts, pa.large_string())):
        out += [bloom_filters(h, most) for h in features(data, bounds, ranks, least_bin, least_points)]
    return out


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first code points of the following one, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(texts: list[str], fit: tuple) -> list[tuple]:
    """For each text but the last, which is the next of the one before: what ``_RESULT`` names."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    found = _fingerprints(texts + changed, fit)
    rows = []
    for k, text in enumerate(changed):
        own, other, following = found[k], found[len(texts) + k], found[k + 1]
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows.append((len(texts[k]), digest, _name(own), _name(other), likeness(own, other), likeness(own, following)))
    return rows


_RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_RESULT_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def fingerprints(
    docs: DataFrame,
    ranks: np.ndarray,
    text_col: str = "text",
    least_bin: int = 100,
    least_points: int = 16,
    features_per_filter: int = 160,
) -> DataFrame:
    """Every row with the column ``fingerprint``, which replaces one of that name.

    A feature is a run of 64 bytes (UTF-8). Its rank is that of its entropy (``fit_rarity``); features with a class of
    entropy below ``least_bin``, such as runs of one byte, have none. A feature is chosen if it is the rarest of at
    least ``least_points`` of the windows of 64 neighbouring features. Chosen features go to Bloom filters of 256
    bytes, the next begun when one has ``features_per_filter``; the fingerprint is their number and their bytes in base64.

    NULL counts as empty, and an empty text has no filter. Equal texts have equal fingerprints, in any order and
    partitioning of rows. Longer texts have longer chains, and are read in blocks. An empty table gives no rows.
    """
    fit = (np.asarray(ranks), least_bin, least_points, features_per_filter)
    shown = put(docs, fingerprint=text_or_empty(f"`{text_col}`"))
    at = len(shown.columns) - 1

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [_name(b) for b in _fingerprints(batch.column(at).to_pylist(), fit)]
            yield batch.set_column(at, "fingerprint", pa.array(names, pa.string()))
        give_back()

    return shown.mapInArrow(convert, shown.schema)


def edit_resistance(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: np.ndarray | None = None,
    least_bin: int = 100,
    least_points: int = 16,
    features_per_filter: int = 160,
) -> DataFrame:
    """Fingerprints of all texts and of each text with its last half exchanged, and how alike they are.

    Columns: the id, ``n_chars``, ``edited_sha256`` (of the edited text in UTF-8), ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` (likeness to the edited text's) and ``near_next`` (to the next document's). The next document is that
    of the next id in ascending order, and the first after the last. NULL ids come first; rows with one id are
    ordered by a hash of their texts. The only row of a table is its own next. Rows are those of ``fingerprints``.

    The texts are sorted by range once. A task reads its rows in order and keeps about a megabyte of them; only its first and
    last text are paired with those of its neighbours, a row per task.
    """
    ranks = fit_rarity(docs, text_col) if ranks is None else np.asarray(ranks)
    fit = (ranks, least_bin, least_points, features_per_filter)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie")
    ordered = ordered.sortWithinPartitions("id", "tie", "text").select("id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, first, ids, texts, size, schema = TaskContext.get().partitionId(), None, [], [], 0, None
        for batch in batches:
            if schema is None:
                ends = [("task", pa.int32()), ("last", pa.string()), ("first", pa.string())]
                names = [c.split()[0] for c in _RESULT.split(", ")]
                schema = pa.schema([batch.schema.field(0), *zip(names, _RESULT_TYPES, strict=True), *ends])
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                first = text if first is None else first
                ids.append(i)
                texts.append(text)
                size += len(text)
                if size > 4 * _AT_ONCE and len(texts) > 1:
                    yield _batch([(i, *r, None, None, None) for i, r in zip(ids, _compared(texts, fit), strict=False)], schema)
                    ids, texts, size = ids[-1:], texts[-1:], len(text)
        if ids:
            done = [(i, *r, None, None, None) for i, r in zip(ids, _compared(texts, fit), strict=False)]
            yield _batch([*done, (ids[-1], *[None] * len(_RESULT_TYPES), task, texts[-1], first)], schema)
        give_back()

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last row of a task with the first text of the next."""
        for batch in batches:
            for row in range(len(batch)):
                i, last, following = (batch.column(k)[row].as_py() for k in range(3))
                (result,) = _compared([last, following], fit)
                yield _batch([(i, *result)], pa.schema([batch.schema.field(0), *zip(results, _RESULT_TYPES, strict=True)]))

    results = [c.split()[0] for c in _RESULT.split(", ")]
    compared = stored(ordered.mapInArrow(compare, f"id {kind}, {_RESULT}, task int, last string, first string"), "fingerprints")
    ends = compared.filter("task IS NOT NULL")
    # One number per task.
    tasks = sorted(r["task"] for r in ends.select("task").collect())
    follows = list(zip(tasks, tasks[1:] + tasks[:1], strict=True))
    pairs = docs.sparkSession.createDataFrame(follows, "task int, next int")
    begins = ends.select(F.col("task").alias("next"), "first")
    closing = ends.select("id", "task", "last").join(F.broadcast(pairs), "task").join(begins, "next")
    closed = closing.select("id", "last", "first").mapInArrow(close, f"id {kind}, {_RESULT}")
    return compared.filter("task IS NULL").select("id", *results).unionByName(closed).withColumnRenamed("id", id_col)
