"""Collocations: phrases counted in counting quotient filters and scored by their weakest cut."""

from __future__ import annotations

import math
import pickle
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clustertrace.llm import quotient_filter as qf
from clustertrace.llm.shared import give_back, small_batches, stored, text_or_empty

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDS = b",;:!?\n\x0b\x0c\r"
#: Lower-cases A-Z and makes every end of a piece a full stop.
_PLAIN = bytes.maketrans(_UPPER + _ENDS, _UPPER.lower() + b"." * len(_ENDS))
_AT_ONCE = 1 << 20
#: Rows of words, and bytes of filters, that go to Spark at once.
_WORDS_AT_ONCE = 1 << 14
_FILTERS_AT_ONCE = 1 << 22
_CODED = "shard bigint, lang string, word string, code int, n bigint, codes binary, lead int, words binary, piece int"
#: Tables with long binary rows: pages of about a megabyte, compressed without buffers of a page's size outside the heap, read in small steps.
_SMALL_PAGES = {"compression": "zstd", "parquet.page.size.row.check.min": "1", "parquet.read.allocation.size": str(1 << 18)}
_BITMAP_BITS = 25
_CHUNK_BITS = 15
_FILTER = "shard bigint, k int, bucket bigint, filter binary"


def _slices(data: bytes) -> Iterator[bytes]:
    """A text in parts of about a megabyte that begin and end between words."""
    begin = 0
    while len(data) - begin > _AT_ONCE:
        end = begin + _AT_ONCE
        cut = max(data.rfind(c, begin, end) for c in (b" ", b"\t", b"."))
        if cut < 0:
            after = [x for c in (b" ", b"\t", b".") if (x := data.find(c, end)) >= 0]
            if not after:
                break
            cut = min(after)
        yield data[begin : cut + 1]
        begin = cut + 1
    yield data[begin:]


class _Words(dict):
    """Codes of a language's words in a shard, given on demand; the end of a piece has 0."""

    def __init__(self, taken: list[int]) -> None:
        super().__init__({b".": 0})
        self.taken = taken

    def __missing__(self, word: bytes) -> int:
        self.taken[0] += 1
        self[word] = self.taken[0]
        return self.taken[0]


class _Shard:
    """The codes of some texts and the words they stand for."""

    def __init__(self) -> None:
        self.taken, self.words, self.codes, self.lead = [0], {}, array("I"), 0

    def add(self, lang: str, tokens: list[bytes]) -> None:
        if lang not in self.words:
            self.words[lang] = _Words(self.taken)
        self.codes.extend(map(self.words[lang].__getitem__, tokens))

    def rows(self, name: int, piece_tokens: int, context: int) -> Iterator[pa.RecordBatch]:
        """A row per word, then one for each piece of ``piece_tokens`` codes: their number, the largest, and their words.

        A piece begins with the last ``context`` codes of the one before, which are its ``lead``.
        """
        codes = np.frombuffer(self.codes, np.uint32)
        n = np.bincount(codes[self.lead :], minlength=self.taken[0] + 1)
        spelled, langs = [b""] * (self.taken[0] + 1), np.zeros(self.taken[0] + 1, np.int32)
        for number, (lang, own) in enumerate(self.words.items()):
            every = [w for w in own if w != b"."]
            for begin in range(0, len(every), _WORDS_AT_ONCE):
                words = every[begin : begin + _WORDS_AT_ONCE]
                at = np.fromiter((own[w] for w in words), np.int32, len(words))
                langs[at] = number
                for word, code in zip(words, at.tolist(), strict=True):
                    spelled[code] = word
                yield _batch(name, len(words), lang, pa.array(words, pa.binary()).cast(pa.string()), at, n[at], None)
        for piece, end in enumerate(range(piece_tokens, len(codes) + piece_tokens, piece_tokens)):
            begin = max(0, end - piece_tokens - context)
            lead = end - piece_tokens - begin if piece else self.lead
            yield self._piece(name, piece, lead, codes[begin:end], spelled, langs)

    def _piece(self, name: int, piece: int, lead: int, codes: np.ndarray, spelled: list[bytes], langs: np.ndarray) -> pa.RecordBatch:
        # The upper bytes are mostly 0, as frequent words come early; so they are laid together.
        planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        stream = pa.compress(planes, codec="zstd", asbytes=True)
        used = np.unique(codes)
        used, words = used[used > 0], []
        for number, lang in enumerate(self.words):
            own = used[langs[used] == number].tolist()
            if own:
                words.append((lang, b"\n".join([spelled[code] for code in own]), own))
        words = pickle.dumps(words)
        words = len(words).to_bytes(8, "little") + pa.compress(words, codec="zstd", asbytes=True)
        return _batch(name, 1, None, None, [int(codes.max(initial=0))], [len(codes)], ([stream], [lead], [words], [piece]))


def _batch(name: int, size: int, lang, words, codes, n, piece) -> pa.RecordBatch:
    none = [None] * size
    stream, lead, spelled, number = piece or [none] * 4
    columns = [
        pa.array([name] * size, pa.int64()),
        pa.array([lang] * size, pa.string()),
        words if words is not None else pa.array(none, pa.string()),
        pa.array(codes, pa.int32()),
        pa.array(n, pa.int64()),
        pa.array(stream, pa.binary()),
        pa.array(lead, pa.int32()),
        pa.array(spelled, pa.binary()),
        pa.array(number, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _CODED.split(", ")])


def _coder(shard_tokens: int, piece_tokens: int, context: int):
    """Codes the texts of a task, in shards of about ``shard_tokens`` words.

    A text that goes on in the next shard leaves it its last ``context`` words, which are counted there no more.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, shard = TaskContext.get().partitionId() << 32, 0, _Shard()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang, tail = lang.as_py(), []
                for data in _slices(text.as_buffer().to_pybytes().translate(_PLAIN)):
                    if len(shard.codes) >= shard_tokens:
                        yield from shard.rows(first + made, piece_tokens, context)
                        made, shard = made + 1, _Shard()
                        shard.add(lang, tail)
                        shard.lead = len(tail)
                    tokens = data.replace(b".", b" . ").split()
                    shard.add(lang, tokens)
                    tail = (tail + tokens[-context:])[-context:]
                shard.codes.append(0)
        if shard.codes:
            yield from shard.rows(first + made, piece_tokens, context)
        give_back()

    return code


def _known(spelled: bytes, top: int, dictionary: dict) -> np.ndarray:
    """The ids of a piece's codes, 0 for words that the dictionary hasn't."""
    size, ids = int.from_bytes(spelled[:8], "little"), np.zeros(top + 1, np.uint64)
    for lang, words, codes in pickle.loads(pa.decompress(spelled[8:], size, "zstd", asbytes=True)):
        own = dictionary.get(lang, {})
        # No word holds a line end.
        ids[codes] = [own.get(w, 0) for w in words.split(b"\n")]
    ids[0] = 0
    return ids


def _streamed(stream: bytes, n: int, ids: np.ndarray) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(stream, 4 * n, "zstd"), np.uint8)
    return ids[np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()]


def _filters_of(shard: int, at: np.ndarray, lead: int, lengths: range, width: int, bucket_bits: dict[int, int], pairs: np.ndarray | None) -> Iterator[tuple]:
    """Filters of the phrases of some lengths, one length after the other, whose words are known and whose pairs may be frequent.

    ``at`` are the ids of the words in order, 0 for an unknown one; ``pairs`` the bitmap of frequent pairs, if known.
    """
    linked = (at[:-1] > 0) & (at[1:] > 0)
    if pairs is not None:
        places = np.flatnonzero(linked)
        first, second = _bits_of([at[places], at[places + 1]], width)
        linked[places] = _holds(pairs, first) & _holds(pairs, second)
    for k in lengths:
        begins = len(at) - k + 1
        if begins < 1:
            break
        right = linked[:begins].copy()
        for j in range(1, k - 1):
            right &= linked[j : begins + j]
        right[: max(0, lead - k + 1)] = False
        places = np.flatnonzero(right)
        if not len(places):
            continue
        bits = width * k
        keys, counts = qf.counted(qf.permuted(qf.packed((at[places + j] for j in range(k)), k, width), bits))
        for part in qf.split(keys, counts, bits, bucket_bits[k]):
            yield shard, k, *part


def _bits_of(columns: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a pair in the bitmap."""
    limbs = qf.permuted(qf.packed(columns, 2, width), 2 * width)
    mixed = limbs[0] if len(limbs) == 1 else limbs[0] ^ (limbs[1] << np.uint64(7))
    mask = np.uint64((1 << _BITMAP_BITS) - 1)
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - _BITMAP_BITS)) & mask, (mixed >> np.uint64(32 - _BITMAP_BITS)) & mask


def _holds(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _bitmap(pairs: DataFrame, width: int) -> np.ndarray:
    """A bitmap of fixed size in which each of the pairs (``ids``) has its bits set; others may by chance."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (_BITMAP_BITS - 3), np.uint8)
        for batch in batches:
            ids = batch.column(0).flatten().to_numpy().astype(np.uint64).reshape(-1, 2)
            for places in _bits_of([ids[:, 0], ids[:, 1]], width):
                np.bitwise_or.at(bits, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        parts = bits.reshape(-1, 1 << (_CHUNK_BITS - 3))
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], names=["chunk", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        parts = np.stack([np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()])
        return pa.table({"chunk": table["chunk"][:1], "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})

    out = np.zeros((1 << (_BITMAP_BITS - _CHUNK_BITS), 1 << (_CHUNK_BITS - 3)), np.uint8)
    schema = "chunk int, bits binary"
    for row in pairs.select("ids").mapInArrow(chunks, schema).groupBy("chunk").applyInArrow(merge, schema).collect():
        out[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _filters(rows: list[tuple]) -> pa.Table:
    kinds = {"shard": pa.int64(), "k": pa.int32(), "bucket": pa.int64(), "filter": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.table([pa.array(x, t) for x, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _filter_batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Filters in batches of about ``_FILTERS_AT_ONCE`` bytes, or one larger filter."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[-1]) > _FILTERS_AT_ONCE:
            yield from _filters(held).to_batches()
            held, size = [], 0
        held.append(row)
        size += len(row[-1])
    yield from _filters(held).to_batches()


def _merge(table: pa.Table, width: int):
    k = table["k"][0].as_py()
    filters = zip(table["bucket"].to_pylist(), table["filter"].to_pylist(), strict=True)
    return k, qf.merged(list(filters), width * k)


def _resplit(width: int, bucket_bits: dict[int, int]):
    """Filters of a bucket merged and split into finer buckets."""

    def resplit(table: pa.Table) -> pa.Table:
        k, (keys, counts) = _merge(table, width)
        shard = table["shard"][0].as_py()
        return _filters([(shard, k, *part) for part in qf.split(keys, counts, width * k, bucket_bits[k])])

    return resplit


_STREAM = "shard bigint, n bigint, lead int, ids binary, piece int"


def _packed_ids(at: np.ndarray) -> bytes:
    return pa.compress(at.astype("<u8").tobytes(), codec="zstd", asbytes=True)


def _id_streams(coded: DataFrame, dictionary: DataFrame, n_words: int, broadcast_words: int) -> DataFrame:
    """The shards' pieces as sequences of ids, 0 for ends of a text's pieces and words that aren't frequent.

    A dictionary of at most ``broadcast_words`` words is sent to all tasks. A larger one is joined with the words
    of each shard, and a shard's codes meet its own words only.
    """
    kinds = [("shard", pa.int64()), ("n", pa.int64()), ("lead", pa.int32()), ("ids", pa.binary()), ("piece", pa.int32())]
    streams = coded.filter("codes IS NOT NULL")
    if n_words <= broadcast_words:
        known: dict[str, dict[bytes, int]] = {}
        for lang, word, number in dictionary.select("lang", "word", "id").collect():
            known.setdefault(lang, {})[word.encode()] = number
        sent = coded.sparkSession.sparkContext.broadcast(known)

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, n, top, lead, stream, spelled, piece in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                    at = _streamed(stream, n, _known(spelled, top, sent.value))
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip((shard, n, lead, _packed_ids(at), piece), kinds, strict=True)], names=[c for c, _ in kinds])
            give_back()

        return streams.select("shard", "n", "code", "lead", "codes", "words", "piece").mapInArrow(look_up, _STREAM)

    def meet(key: tuple, own: pa.Table, words: pa.Table) -> pa.Table:
        rows = []
        own = own.sort_by("piece")
        ids = np.zeros(pc.max(pa.chunked_array([own["top"].combine_chunks(), words["code"].combine_chunks()])).as_py() + 1, np.uint64)
        ids[words["code"].to_numpy()] = words["id"].to_numpy()
        for n, lead, stream, piece in zip(*(own[c].to_pylist() for c in ("n", "lead", "codes", "piece")), strict=True):
            rows.append((key[0].as_py(), n, lead, _packed_ids(_streamed(stream, n, ids)), piece))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[c for c, _ in kinds])

    words = coded.filter("word IS NOT NULL").join(dictionary, ["lang", "word"]).select("shard", "code", "id")
    streams = streams.select("shard", "codes", "code", "n", "lead", "piece").toDF("stream", "codes", "top", "n", "lead", "piece")
    return streams.groupBy("stream").cogroup(words.groupBy("shard")).applyInArrow(meet, _STREAM)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, int]]:
    """Shard, ids and lead of pieces laid end to end where they follow each other, else one by one; no phrase is lost or counted twice."""
    shard, last, lead, parts = None, 0, 0, []
    for batch in batches:
        for name, piece, n, own_lead, ids in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            at = np.frombuffer(pa.decompress(ids, 8 * n, "zstd"), np.uint64)
            if parts and (name, piece) == (shard, last + 1):
                parts.append(at[own_lead:])
            else:
                if parts:
                    yield shard, np.concatenate(parts), lead
                shard, lead, parts = name, own_lead, [at]
            last = piece
    if parts:
        yield shard, np.concatenate(parts), lead


def phrase_filters(streams: DataFrame, width: int, lengths: range, n_tokens: int, group_entries: int, round_bits: int, pairs: np.ndarray | None) -> DataFrame:
    """Rows of filters in which each phrase lies in one group of ``k`` and ``bucket``.

    The buckets are ranges of the permuted phrase. Their number follows from the number of words, so that a
    group has about ``group_entries`` at most, whatever the corpus' size, and copies of one phrase make no hot
    group: a shard holds it once. Where more buckets are needed than ``round_bits`` give, the filters are
    merged in rounds: those of some shards within a bucket, then split further.
    """
    wanted = max(0, math.ceil(math.log2(max(1, n_tokens) / group_entries)))

    def bits_of(most: int) -> dict[int, int]:
        return {k: qf.bounded_bits(width * k, min(wanted, most)) for k in lengths}

    done = round_bits
    first_bits = bits_of(done)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, at, lead in _joined(batches):
            yield from _filter_batches(_filters_of(shard, at, lead, lengths, width, first_bits, pairs))
        give_back()

    filters = streams.select("shard", "piece", "n", "lead", "ids").mapInArrow(count, _FILTER)
    while done < wanted:
        parts, done = 1 << (wanted - done), done + round_bits
        part = F.pmod(F.xxhash64("shard"), F.lit(parts))
        rows = filters.withColumn("part", part).groupBy("k", "bucket", "part")
        filters = rows.applyInArrow(_resplit(width, bits_of(done)), _FILTER)
    return filters


def frequent_phrases(filters: DataFrame, width: int, least: int) -> DataFrame:
    """``ids`` and their count ``a`` of all phrases that occur ``least`` times."""

    def frequent(table: pa.Table) -> pa.Table:
        k, (keys, counts) = _merge(table, width)
        kept = np.flatnonzero(counts >= least)
        columns = qf.unpacked(qf.restored([x[kept] for x in keys], width * k), width, k)
        ids = np.stack(columns, 1).astype(np.int64).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * k), pa.array(ids))
        return pa.table([lists, pa.array(counts[kept].astype(np.int64))], names=["ids", "a"])

    return filters.groupBy("k", "bucket").applyInArrow(frequent, "ids array<bigint>, a bigint")


def _numbered(frame: DataFrame) -> tuple[DataFrame, int]:
    """The rows with an ``id`` from 1 on without gaps, and their number; only counts per partition are collected."""
    placed = stored(frame.withColumn("place", F.monotonically_increasing_id()), "phrases-words")
    block = F.shiftright("place", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(block.alias("block")).count().collect())
    begins, total = [], 0
    for number, size in sizes:
        begins.append((number, total))
        total += size
    offsets = placed.sparkSession.createDataFrame(begins, "block bigint, begin bigint")
    inner = F.col("place").bitwiseAND((1 << 33) - 1)
    rows = placed.withColumn("block", block).join(F.broadcast(offsets), "block")
    return rows.select(*frame.columns, (F.col("begin") + inner + 1).alias("id")), total


def _part(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", begin, size), " ")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    shard_tokens: int = 1 << 21,
    piece_tokens: int = 1 << 18,
    group_entries: int = 1 << 21,
    round_bits: int = 8,
    broadcast_words: int = 500_000,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of 2 to ``longest`` words per language.

    A-Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.
    ``a`` counts a phrase within pieces, overlaps included, ``n`` all words of the language, ``l`` and
    ``r`` the two parts of the cut with the smallest ``floor(1000 * a * n / (l * r))``, the phrase's ``score`` (the
    first such cut counts). Phrases with ``least`` occurrences take part; one that lies in a longer one as
    frequent as itself is dropped. The first ``top`` stay, by score, count (both descending) and phrase.

    Texts are coded once, in shards that have a dictionary of their own, and written in pieces of ``piece_tokens`` codes, so that
    no row is long; where a shard is counted, pieces that follow each other are laid together. The corpus' frequent words are
    sent to all tasks if they are ``broadcast_words`` at most, else joined with the distinct words of each shard. A
    shard's phrases of frequent words become sorted counting quotient filters of packed word numbers, which groups by
    range of the permuted phrase merge: first all pairs, then the longer ones whose pairs are all frequent by a bitmap of
    fixed size, which passes some others but drops none. Counts are whole numbers, and scores are exact in decimals of 38 digits.

    A NULL language is ``und``; NULL and empty texts have no words; a text of any length is coded in
    slices; repeated rows count as often; an empty table gives no rows.
    """
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    coder = _coder(shard_tokens, max(piece_tokens, longest - 1), longest - 1)
    with small_batches(docs.sparkSession, read_rows=256):
        coded = stored(docs.select(lang, text_or_empty(f"`{text_col}`")).mapInArrow(coder, _CODED), "phrases-codes", **_SMALL_PAGES)
        counted = coded.filter("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("f"))
        counted = stored(counted, "phrases-counts")
        totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
        frequent, n_words = _numbered(counted.filter(F.col("f") >= least))
        n_tokens = frequent.agg(F.sum("f")).first()[0] or 0
        width = max(1, int(n_words).bit_length())
        streams = stored(_id_streams(coded, frequent, n_words, broadcast_words), "phrases-streams", **_SMALL_PAGES)
        sizes = (n_tokens, group_entries, round_bits)
        found = stored(frequent_phrases(phrase_filters(streams, width, range(2, 3), *sizes, None), width, least), "phrases-pairs")
        if longest > 2:
            longer = phrase_filters(streams, width, range(3, longest + 1), *sizes, _bitmap(found, width))
            found = found.unionByName(stored(frequent_phrases(longer, width, least), "phrases-longer"))
        spelled = (
            found.select("ids", "a", F.posexplode("ids").alias("pos", "id"))
            .join(frequent, "id")
            .groupBy("ids", "a")
            .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("words"))
        )
        spelled = spelled.select("lang", F.col("words.word").alias("words"), "a")
        phrases = stored(spelled.withColumn("phrase", F.array_join("words", " ")), "phrases")

    counts = phrases.select("lang", "phrase", F.col("a").alias("f"))
    counts = counts.unionByName(frequent.select("lang", F.col("word").alias("phrase"), "f"))
    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")
    cuts = phrases.select("lang", "phrase", "words", "a", cut).join(totals, "lang")
    cuts = cuts.withColumns({"left": _part(F.lit(1), F.col("cut")), "right": _part(F.col("cut") + 1, size - F.col("cut"))})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr(
        "(1000 * CAST(a AS DECIMAL(16, 0)) * CAST(n AS DECIMAL(16, 0))) DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"
    )
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(weakest)
    # A phrase in a longer one is in one with a single word more, which occurs as often at least.
    inner = F.explode(F.array(_part(F.lit(1), size - 1), _part(F.lit(2), size - 1))).alias("phrase")
    covers = phrases.filter(size > 2).select("lang", "a", inner).groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = scored.join(covers, ["lang", "phrase"], "left").filter("cover IS NULL OR cover < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
