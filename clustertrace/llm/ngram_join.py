"""Self join of documents by the Jaccard similarity of their word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.components import components
from clustertrace.llm.shared import give_back, stored
from clustertrace.llm.words import lower_ascii, mixed, shingles, slices, word_hashes, word_spans

_COUNTER_BITS = 20
_CHUNK = 1 << 14
_WANTED_BITS = 25


def text_shingles(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, bounds in slices(texts):
        low = lower_ascii(data)
        begins, ends, text = word_spans(low, bounds)
        yield from shingles(word_hashes(low, begins, ends), text, len(bounds) - 1, size)


def node_of(shingle_set: np.ndarray) -> int:
    """A set's 64-bit name; equal sets share it."""
    return xxhash.xxh3_64_intdigest(shingle_set.tobytes()) - (1 << 63)


def signature(shingle_set: np.ndarray) -> bytes:
    """A bitmap of at least four bits per member; a bit is set where an odd number of members fall."""
    width = max(64, 1 << int(4 * len(shingle_set) - 1).bit_length())
    at = (mixed(shingle_set) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(bitmap: np.ndarray, n_bytes: int) -> np.ndarray:
    """The bitmap of the same set at a smaller width."""
    while len(bitmap) > n_bytes:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def may_link(a: bytes, b: bytes, n_a: int, n_b: int, percent: int) -> bool:
    """Whether the signatures leave room for the similarity.

    Every bit in which they differ is a member of only one set, which bounds the overlap from above.
    """
    width = min(len(a), len(b))
    left, right = (folded(np.frombuffer(x, np.uint8), width) for x in (a, b))
    differing = int(np.bitwise_count(left ^ right).sum())
    most = (n_a + n_b - differing) // 2
    return (100 + percent) * most >= percent * (n_a + n_b)


def _sets(size: int):
    """Per document its set's name, size and signature; at the end how many sets fall on each counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "node", "bits", "chunk"]
        counters = np.zeros(1 << _COUNTER_BITS, np.uint32)
        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            n, node, bits = [], [], []
            waiting: list[np.ndarray] = []
            held = 0
            for own in text_shingles(batch.column(1), size):
                n.append(len(own))
                node.append(node_of(own) if len(own) else None)
                bits.append(signature(own) if len(own) else None)
                waiting.append((own >> np.uint64(64 - _COUNTER_BITS)).astype(np.int64))
                held += len(own)
                if held > 1_000_000:
                    counters += np.bincount(np.concatenate(waiting), minlength=len(counters)).astype(np.uint32)
                    waiting, held = [], 0
            if waiting:
                counters += np.bincount(np.concatenate(waiting), minlength=len(counters)).astype(np.uint32)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(n), pa.int32())], names=names)
        for k in range(0, len(counters), _CHUNK):
            part = counters[k : k + _CHUNK]
            if part.any():
                row = [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())]
                row += [pa.array([part.tobytes()], pa.binary()), pa.array([k // _CHUNK], pa.int32())]
                yield pa.RecordBatch.from_arrays(row, names=names)
        give_back()

    return run


def _add_counters(table: pa.Table) -> pa.Table:
    total = np.zeros(_CHUNK, np.uint64)
    for part in table["bits"].to_pylist():
        total += np.frombuffer(part, np.uint32)
    return pa.table({"chunk": table["chunk"][:1], "bits": pa.array([total.tobytes()], pa.binary())})


def _prefixes(size: int, percent: int, counters: np.ndarray):
    """Per set the shingles of which a similar set must share one: the rarest, as many as could be missing and one.

    The order is by counter and then by hash, the same everywhere; a set that a task has seen is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()

        def rows(tokens: list, nodes: list, sizes: list, counts: list) -> pa.RecordBatch:
            arrays = [np.concatenate(tokens).view(np.int64), np.repeat(nodes, counts), np.repeat(sizes, counts)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["token", "node", "n"])

        for batch in batches:
            tokens, nodes, sizes, counts, held = [], [], [], [], 0
            for own in text_shingles(batch.column(0), size):
                n = len(own)
                if not n or (node := node_of(own)) in seen:
                    continue
                seen.add(node)
                first = n - (percent * n + 99) // 100 + 1
                rank = counters[(own >> np.uint64(64 - _COUNTER_BITS)).astype(np.int64)]
                tokens.append(own[np.argsort(rank, kind="stable")[:first]])
                nodes.append(node)
                sizes.append(n)
                counts.append(first)
                held += first
                if held > 500_000:
                    yield rows(tokens, nodes, sizes, counts)
                    tokens, nodes, sizes, counts, held = [], [], [], [], 0
            if held:
                yield rows(tokens, nodes, sizes, counts)
        give_back()

    return run


def _tiles(percent: int, tile: int):
    """Candidate pairs of sets that share a token, from rows sorted by token, size and node.

    The sets of a token that few share are paired where their sizes allow. Where more than ``tile``
    share it, sizes are cut into bands, and each band is paired with its four first sets only, in the
    order of a hash; the rows themselves (marked by b = NULL) are given out for what is left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "a", "n_a", "b", "n_b"]
        most = 50_000

        def out(token, a, n_a, b, n_b) -> pa.RecordBatch:
            arrays = [pa.array(np.asarray(x, np.int64)) for x in (token, a, n_a)]
            if b is None:
                arrays += [pa.nulls(len(a), pa.int64())] * 2
            else:
                arrays += [pa.array(np.asarray(x, np.int64)) for x in (b, n_b)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def small(node: np.ndarray, n: np.ndarray, count: np.ndarray):
            """All pairs (i, j) of rows of the same run with i before j and sizes that allow a link."""
            end = np.repeat(np.cumsum(count), count)
            i = np.arange(len(node))
            for step in range(1, int(count.max())):
                i = i[i + step < end[i]]
                j = i + step
                fit = (100 * n[i] >= percent * n[j]) & (node[i] != node[j])
                if fit.any():
                    yield i[fit], j[fit]

        def process(token: np.ndarray, node: np.ndarray, n: np.ndarray, many: int | None) -> Iterator[pa.RecordBatch]:
            if not len(token):
                return
            # A set comes once for each task that has seen it.
            fresh = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
            token, node, n = token[fresh], node[fresh], n[fresh]
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
            ends = np.append(starts[1:], len(token))
            count = ends - starts
            large = (count > tile) | ((token[starts] == many) if many is not None else False)
            few = (count >= 2) & ~large
            keep = np.repeat(few, count)
            if few.any():
                t, x, m = token[keep], node[keep], n[keep]
                for i, j in small(x, m, count[few]):
                    yield out(t[i], x[i], m[i], x[j], m[j])
            for a, b in zip(starts[large], ends[large], strict=True):
                yield out(token[a:b], node[a:b], n[a:b], None, None)
                order = mixed(node[a:b].view(np.uint64))
                first = a
                while first < b:
                    last = a + int(np.searchsorted(n[a:b] * percent, 100 * n[first], "right"))
                    last = max(last, first + 1)
                    hubs = first + np.argsort(order[first - a : last - a])[:4]
                    for hub in hubs:
                        others = np.setdiff1d(np.arange(first, last), hub)
                        if len(others):
                            low, high = np.minimum(others, hub), np.maximum(others, hub)
                            yield out(token[low], node[low], n[low], node[high], n[high])
                    first = last

        left = [np.empty(0, np.int64)] * 3
        many = None  # a token whose first rows are gone already
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            left = [np.concatenate([x, y]) for x, y in zip(left, new, strict=True)]
            if len(left[0]) < most:
                continue
            # The last token may go on in the next batch, unless its rows are too many to wait for.
            cut = int(np.searchsorted(left[0], left[0][-1], "left"))
            wait = cut > 0 or len(left[0]) <= 20 * most
            cut = cut if wait else len(left[0])
            yield from process(*(x[:cut] for x in left), many)
            many = many if wait else int(left[0][-1])
            left = [x[cut:] for x in left]
        yield from process(*left, many)

    return run


def _bounded(percent: int):
    """Pairs whose signatures leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k) for k in range(6)]
            n_a, n_b = cols[2].to_pylist(), cols[3].to_pylist()
            bits = zip(cols[4].to_pylist(), cols[5].to_pylist(), n_a, n_b, strict=True)
            fit = pa.array([may_link(x, y, i, j, percent) for x, y, i, j in bits], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(fit) for c in cols[:2]], names=["a", "b"])

    return run


def _compared(percent: int):
    """Pairs whose sets have the similarity, by intersection of the sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                fit.append(100 * common >= percent * (len(left) + len(right) - common))
            mask = pa.array(fit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], names=["a", "b"])

    return run


def _wanted(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which the hash of every id is set."""
    at = ids.select(F.pmod(F.xxhash64("id"), F.lit(1 << _WANTED_BITS)).alias("at"))
    words = at.groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 32 AS INT))")).alias("bits")
    )
    found = words.toArrow()
    bitmap = np.zeros(1 << (_WANTED_BITS - 5), np.uint32)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return bitmap


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 75,
    tile: int = 32,
    block: int = 2000,
    best: int = 3,
) -> DataFrame:
    """Per document the id column, ``n_shingles`` and ``component_id``.

    A-Z are lower-cased; words are runs of bytes other than 0x20 and 0x09-0x0D. A document's set
    holds its distinct runs of ``size`` words (all its words as one, if they are fewer), as 64-bit
    hashes. Two documents are linked when 100 * intersection >= ``percent`` * union. ``component_id``
    is the smallest id that links reach. Whole texts are used, and no link is lost:

    1. Equal sets become one node, named by a 64-bit hash; copies are never compared. Counters of
       fixed number tell which shingles are frequent.
    2. Two linked sets share one of their rarest shingles (the prefix). Sets meet in tiles by such a
       shingle and by bands of size. Tiles of at most ``tile`` sets give all pairs; in larger ones
       every set is paired with four sets of its band.
    3. Bitmap signatures bound the overlap from above; sorted arrays settle what is left. Only sets
       of such pairs are read again and shuffled.
    4. In larger tiles whose sets aren't connected yet, blocks of ``block`` sets compare signatures.
       The sets outside a tile's largest component are compared with all of the tile. Of a set's
       pairs with another component, first those with the ``best`` largest bounds are settled as in
       step 3, as one link is enough; then all pairs of sets that are still apart.

    NULL and empty texts, and texts without words, have no shingles and link with nothing. Documents
    with equal ids are told apart by their sets. A document without an id links others, and its
    ``component_id`` is that of its component, NULL if no id is in it. The id has to be an integer.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    read = stored(texts.mapInArrow(_sets(size), "id bigint, n bigint, node bigint, bits binary, chunk int"), "sets")
    rows = read.filter("chunk IS NULL")

    counters = np.zeros(1 << _COUNTER_BITS, np.uint64)
    added = read.filter("chunk IS NOT NULL").select("chunk", "bits").groupBy("chunk")
    for part in added.applyInArrow(_add_counters, "chunk int, bits binary").collect():
        counters[part["chunk"] * _CHUNK : (part["chunk"] + 1) * _CHUNK] = np.frombuffer(part["bits"], np.uint64)
    counters = np.minimum(counters, 2**32 - 1).astype(np.uint32)

    sets = rows.filter("n > 0")
    per_node = sets.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    bitmaps = sets.select("node", "n", "bits")

    postings = texts.select("text").mapInArrow(
        _prefixes(size, percent, counters), "token bigint, node bigint, n bigint"
    )
    sorted_rows = postings.repartition("token").sortWithinPartitions("token", "n", "node")
    tiles = stored(
        sorted_rows.mapInArrow(_tiles(percent, tile), "token bigint, a bigint, n_a bigint, b bigint, n_b bigint"),
        "tiles",
    )

    def settled(pairs: DataFrame) -> DataFrame:
        """The linked ones among pairs ``a``, ``b`` of different nodes."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = stored(nodes.join(per_node, "node"), "wanted")
        bitmap = _wanted(nodes.filter("id IS NOT NULL").select("id"))

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                at = batch.column(2).to_numpy()
                mask = (bitmap[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
                mask |= batch.column(0).is_null().to_numpy(zero_copy_only=False)
                found = []
                for own in text_shingles(batch.column(1).filter(pa.array(mask)), size):
                    if len(own) and (node := node_of(own)) not in seen:
                        seen.add(node)
                        found.append((node, own.tobytes()))
                columns = [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "members"])
            give_back()

        hashed = texts.withColumn("at", F.pmod(F.xxhash64("id"), F.lit(1 << _WANTED_BITS)))
        members = hashed.mapInArrow(again, "node bigint, members binary")
        members = members.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])
        members = stored(members, "members")
        left = members.select(F.col("node").alias("a"), F.col("members").alias("x"))
        right = members.select(F.col("node").alias("b"), F.col("members").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return both.mapInArrow(_compared(percent), "a bigint, b bigint")

    def bounded(pairs: DataFrame) -> DataFrame:
        """Pairs ``a``, ``b``, ``n_a``, ``n_b`` whose signatures leave room for a link."""
        one = stored(bitmaps.dropDuplicates(["node"]), "signatures")
        left = one.select(F.col("node").alias("a"), F.col("bits").alias("x"))
        right = one.select(F.col("node").alias("b"), F.col("bits").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "x", "y")
        return both.mapInArrow(_bounded(percent), "a bigint, b bigint")

    candidates = tiles.filter("b IS NOT NULL").groupBy("a", "b").agg(F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"))
    links = settled(stored(bounded(candidates), "pairs"))
    found = stored(components(links), "components")

    hot = tiles.filter("b IS NULL").select("token", F.col("a").alias("node"), F.col("n_a").alias("n"))
    for most in (best, None):
        if hot.isEmpty():
            break
        now = hot.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        now = stored(now, "hot")
        parts = now.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
        largest = F.max(F.struct("k", "component"))["component"].alias("largest")
        apart = parts.groupBy("token").agg(largest, F.count(F.lit(1)).alias("parts"))
        apart = stored(apart.filter("parts > 1").select("token", "largest"), "apart")
        rest = now.join(apart, "token")
        hot = rest.select("token", "node", "n")
        tokens = rest.groupBy("node").agg(F.collect_list("token").alias("tokens"))
        rest = rest.join(tokens, "node").join(bitmaps.dropDuplicates(["node"]).select("node", "bits"), "node")
        more = stored(_rest(rest, percent, block, most), "pairs")
        if not more.isEmpty():
            known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = stored(components(known.unionByName(settled(more))), "components")

    labelled = stored(
        rows.join(found, "node", "left").select("id", "n", F.coalesce("component", "node").alias("component")),
        "labelled",
    )
    least = stored(
        labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least")), "least"
    )
    return labelled.join(least, "component", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def _rest(rows: DataFrame, percent: int, block: int, best: int | None) -> DataFrame:
    """Pairs of different components within large tiles whose signatures leave room for a link.

    With ``best``, only so many of a set with each other component in a block, by the largest bound.

    Sizes are cut into bands as wide as a link may span, so a set (left) outside the tile's largest
    component meets the sets (right) of its own band and, a step away, of the next and the last one.
    Either side is cut into blocks of its own, and each pair of blocks is one group, so a group has
    about ``block`` sets from each side at most. Sets that meet in several tiles are paired in the one
    with the smallest token.
    """
    ratio = float(np.log(100 / percent)) if percent < 100 else 1e-9
    band = F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9).cast("bigint")
    inner = (F.col("component") == F.col("largest")).alias("inner")
    rows = rows.select("token", "node", "n", "component", "bits", "tokens", inner, band.alias("band"))
    steps = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    counts = rows.groupBy("token", "band").agg(F.count(F.lit(1)).alias("k"), F.count_if("inner").alias("k_inner"))
    counts = stored(counts, "bands")
    sides = counts.filter("k > k_inner").select("token", "band", F.ceil((F.col("k") - F.col("k_inner")) / block).cast("int").alias("lefts"))
    sides = sides.withColumn("step", steps).withColumn("band", F.col("band") + F.col("step")).join(counts, ["token", "band"])
    # Of two sets outside the largest component, the smaller one finds the larger one a band above.
    met = F.when(F.col("step") < 0, F.col("k_inner")).otherwise(F.col("k"))
    sides = sides.withColumn("rights", F.ceil(met / block).cast("int")).filter("rights > 0")
    sides = stored(sides.select("token", "band", "step", "lefts", "rights"), "blocks")

    def blocks_of(number: str, other: str) -> tuple[Column, Column]:
        """A set's own block, and all blocks of the other side."""
        return F.pmod(F.xxhash64("node"), F.col(number)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))

    keys = ["token", "band", "step"]
    as_left = rows.filter("NOT inner").withColumn("step", steps).withColumn("band", F.col("band") + F.col("step"))
    own, every = blocks_of("lefts", "rights")
    as_left = as_left.join(sides, keys).withColumn("i", own).withColumn("j", every).withColumn("left", F.lit(True))
    as_right = rows.withColumn("step", steps).filter("step >= 0 OR inner")
    own, every = blocks_of("rights", "lefts")
    as_right = as_right.join(sides, keys).withColumn("j", own).withColumn("i", every).withColumn("left", F.lit(False))
    cells = as_left.unionByName(as_right.select(as_left.columns))

    def compare(table: pa.Table) -> pa.Table:
        mask = table["left"].to_numpy()
        left, right = table.filter(pa.array(mask)), table.filter(pa.array(~mask))
        a, b = [], []
        width = min((len(x) for x in table["bits"].to_pylist()), default=8)
        columns = ["node", "n", "component", "inner"]
        x_node, x_n, x_comp, _ = (left[c].to_numpy() for c in columns)
        y_node, y_n, y_comp, y_inner = (right[c].to_numpy() for c in columns)

        def bits(t: pa.Table) -> np.ndarray:
            parts = [folded(np.frombuffer(x, np.uint8), width) for x in t["bits"].to_pylist()]
            return np.stack(parts).view(np.uint64) if parts else np.empty((0, width // 8), np.uint64)

        x_bits, y_bits = bits(left), bits(right)
        x_tokens, y_tokens = (list(map(set, t["tokens"].to_pylist())) for t in (left, right))
        token, step = table["token"][0].as_py(), table["step"][0].as_py()
        for k in range(len(x_node)):
            fit = (y_comp != x_comp[k]) & (100 * np.minimum(y_n, x_n[k]) >= percent * np.maximum(y_n, x_n[k]))
            if not step:
                fit &= y_inner | (y_node > x_node[k])
            at = np.flatnonzero(fit)
            if not len(at):
                continue
            differing = np.bitwise_count(y_bits[at] ^ x_bits[k]).sum(1)
            most = (y_n[at] + x_n[k] - differing.astype(np.int64)) // 2
            room = (100 + percent) * most - percent * (y_n[at] + x_n[k])
            here = room >= 0
            here[here] = [min(x_tokens[k] & y_tokens[i]) == token for i in at[here].tolist()]
            at, room = at[here], room[here]
            if best is not None and len(at):
                order = np.lexsort((y_node[at], -room, y_comp[at]))
                comp = y_comp[at][order]
                heads = np.flatnonzero(np.append(True, comp[1:] != comp[:-1]))
                within = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
                at = at[order[within < best]]
            a += [x_node[k]] * len(at)
            b += y_node[at].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    pairs = cells.groupBy(*keys, "i", "j").applyInArrow(compare, "a bigint, b bigint")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
