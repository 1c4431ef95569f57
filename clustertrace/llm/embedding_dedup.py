"""Near-duplicate embeddings by an inverted multi-index over vector halves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.components import components, forest
from clustertrace.llm.shared import stored

#: Stands for the id of vectors without one; any real id is smaller.
_NO_ID = 1 << 62


def unit_rows(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows of length 1 in double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    # A power of two is exact, and keeps squares of very large or small numbers in range.
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True, initial=0))[1])
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


@dataclass
class MultiIndex:
    """Two codebooks, whose pairs of codewords are the cells, and how far the traversal goes."""

    books: list[np.ndarray]
    reach: float

    @property
    def n_cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def bounds(self, rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per half, the least squared way from each row into each codeword's region; and the rows' own cells."""
        out, own, first = [], np.zeros(len(rows), np.int64), 0
        for book in self.books:
            part = rows[:, first : first + book.shape[1]]
            first += book.shape[1]
            far = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
            near = far.argmin(1)
            apart = np.sqrt(np.maximum(((book[:, None] - book[None]) ** 2).sum(2), 1e-12))
            # The way to the plane halfway between the nearest codeword and another.
            way = np.maximum((far - far[np.arange(len(rows)), near][:, None]) / (2 * apart[near]), 0)
            way[np.arange(len(rows)), near] = 0
            out.append(way**2)
            own = own * len(book) + near
        return out, own

    def visited(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each row's own cell, and the cells it visits besides: nearest first, up to the reach.

        The codewords of both halves are sorted by their bound, and the sorted product is walked
        like a staircase: for each codeword of the first half as many of the second as still fit.
        """
        (one, two), own = self.bounds(rows)
        size = len(self.books[1])
        order_1, order_2 = one.argsort(1, kind="stable"), two.argsort(1, kind="stable")
        found = []
        for k in range(len(rows)):
            a, b = one[k][order_1[k]], two[k][order_2[k]]
            a = a[: np.searchsorted(a, self.reach, "right")]
            fit = np.searchsorted(b, self.reach - a, "right")
            i = np.repeat(np.arange(len(a)), fit)
            j = np.arange(fit.sum()) - np.repeat(np.cumsum(fit) - fit, fit)
            cells = order_1[k][i] * size + order_2[k][j]
            nearest = np.argsort(a[i] + b[j], kind="stable")
            cells = cells[nearest]
            found.append(cells[cells != own[k]])
        return own, found


def _codebook(rows: np.ndarray, size: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    book = rows[rng.permutation(len(rows))[:size]].copy()
    for _ in range(rounds):
        near = ((book**2).sum(1) - 2 * rows @ book.T).argmin(1)
        counts = np.bincount(near, minlength=len(book))
        for k in range(rows.shape[1]):
            sums = np.bincount(near, rows[:, k], len(book))
            book[:, k] = np.where(counts > 0, sums / np.maximum(counts, 1), book[:, k])
    return book


def build(rows: np.ndarray, size: int, least_cosine: float, recall: float, rounds: int = 10, seed: int = 5) -> MultiIndex:
    """Codebooks of ``size`` words for the halves of a sample of unit rows.

    The reach is set for the target ``recall`` at the hardest pairs: each sample row is paired with a
    row at exactly ``least_cosine`` in a random direction, and the reach covers that share of them.
    """
    rng = np.random.default_rng(seed)
    half = max(1, rows.shape[1] // 2)
    halves = [rows[:, :half], rows[:, half:]]
    index = MultiIndex([_codebook(x, min(size, len(x)), rounds, rng) for x in halves], 0.0)
    noise = rng.normal(size=rows.shape)
    noise -= (noise * rows).sum(1, keepdims=True) * rows
    norm = np.sqrt((noise**2).sum(1, keepdims=True))
    noise = np.divide(noise, norm, out=np.zeros_like(noise), where=norm > 1e-12)
    other = least_cosine * rows + np.sqrt(1 - least_cosine**2) * noise
    (one, two), _ = index.bounds(rows)
    _, cells = index.bounds(other)
    at = np.arange(len(rows))
    needed = one[at, cells // len(index.books[1])] + two[at, cells % len(index.books[1])]
    index.reach = float(np.quantile(needed, recall, method="higher")) + 1e-9
    return index


def _is_usable(column: Column) -> Column:
    """Whether a vector has entries, all of them finite numbers, and isn't zero."""
    limit = F.lit(float("inf"))
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    return F.coalesce((F.size(column) > 0) & ~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def _few(least_cosine: float):
    """Links among all vectors of one length, where they are few enough for one matrix product."""

    def compare(table: pa.Table) -> pa.Table:
        node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
        x = unit_rows(table["v"].combine_chunks(), table["d"][0].as_py())
        alike = x @ x.T >= least_cosine
        np.fill_diagonal(alike, False)
        a, b = forest(*(node[k] for k in np.nonzero(alike)))
        no_end = np.arange(len(node) + len(a)) < len(node)
        return pa.table(
            {
                "a": pa.array(np.concatenate([node, a])),
                "b": pa.array(np.concatenate([node, b]), mask=no_end),
                "n": pa.array(np.concatenate([alike.astype(np.int64) @ weight, np.zeros(len(a), np.int64)])),
            }
        )

    return compare


def _compared(
    groups: DataFrame, dims: int, n_groups: int, least_cosine: float, recall: float, sample: int, per_cell: int, most_words: int, block: int
) -> DataFrame:
    """Sums of links (``a``, ``n``) and links (``a``, ``b``) of different vectors of one length."""
    picked = groups.orderBy(F.xxhash64("v"), "node").limit(sample).select("v").toArrow()["v"].combine_chunks()
    words = 1 << int(np.clip(round(np.log2(max(1.0, n_groups / per_cell)) / 2), 1, np.log2(most_words)))
    index = build(unit_rows(picked, dims), words, least_cosine, recall)
    n_cells = index.n_cells

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, visits = np.zeros(n_cells, np.int64), np.zeros(n_cells, np.int64)
        for batch in batches:
            own, others = index.visited(unit_rows(batch.column(0), dims))
            members += np.bincount(own, minlength=n_cells)
            visits += np.bincount(np.concatenate([*others, np.empty(0, np.int64)]).astype(np.int64), minlength=n_cells)
        at = np.flatnonzero(members + visits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(members[at]), pa.array(visits[at])], names=["cell", "m", "v"])

    # Two numbers per cell; the number of cells is bounded by the size of the codebooks.
    tally = groups.select("v").mapInArrow(counted, "cell bigint, m bigint, v bigint")
    tally = tally.groupBy("cell").agg(F.sum("m").alias("m"), F.sum("v").alias("v")).toArrow()
    n_blocks, n_parts = np.ones(n_cells, np.int64), np.ones(n_cells, np.int64)
    at, m, v = (tally[c].to_numpy().astype(np.int64) for c in ("cell", "m", "v"))
    n_blocks[at] = np.maximum(1, -(-m // block))
    n_parts[at] = np.maximum(1, -(-(v + m) // (4 * block)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of each group: members of the cell's block, and visitors with the cell they come from."""
        for batch in batches:
            node = batch.column(0).to_numpy()
            own, others = index.visited(unit_rows(batch.column(1), dims))
            mix = (node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            out = []  # row, cell, block, part, member
            for k, (home, cells) in enumerate(zip(own.tolist(), others, strict=True)):
                mine = int(mix[k] % np.uint64(n_blocks[home]))
                out += [(k, home, mine, p, True) for p in range(n_parts[home])]
                part = int(mix[k] // np.uint64(n_blocks[home]) % np.uint64(n_parts[home]))
                out += [(k, home, i, part, False) for i in range(mine)]
                for cell in cells.tolist():
                    if m_of[cell]:
                        part = int(mix[k] % np.uint64(n_parts[cell]))
                        out += [(k, cell, i, part, False) for i in range(n_blocks[cell])]
            for first in range(0, len(out), 20_000):
                row, cell, i, part, member = (np.array(c) for c in zip(*out[first : first + 20_000], strict=True))
                take = pa.array(row)
                offsets = np.append(0, np.cumsum([len(others[r]) if f else 0 for r, f in zip(row, member, strict=True)]))
                flat = [others[r] for r, f in zip(row, member, strict=True) if f and len(others[r])]
                visits = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(flat) if flat else np.empty(0, np.int64))
                )
                arrays = [pa.array(x) for x in (cell, i, part)] + [batch.column(c).take(take) for c in range(3)]
                arrays += [pa.array(own[row]), pa.array(member), visits]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["cell", "block", "part", "node", "v", "weight", "home", "member", "visits"]
    m_of = np.zeros(n_cells, bool)
    m_of[at] = m > 0

    def compare(table: pa.Table) -> pa.Table:
        empty = np.empty(0, np.int64)
        member = table["member"].to_numpy()
        base, guest = table.filter(pa.array(member)), table.filter(pa.array(~member))
        cell = table["cell"][0].as_py()
        first_part = table["part"][0].as_py() == 0
        b_node, b_weight = base["node"].to_numpy(), base["weight"].to_numpy()
        if not len(b_node):
            return pa.table({"a": pa.array(empty), "b": pa.array(empty), "n": pa.array(empty)})
        x = unit_rows(base["v"].combine_chunks(), dims)
        visits = [set(c) for c in base["visits"].to_pylist()]
        links: list[tuple[np.ndarray, np.ndarray]] = []
        nodes, sums = [], []

        def add(i: np.ndarray, j: np.ndarray, j_node: np.ndarray, j_weight: np.ndarray) -> None:
            nodes.extend([b_node[i], j_node[j]])
            sums.extend([j_weight[j], b_weight[i]])
            a, b = forest(b_node[i], j_node[j])
            links.append((a, b))

        if first_part:
            for k in range(0, len(x), 512):
                i, j = np.nonzero(x[k : k + 512] @ x.T >= least_cosine)
                i, j = i[i + k < j] + k, j[i + k < j]
                add(i, j, b_node, b_weight)
        g_node, g_weight, home = (guest[c].to_numpy() for c in ("node", "weight", "home"))
        if len(g_node):
            y = unit_rows(guest["v"].combine_chunks(), dims)
            for k in range(0, len(x), 512):
                i, j = np.nonzero(x[k : k + 512] @ y.T >= least_cosine)
                i = i + k
                # A pair whose vectors visit each other counts in the cell with the smaller number.
                there = [home[q] < cell and int(home[q]) in visits[p] for p, q in zip(i.tolist(), j.tolist(), strict=True)]
                here = ~np.array(there, bool)
                add(i[here], j[here], g_node, g_weight)
        every, total = np.unique(np.concatenate([*nodes, empty]), return_inverse=True)
        count = np.bincount(total, np.concatenate([*sums, empty]), len(every)).astype(np.int64)
        a, b = forest(*(np.concatenate([*(p[k] for p in links), empty]) for k in (0, 1)))
        return pa.table(
            {
                "a": pa.array(np.concatenate([every, a])),
                "b": pa.array(np.concatenate([np.zeros(len(every), np.int64), b]), mask=np.arange(len(every) + len(a)) < len(every)),
                "n": pa.array(np.concatenate([count, np.zeros(len(a), np.int64)])),
            }
        )

    schema = "cell bigint, block bigint, part bigint, node bigint, v array<float>, weight bigint, home bigint, member boolean, visits array<bigint>"
    schema = schema.replace("array<float>", groups.schema["v"].dataType.simpleString())
    found = groups.select("node", "v", "weight").mapInArrow(dealt, schema)
    return stored(found.groupBy("cell", "block", "part").applyInArrow(compare, "a bigint, b bigint, n bigint"), "compared")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least_cosine: float = 0.95,
    recall: float = 0.999,
    sample: int = 20_000,
    per_cell: int = 64,
    most_words: int = 1024,
    block: int = 2048,
) -> DataFrame:
    """Per vector the id column, ``n_links``, ``component_id`` and ``kept``.

    Two vectors link when their cosine, in double precision, is at least ``least_cosine``; ``n_links``
    counts the other vectors linked, ``component_id`` is the smallest id that links reach, and a
    vector is ``kept`` where that is its own.

    1. Equal vectors are grouped and compared once; their number counts as links.
    2. Codebooks for the two halves are trained on ``sample`` vectors, with about ``per_cell`` vectors
       a cell and at most ``most_words`` words each. Every vector is put in its cell and visits the
       nearest cells, in the order of a lower bound of the way into them, until ``recall`` is reached
       for pairs at the threshold; closer pairs are found more surely. A pair is found if either
       vector visits the other's cell.
    3. Cells and their visitors are cut into blocks of ``block`` and four times as many rows, so a hot
       cell is many groups; each group compares all its pairs by one matrix product. It gives out
       sums of links and as few links as connect the same vectors, never all pairs.

    Vectors of different lengths don't link. The commonest length, and each with more than ``block`` different
    vectors, has codebooks of its own; the vectors of a rarer length are one group, compared by one product.

    A vector that is NULL, empty or zero, or holds a NULL or a number that isn't finite
    links with nothing. A table of any other shape, also an empty one, gives a row per row. A vector without an id counts and links for
    others; its ``component_id`` is that of its component, NULL if no id is in it, and it isn't kept.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    rows = rows.withColumn("ok", _is_usable(F.col("v")))
    sizes = rows.filter("ok").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    alone = rows.select(
        F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").cast("bigint").alias("component_id")
    )
    if sizes is None:
        return alone.withColumn("kept", F.col(id_col).isNotNull())
    usable = F.col("ok")
    placeholder = F.lit(_NO_ID) + F.shiftright(F.xxhash64("v"), 2).bitwiseAND(F.lit((1 << 61) - 1))
    groups = rows.filter(usable).groupBy("v").agg(F.min("id").cast("bigint").alias("id"), F.count(F.lit(1)).alias("weight"))
    groups = groups.select(F.coalesce("id", placeholder).alias("node"), "v", "weight", F.size("v").alias("d"))
    groups = stored(groups, "vectors")
    # A row per length with many vectors.
    many = groups.groupBy("d").count().filter((F.col("count") > block) | (F.col("d") == sizes["d"])).collect()
    parts = [
        _compared(groups.filter(F.col("d") == r["d"]).drop("d"), r["d"], r["count"], least_cosine, recall, sample, per_cell, most_words, block)
        for r in many
    ]
    few = groups.filter(~F.col("d").isin([r["d"] for r in many])).groupBy("d")
    parts.append(few.applyInArrow(_few(least_cosine), "a bigint, b bigint, n bigint"))
    found = stored(reduce(DataFrame.unionByName, parts), "compared")
    sums = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    labels = components(found.filter("b IS NOT NULL").select("a", "b"))
    known = groups.join(sums, groups["node"] == sums["a"], "left").drop("a").join(labels, "node", "left")
    known = stored(
        known.select(
            F.col("v").alias("w"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "labelled",
    )
    linked = rows.withColumn("v", F.when(usable, F.col("v"))).join(known, F.col("v") == F.col("w"), "left")
    component = F.when(F.col("w").isNull(), F.col("id").cast("bigint")).otherwise(
        F.when(F.col("component_id") < _NO_ID, F.col("component_id"))
    )
    return linked.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
