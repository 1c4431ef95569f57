"""Spelling variants: words one edit apart, found by a frontier that walks a trie held as an edge table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clustertrace.llm.shared import stored, text_or_empty

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = r"[A-Za-zÀ-ÿ]"
_STATE = ["side", "word", "pos", "node", "edits", "whole"]


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6) -> DataFrame:
    """``id`` and ``run`` for every maximal run of at least ``shortest`` Latin letters, with only A-Z lower-cased.

    A NULL text has no runs; a row that repeats counts as often.
    """
    found = F.regexp_extract_all(text_or_empty(f"`{text_col}`"), F.lit(f"({_LETTERS}{{{shortest},}})"), F.lit(1))
    runs = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(found).alias("run"))
    low = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", _UPPER, _UPPER.lower()))
    return runs.select("id", low.alias("run"))


def _letter(at: str) -> Column:
    """The letter of ``word`` at a place counted from 1; empty beyond the ends."""
    return F.expr(f"CASE WHEN {at} > 0 THEN substring(word, {at}, 1) ELSE '' END")


def _edges(sides: DataFrame, first: int) -> DataFrame:
    """The trie of either side: a row per prefix beyond ``first`` letters, as the edge that leads to it.

    ``many`` is the number of words below, ``only`` one of them, ``whole`` whether the prefix is a word.
    """
    depths = F.explode(F.sequence(F.lit(first + 1), F.length("word")))
    prefixes = sides.filter(F.length("word") > first).select("side", "word", depths.alias("depth"))
    node = F.expr("substring(word, 1, depth)")
    found = prefixes.groupBy("side", "depth", node.alias("child")).agg(
        F.count(F.lit(1)).alias("many"),
        F.min("word").alias("only"),
        F.max(F.length("word") == F.col("depth")).alias("whole_child"),
    )
    parent, letter = F.expr("substring(child, 1, depth - 1)"), F.expr("substring(child, depth, 1)")
    return found.withColumns({"parent": parent, "letter": letter})


def _arrived(rows: DataFrame) -> DataFrame:
    """States after an edge was taken: those that go on, and with ``near`` those that end at a word.

    A path that one word alone takes isn't walked further: what is left of both words is compared at once.
    """
    ended = F.col("pos") == F.length("word")
    alone = F.expr("substring(word, pos + 1) = substring(only, depth + 1)")
    near = (
        F.when(F.col("edits") == 0, F.lit(None).cast("string"))
        .when(F.col("many") == 1, F.when(alone, F.col("only")))
        .when(ended & F.col("whole_child"), F.col("child"))
    )
    rows = rows.withColumn("near", near).filter(F.col("near").isNotNull() | ((F.col("many") > 1) & ~ended))
    return rows.select("side", "word", "pos", F.col("child").alias("node"), "edits", F.col("whole_child").alias("whole"), "near")


def _level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level of the walk: states at nodes of one depth, and the edges that leave these nodes."""
    exact = states.filter("edits = 0 AND pos < length(word)")
    here, after, before = _letter("pos + 1"), _letter("pos + 2"), _letter("pos")
    # Of equal neighbouring letters only the last in reading order is left out, so each result comes up once.
    last = F.when(F.col("side") == "f", here != after).otherwise(here != before)
    shorter = exact.filter(last).withColumns({"pos": F.col("pos") + 1, "edits": F.lit(1)})
    ended = shorter.filter("pos = length(word) AND whole").withColumn("near", F.col("node"))
    # The same letter, or a larger one in its place: the mirror image gives the smaller ones.
    at_node = [exact["side"] == edges["side"], exact["node"] == edges["parent"]]
    replaced = exact.withColumn("next", here).join(edges, at_node).filter("letter >= next")
    replaced = replaced.drop(edges["side"]).withColumn("edits", F.expr("CAST(letter > next AS INT)"))
    once = states.filter("edits = 1").unionByName(shorter.filter("pos < length(word)")).withColumn("next", here)
    at_edge = [once["side"] == edges["side"], once["node"] == edges["parent"], once["next"] == edges["letter"]]
    matched = once.join(edges, at_edge).drop(edges["side"])
    taken = replaced.unionByName(matched).withColumn("pos", F.col("pos") + 1)
    return _arrived(taken).unionByName(ended)


def _short_links(words: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Pairs ``a``, ``b`` of words of at most ``longest`` letters that are one edit apart, each in one order."""
    short = words.filter(F.length("word") <= longest).select("word")
    both = F.explode(F.array(F.struct(F.lit("f").alias("side"), F.col("word").alias("word")), F.struct(F.lit("b").alias("side"), F.reverse("word").alias("word"))))
    sides = stored(short.select(both.alias("s")).select("s.*"), "spelling-words")
    first = shortest // 2
    edges = stored(_edges(sides, first), "spelling-edges")
    start = F.when(F.col("side") == "f", F.floor(F.length("word") / 2)).otherwise(F.ceil(F.length("word") / 2)).cast("int")
    starts = sides.withColumn("pos", start)
    last = starts.agg(F.max("pos")).first()[0]
    tables, states, depth = [], None, first
    while last is not None and (depth <= last or states is not None):
        begun = starts.filter(F.col("pos") == depth).select(
            "side", "word", "pos", F.expr("substring(word, 1, pos)").alias("node"), F.lit(0).alias("edits"), F.lit(False).alias("whole")
        )
        states = begun if states is None else states.unionByName(begun)
        arrived = stored(_level(states, edges.filter(F.col("depth") == depth + 1)), "spelling-level")
        tables.append(arrived.filter("near IS NOT NULL"))
        states = arrived.filter("near IS NULL").select(*_STATE)
        if states.isEmpty():
            states = None
        depth += 1
    if not tables:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    found = reduce(DataFrame.unionByName, tables)
    turned = [F.when(F.col("side") == "f", F.col(c)).otherwise(F.reverse(c)) for c in ("word", "near")]
    return found.select(turned[0].alias("a"), turned[1].alias("b"))


def _holes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of what is left and right of every letter (``hole``) and every gap between letters of each word."""
    kinds = {"name": pa.binary(), "place": pa.int32(), "hole": pa.bool_(), "last": pa.bool_(), "before": pa.binary(), "behind": pa.binary()}
    for batch in batches:
        for word in batch.column(0).to_pylist():
            ends = []
            for letters in (word, word[::-1]):
                state = xxhash.xxh3_128()
                sums = [state.digest()]
                for c in letters:
                    state.update(c.encode())
                    sums.append(state.digest())
                ends.append(sums)
            n, name = len(word), xxhash.xxh3_128_digest(word.encode())
            for begin in range(0, n + 1, 20_000):
                places = range(begin, min(n + 1, begin + 20_000))
                rows = [(name, i, False, True, ends[0][i], ends[1][n - i]) for i in places]
                rows += [(name, i, True, i + 1 == n or word[i + 1] != word[i], ends[0][i], ends[1][n - i - 1]) for i in places if i < n]
                columns = zip(zip(*rows, strict=True), kinds.values(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], names=list(kinds))


def _long_links(words: DataFrame, longest: int) -> DataFrame:
    """The same pairs where the longer word has more than ``longest`` letters.

    Two such words are alike left and right of one letter of either, or of a letter of the longer and a gap
    of the shorter. A word has two rows per letter, each with two hashes, and what they find is compared.
    """
    kept = words.filter(F.length("word") >= longest)
    named = kept.select("word")
    schema = "name binary, place int, hole boolean, last boolean, before binary, behind binary"
    rows = stored(named.mapInArrow(_holes, schema), "spelling-holes")
    key = ["place", "before", "behind"]
    one, other = rows.filter("hole").alias("x"), rows.alias("y")
    same = reduce(lambda p, c: p & c, [F.col(f"x.{k}") == F.col(f"y.{k}") for k in key])
    kind = F.when(F.col("y.hole"), F.col("x.name") < F.col("y.name")).otherwise(F.col("x.last"))
    pairs = one.join(other, same).filter(kind).select("x.name", F.col("y.name").alias("near"), "x.place", "y.hole")
    names = _named(named)
    near = names.select(F.col("name").alias("near"), F.col("word").alias("b"))
    found = pairs.join(names.withColumnRenamed("word", "a"), "name").join(near, "near")
    right = F.expr("left(a, place) = left(b, place) AND substring(a, place + 2) = substring(b, place + IF(hole, 2, 1))")
    return found.filter(right & (F.length("a") > longest)).select("a", "b")


def _named(words: DataFrame) -> DataFrame:
    """Each word with the 128-bit name that its holes carry."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [xxhash.xxh3_128_digest(w.encode()) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0)], names=["name", "word"])

    return words.mapInArrow(names, "name binary, word string")


def one_edit_links(words: DataFrame, shortest: int = 6, longest: int = 48) -> DataFrame:
    """Pairs ``a``, ``b`` of the distinct ``word`` that differ by one inserted, deleted or replaced code point.

    Each pair comes once, in one of its two orders. Words of fewer than ``shortest`` (at least 3) letters take
    no part. An edit lies in one half of a word. So each word is walked twice, forwards and backwards, and
    enters the walk where its first half, which is then left as it is, ends: as a state (word, position,
    node, edits) at the node of its own prefix. Level by level the states are joined with the edges of two
    tries, one of the words and one of the words read backwards: to the same letter, once to a larger letter
    instead, or once past a letter without an edge. States that have used their edit and reach the end of the
    word at a node that is a word are pairs. A node with a single word below is a leaf with the rest of that word, so
    the walk is as deep as the longest prefix that words share. Each level is written to the shared
    folder. A node's states are as many as the words within an edit of its prefix; the joins are plain, so
    that Spark splits them where a node is hot, and a state meets one edge per letter of the alphabet at most.

    Beyond ``longest`` letters a walk would have too many levels: pairs whose longer word is beyond it are
    found by what is left and right of each of its letters, in a number of rows in proportion to its length.
    """
    long = words.agg(F.max(F.length("word"))).first()[0] or 0
    links = _short_links(words.filter(F.length("word") >= shortest), shortest, longest)
    return links.unionByName(_long_links(words, longest)) if long > longest else links


def spelling_variants(
    occurrences: DataFrame,
    word_col: str = "word",
    shortest: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    longest: int = 48,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per distinct word of at least ``shortest`` letters and ``least_count`` rows.

    Words are near if one inserted, deleted or replaced code point makes one the other. A word's ``form`` is its near
    word of largest ``n`` (of equal ones the smallest), if that is at least ``ratio`` times its own; ``root`` follows the forms to the last,
    and is the word itself without one. Counts of forms grow by ``ratio`` (2 at least), so a chain has
    few steps; it is shortened by doubling. A NULL word counts nowhere, and no rows give none.
    """
    word = F.col(f"`{word_col}`").cast("string")
    counted = occurrences.select(word.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stored(counted.filter(F.col("n") >= least_count), "spelling-counts")
    links = stored(one_edit_links(words, shortest, longest), "spelling-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = both.join(counts, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("n"), "b")).alias("best")
    )
    enough = -F.col("best.n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("best.b")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    formed = stored(formed, "spelling-forms")
    roots = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = stored(roots.join(onward, "root", "left").select("word", "root", "onward"), "spelling-roots")
        roots = moved.select("word", F.coalesce("onward", "root").alias("root"))
        if moved.filter("onward IS NOT NULL").isEmpty():
            break
    root = F.coalesce("root", "word").alias("root")
    return formed.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
