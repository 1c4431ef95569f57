import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from clustertrace.llm.queries import ORACLES, op11_spelling_variants
from clustertrace.llm.spelling import letter_runs, one_edit_links, spelling_variants

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, letters):
    """All texts one edit away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def brute_links(words):
    letters = set("".join(words))
    return {tuple(sorted((a, b))) for a in words for b in edits(a, letters) if b in words}


def brute(n, ratio=5):
    near = {w: set() for w in n}
    for a, b in brute_links(set(n)):
        near[a].add(b)
        near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}


def links_of(frame, **options):
    rows = [tuple(r) for r in one_edit_links(frame, **options).collect()]
    assert len(rows) == len(set(map(tuple, map(sorted, rows))))
    return {tuple(sorted(r)) for r in rows}


def as_words(spark, words):
    return spark.createDataFrame([(w,) for w in sorted(words)], "word string")


def random_words(seed, n, letters, least, most):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(least, most))) for _ in range(n)}
    for w in list(words):
        words |= {x for x in rnd.sample(sorted(edits(w, letters)), 2) if len(x) >= least}
    return words


@pytest.mark.parametrize("longest", [48, 8])
def test_links(spark, longest):
    words = random_words(1, 120, "ab", 6, 9) | random_words(2, 60, "aé×ÿ", 6, 9)
    assert links_of(as_words(spark, words), longest=longest) == brute_links(words)


def test_short_words(spark):
    words = random_words(3, 40, "abc", 3, 5)
    assert links_of(as_words(spark, words), shortest=3) == brute_links(words)


def test_long_words(spark):
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdef") for _ in range(3000))
    words = {long, long[:-1], long[:1500] + "z" + long[1501:], long[1:], long[:700] + "aa" + long[700:], "x" * 12, "x" * 13, "x" * 14, "y" + "x" * 11, "y" + "x" * 12}
    expected = {tuple(sorted(p)) for p in [
        (long, long[:-1]), (long, long[:1500] + "z" + long[1501:]), (long, long[1:]), ("x" * 12, "x" * 13), ("x" * 13, "x" * 14),
        ("x" * 12, "y" + "x" * 11), ("x" * 13, "y" + "x" * 12), ("x" * 12, "y" + "x" * 12), ("y" + "x" * 11, "y" + "x" * 12),
    ]}
    assert links_of(as_words(spark, words), longest=12) == expected


def test_hot_prefix(spark):
    """A family with one prefix: links stay those of a walk, not all pairs."""
    words = {"prefixed" + a + b for a in "abcdefghij" for b in "abcdefghij"}
    assert links_of(as_words(spark, words)) == brute_links(words)


def test_forms_and_ties(spark):
    n = {"letter": 500, "lettre": 100, "leter": 9, "lettex": 20, "letterx": 20, "lettr": 6, "lettrx": 5, "lette": 7}
    n |= {"aaaaaa": 1000, "aaaaab": 200, "aaaabb": 40, "aaabbb": 8, "bbbbbb": 5, "abbbbb": 5, "cccccc": 25, "ccccca": 25, "cccccx": 5}
    rows = [(w, k) for w, c in n.items() for k in range(c)] + [(None, 1)] * 9 + [("rarely", 1)] * 4
    frame = spark.createDataFrame(rows, "word string, root int").repartition(4)
    got = sorted(tuple(r) for r in spelling_variants(frame).collect())
    assert got == brute({w: c for w, c in n.items() if len(w) >= 6})
    assert ("aaabbb", "aaaabb", "aaaaaa", 8, 1, 40) in got and ("cccccx", "ccccca", "ccccca", 5, 2, 25) in got


def test_odd_rows(odd, none):
    runs = letter_runs(odd)
    assert runs.filter("run IS NULL").count() == 0
    assert spelling_variants(runs.withColumnRenamed("run", "word"), least_count=1).count() == 1
    assert spelling_variants(letter_runs(none), word_col="run").collect() == []


def test_runs(spark):
    rows = [(1, "ABCDEFÉé short1 ×××××× Ÿabcdef"), (2, None), (3, "Same-Letters's"), (3, "Same-Letters's")]
    got = sorted(tuple(r) for r in letter_runs(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert got == sorted([(1, "abcdefÉé"), (1, "×" * 6), (1, "abcdef"), (3, "letters"), (3, "letters")])


def test_documents(spark, documents, sf_dir):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    result = op11_spelling_variants(spark, sf_dir)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in result.collect())
    assert got == brute(brute_words(rows))
    assert any(r[1] for r in got)


def test_oracle(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cursor = duck.execute(ORACLES["op11_spelling_variants"])
    assert [c[0] for c in cursor.description] == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in op11_spelling_variants(spark, sf_dir).collect())
    assert sorted(cursor.fetchall()) == got


def test_no_cross_join(spark):
    frame = as_words(spark, {"prefix" + c for c in "abcdef"}).withColumn("n", F.lit(1))
    plan = one_edit_links(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
