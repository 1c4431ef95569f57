import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clustertrace.llm.queries import op6_toxicity
from clustertrace.llm.toxicity import Model, by_length, fit, held_out, score, tail_rise, train, without_toxic


def test_held_out_accuracy(spark):
    rows = op6_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert all(rows["held_out"] == rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0))
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.5)).all()
    held = labels.merge(rows[rows["held_out"]], on="doc_id")
    right = held["predicted"] == held["toxic"]
    assert right.mean() > 0.96
    # Some toxic rows there hold no sign of it.
    assert right[held["toxic"] == 1].mean() > 0.8


def test_long_clean_texts(spark):
    """Varied clean texts of 20,000 and more words, made of held-out documents; README has the share rejected."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = fit(docs, labels)
    clean = docs.join(labels.filter("toxic = 0"), "doc_id").filter(held_out("doc_id")).orderBy("doc_id")
    texts, words = [[]], 0
    for r in clean.select("text").collect():
        texts[-1].append(r["text"])
        words += len(r["text"].split())
        if words >= 20_000:
            texts, words = [*texts, []], 0
    long = model.scores(pa.array([" ".join(x) for x in texts[:-1]]))
    assert len(long) >= 10 and np.mean(long >= 0.5) <= 0.05


def test_the_worst_of_many_segments_is_higher_by_chance():
    rng = np.random.default_rng(5)
    rise = tail_rise(rng.exponential(1.5, 20_000))
    assert abs(rise - 1.5) < 0.1
    usual, many = (rng.exponential(1.5, (400, n)).max(1).mean() for n in (100, 10_000))
    assert abs(by_length(np.array([10_000]), rise, 100)[0] - (many - usual)) < 0.5
    assert by_length(np.array([0, 1, 100]), rise, 100).tolist() == [0, 0, 0]
    assert tail_rise(np.empty(0)) == tail_rise(np.ones(5)) == 0


def test_a_long_toxic_text_is_still_found():
    """Clean texts of thousands of words, each followed by a clearly toxic line."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("aeiourtnsl"), rng.integers(3, 8))) for _ in range(400)]
    texts = [" ".join([*rng.choice(words, 40), *(["worthless moron"] if k < 200 else [])]) for k in range(600)]
    model = train(pa.array(texts), np.arange(600) < 200)
    long = [" ".join(rng.choice(words, 8_000)) for _ in range(20)]
    assert (model.scores(pa.array(long)) < 0.5).all()
    assert (model.scores(pa.array([f"{x} worthless moron worthless moron" for x in long])) >= 0.5).all()


def test_segments_of_an_epoch_are_parameters():
    texts = pa.array([f"{'bad' if k % 2 else 'good'} word{k} and more of it " * 5 for k in range(40)])
    toxic = np.arange(40) % 2 == 1
    whole, few = (train(texts, toxic, epoch_segments=n, clean_segments=n).scores(texts) for n in (10**9, 8))
    assert ((whole >= 0.5) == toxic).all() and not np.array_equal(whole, few)


def test_unseen_misspellings():
    insults = ["moronic", "stupidity", "worthless", "disgusting"]
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeiourtnsl"), rng.integers(3, 8))) for _ in range(400)]

    def text(extra=()):
        return " ".join(rng.permutation([*rng.choice(words, 40), *extra]))

    texts = [text([insults[k % 4]]) for k in range(200)] + [text() for _ in range(400)]
    model = train(pa.array(texts), np.arange(600) < 200)
    assert (model.scores(pa.array(["you are stupidityy", "a moronnic idea", "so worthlesss", "disgustingg"])) >= 0.5).all()
    assert (model.scores(pa.array([text() for _ in range(100)])) < 0.5).mean() > 0.97


def test_a_long_text_counts_by_its_worst_segment():
    texts = ["a b c d badword e f g", "a b c d e f g h"] * 20
    model = train(pa.array(texts), np.array([True, False] * 20))
    long = " ".join("abcdefgh"[k % 8] for k in range(50_000))
    clean, toxic = model.scores(pa.array([long, long + " badword"]))
    assert clean < 0.5 <= toxic


def test_odd_rows(spark, odd, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(documents, labels)
    got = score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] < 0.5 for r in got if r["doc_id"] in (3, 4, 7))
    kept = without_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r["score"] < 0.5 for r in got)


def test_without_labels_or_one_class(spark, none, odd, documents):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert all(r["score"] < 1e-9 for r in score(odd, fit(documents, empty)).collect())
    toxic = documents.select("doc_id", F.lit(1).alias("toxic"))
    assert {r["score"] for r in score(documents, fit(documents, toxic)).collect()} == {1.0}
    odd_labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (5, 0)], "doc_id bigint, toxic int")
    assert isinstance(fit(odd, odd_labels), Model)
    assert score(none, fit(none, empty)).collect() == []
