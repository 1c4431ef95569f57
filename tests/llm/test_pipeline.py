import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clustertrace.llm.shared import stored
from tests.llm.test_ngram_join import brute


@pytest.fixture(scope="module")
def stages(spark, documents, sf_dir):
    """The rows that each stage gets and gives, as the check tool runs them."""
    seen, docs = [], documents
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir), "stage")
        seen.append((name, docs, out))
        docs = out
    return seen


def test_order_and_columns(stages, documents):
    assert [n for n, *_ in stages] == ["language ID", "toxicity", "exact dedup", "n-gram Jaccard join", "packing"]
    assert all(out.columns == documents.columns for _, _, out in stages[:-1])


def test_language_keeps_clean_documents(stages):
    _, docs, out = stages[0]
    assert out.count() == docs.count()


def test_toxic_documents_go(stages, spark, sf_dir):
    _, docs, out = stages[1]
    kept = {r["doc_id"] for r in out.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    right = [(r["doc_id"] in kept) == (r["toxic"] == 0) for r in labels]
    assert sum(right) / len(right) > 0.97


def test_one_of_equal_texts_stays(stages):
    _, docs, out = stages[2]
    norm = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    expected = docs.groupBy(norm).agg(F.min("doc_id").alias("doc_id"))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in expected.collect())


def test_one_of_similar_texts_stays(stages):
    _, docs, out = stages[3]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _, c in brute(rows) if i == c)


def test_all_tokens_are_packed(stages):
    _, docs, out = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()}
    got = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == expected


def test_run(stages, spark, sf_dir):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.agg(F.sum("length")).first() == stages[-1][2].agg(F.sum("length")).first()
    assert set(columns) <= set(rows.columns)


def shuffled(frame):
    """Rows that the joins and groupings of a frame write to shuffles, by the final plan's metrics."""
    frame.collect()
    plan, rows, seen = frame._jdf.queryExecution().executedPlan(), 0, []
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        else:
            if name == "Exchange" and node.id() not in seen:
                seen.append(node.id())
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
    return rows


@pytest.mark.parametrize("share", [0, 10, 1])
def test_texts_that_stay_are_not_shuffled(spark, monkeypatch, share):
    """However long the list of dropped keys is; with few bits texts that stay are compared as well, and stay."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    rows = [(k if k % 9 else None, f"text {k} " * 20, "`x`") for k in range(3000)]
    docs = stored(spark.createDataFrame([*rows, rows[4], rows[10]], "doc_id bigint, text string, `a.b` string"), "docs")
    lost = docs.filter(F.expr(f"text RLIKE 'text [0-9]*0 ' AND {share} > 0") if share != 1 else F.lit(True))
    keys = corpus_pipeline._keyed(lost).select("__key")
    spark.conf.set(threshold, "-1")
    try:
        for bits in (24, 6):
            monkeypatch.setattr(corpus_pipeline, "_BITMAP", bits)
            left = corpus_pipeline._without(docs, keys)
            expected = sorted(map(str, docs.exceptAll(lost).collect()))
            assert sorted(map(str, left.collect())) == expected and left.columns == docs.columns
            n = shuffled(left)
            # The keys of the list and the words of the bitmap besides.
            assert bits == 6 or n <= 4 * lost.count()
    finally:
        spark.conf.set(threshold, before)


def test_exact_dedup_shuffles_few_whole_rows(spark, sf_dir):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    rows = [(k, f"text {k} " * 20) for k in range(2000)]
    rows += [(k + 5000, rows[k][1]) for k in range(100)] + rows[200:250] + [(None, rows[300][1])]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string"), "docs")
    spark.conf.set(threshold, "-1")
    try:
        left = corpus_pipeline.exact_dedup(spark, docs, sf_dir)
        assert sorted(map(tuple, left.collect())) == sorted(rows[:2000])
        n = shuffled(left)
        assert 100 <= n <= 1200
    finally:
        spark.conf.set(threshold, before)


def test_odd_documents_pass_every_stage(spark, odd, none, documents, sf_dir):
    """Rows are decided one by one, also where ids are NULL or repeated."""
    english = [r["text"] for r in documents.filter("lang = 'en' AND length(text) > 900").orderBy("doc_id").limit(6).collect()]
    near = english[0] + " tail"
    rows = [
        (None, english[0], 1), (None, "123 ...", 2), (7, english[1], 3), (7, "...", 4), (7, english[2], 5), (7, english[2], 6),
        (3, near, 7), (9, english[3], 8), (8, english[3], 9), (None, english[3], 10), (None, english[4], 11), (None, english[4], 12), (2, english[5], 13),
    ]
    schema = "doc_id bigint, text string, lang string, source string, duplicate int, kept boolean, component_id int"
    own = [(i, t, "en", "src1", k, True, 0) for i, t, k in rows]
    docs = documents.select("doc_id", "text", "lang", "source").limit(0)
    docs = spark.createDataFrame(own, schema).unionByName(docs, allowMissingColumns=True).repartition(3)
    numbers = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "toxicity":
            out = stored(stage(spark, docs, sf_dir), "stage")
            assert out.columns == docs.columns
            docs = out
        numbers.append(sorted(r["duplicate"] for r in docs.collect()))
    assert numbers[0] == [1, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13]  # 2 and 4 have no letters
    assert [k for k in numbers[2] if k not in (5, 6, 11, 12)] == [1, 3, 7, 9, 13]
    assert len(set(numbers[2]) & {5, 6}) == len(set(numbers[2]) & {11, 12}) == 1
    assert [k for k in numbers[3] if k not in (5, 6, 11, 12)] == [3, 7, 9, 13]  # 7 has an id, 1 has none
    for docs in (odd, none):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir), "stage")
        assert docs.count() == 0 if n == 0 else docs.count() >= 1
