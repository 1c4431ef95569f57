import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clustertrace.llm.language_id import TextModel, fit_text, identify, letter_trigrams
from clustertrace.llm.queries import op2_language_id
from clustertrace.llm.words import utf8


def test_held_out_accuracy(documents):
    train, rest = documents.filter("doc_id % 2 = 0"), documents.filter("doc_id % 2 = 1")
    model = fit_text(train)
    rows = {r["doc_id"]: r for r in identify(rest, model=model).collect()}
    truth = {r["doc_id"]: r["lang"] for r in rest.collect()}
    assert set(rows) == set(truth)
    # The declared language is hidden, so text and host have to do.
    hidden = {r["doc_id"]: r for r in identify(rest.withColumn("lang", rest["text"].substr(1, 0)), model=model).collect()}
    for found in (rows, hidden):
        assert np.mean([found[i]["language"] == truth[i] for i in truth]) > 0.97
    assert all(r["kept"] for r in rows.values())


def test_odd_rows(odd, documents):
    rows = identify(odd, model=fit_text(documents)).collect()
    assert len(rows) == odd.count()
    without_letters = {3, 4, 7}
    for r in rows:
        assert r["probability"] is not None and 0 < r["probability"] <= 1 + 1e-9
        if r["doc_id"] in without_letters:
            assert r["language"] is None and not r["kept"]
    assert identify(odd).count() == len(rows)  # trained on the odd rows themselves


def test_empty_table(none):
    assert identify(none).collect() == []


def test_noise_is_rejected(spark, documents):
    rng = np.random.default_rng(1)
    noise = ["".join(rng.choice(list("qxzjkvwbp"), 8)) for _ in range(60)]
    rows = spark.createDataFrame([(1, " ".join(noise), "en", "s")], "doc_id bigint, text string, lang string, source string")
    [row] = identify(rows, model=fit_text(documents)).collect()
    assert row["language"] is None and not row["kept"]


def test_rare_languages_are_identified(spark):
    """Languages declared by one to three rows of 4,000, in ids that are NULL or repeated and in one long text."""
    rng = np.random.default_rng(2)

    def words(letters):
        return ["".join(rng.choice(list(letters), rng.integers(2, 7))) for _ in range(60)]

    first, second, third, fourth, fifth = map(words, ("abcde", "fghij", "klmno", "pqrst", "uvwxy"))
    common = [first, second]
    rows = [(k, " ".join(rng.choice(common[k % 2], 30)), ["aa", "bb"][k % 2], "s") for k in range(4000)]
    rows += [(5000 + k, " ".join(rng.choice(third, 30)), "cc", "s") for k in range(3)]
    rows += [(None, " ".join(rng.choice(fourth, 30)), "dd", "s"), (6000, " ".join(rng.choice(fifth, 300_000)), "ee", "s")]
    rows += [(8007, "123 ...", "ff", "s"), (8008, None, "gg", "s"), (8009, "abc abd", "", "s")]
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 8)) for _ in range(60)]
    rows += [(7000 + k, " ".join(junk), "aa", "s") for k in range(2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    assert fit_text(frame).languages == ["aa", "bb", "cc", "dd", "ee"]
    got = {r["doc_id"]: r for r in identify(frame).collect()}
    wanted = {5000: "cc", 5001: "cc", 5002: "cc", None: "dd", 6000: "ee", 8007: None, 8008: None, 7000: None, 7001: None}
    wanted |= {k: ["aa", "bb"][k % 2] for k in range(4000)}
    assert {k: got[k]["language"] for k in wanted} == wanted
    assert all(got[k]["kept"] == (v is not None) for k, v in wanted.items())


def test_each_language_has_a_part_of_a_small_sample(spark):
    rows = [(k, f"{chr(97 + k % 12)}bc " * 50, f"l{k % 12:02}", "s") for k in range(120)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    model = fit_text(frame, max_bytes=200)
    assert len(model.languages) == 12 and (model.table.max(1) > model.table.min(1)).all()


def test_evidence_settles_what_text_leaves_open(spark):
    """Two languages with equal tables: declaration, host and suffix decide."""
    table = np.log(np.full((2, 1 << 16), 1 / (1 << 15), np.float32))
    table[0, letter_trigrams(*utf8(pa.array(["aaa bbb"])))[0]] += 2
    table[1, letter_trigrams(*utf8(pa.array(["ccc ddd"])))[0]] += 2
    model = TextModel(["x", "y"], table, 40.0)
    clear = [(k, "aaa bbb " * 9, "x", "www.one.xx") for k in range(40)]
    clear += [(100 + k, "ccc ddd " * 9, "y", "www.two.yy") for k in range(40)]
    unclear = [(900, "zzz", None, "www.one.xx"), (901, "zzz", None, "www.two.yy"), (902, "zzz", "y", "new"), (903, "zzz", "x", "new")]
    unclear += [(904, "zzz", None, "other.xx"), (905, "zzz", None, "other.yy")]
    frame = spark.createDataFrame(clear + unclear, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r["language"] for r in identify(frame, model=model).collect()}
    assert [got[k] for k in range(900, 906)] == ["x", "y", "y", "x", "x", "y"]


def test_pages_by_markup_and_address(spark, sf_dir):
    """The operator on web pages, with the declared language of the markup and the host of the address."""
    from clustertrace.llm.html_text import main_text
    from clustertrace.llm.url_filter import url_host

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    declared = pages.select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))
    rows = main_text(pages).join(declared, "page_id").withColumn("source", url_host(F.col("url")))
    got = identify(rows, "page_id").join(declared, "page_id").collect()
    assert len(got) == pages.count() and np.mean([r["language"] == r["lang"] for r in got]) > 0.95


def test_whole_documents(spark, sf_dir, documents):
    rows = op2_language_id(spark, sf_dir).collect()
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert {r["doc_id"]: r["language"] for r in rows} == truth


def test_spellings_of_a_declaration_are_one_language(spark, documents):
    """English as en, en-US and EN, then in sixty spellings: clean English rows stay English."""
    for spelling in (["en", "en-US", "EN"], [f"en-{k}" for k in range(40)] + [f" En_{k}" for k in range(20)]):
        names = F.array(*map(F.lit, spelling))
        said = F.when(F.col("lang") == "en", names[(F.col("doc_id") % len(spelling)).cast("int")]).otherwise(F.col("lang"))
        rows = documents.withColumn("truth", F.col("lang")).withColumn("lang", said)
        model = fit_text(rows)
        assert model.languages == ["de", "en", "es", "fr"]
        got = identify(rows, model=model).join(documents.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
        assert np.mean([r["language"] == r["truth"] and r["kept"] for r in got]) > 0.97


def test_thousands_of_made_up_declarations_are_merged(spark, documents):
    """Every declaration is junk but some: the languages are found all the same, and rows stay narrow."""
    copies = documents.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(29))))
    junk = F.concat(F.lit("x"), F.conv(F.crc32(F.concat("doc_id", F.lit(" "), "k").cast("binary")).cast("string"), 10, 36))
    rows = copies.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("k") > 5, junk).otherwise(F.col("lang")))
    assert rows.select("lang").distinct().count() > 4000
    model = fit_text(rows)
    assert {"de", "en", "es", "fr"} <= set(model.languages) and len(model.languages) <= 8
    got = identify(rows.withColumn("doc_id", F.col("doc_id") * 30 + F.col("k")), model=model).collect()
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    assert np.mean([r["language"] == truth[r["doc_id"] // 30] for r in got]) > 0.97
