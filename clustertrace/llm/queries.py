"""The registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clustertrace.llm.bpe import encode_decode
from clustertrace.llm.collocations import collocations
from clustertrace.llm.embedding_dedup import near_duplicates
from clustertrace.llm.exact_dedup import exact_duplicates
from clustertrace.llm.fingerprint import edit_resistance
from clustertrace.llm.html_text import main_text
from clustertrace.llm.language_id import identify
from clustertrace.llm.ngram_join import similar_documents
from clustertrace.llm.packing import pack
from clustertrace.llm.shared import new_path
from clustertrace.llm.spelling import letter_runs, spelling_variants
from clustertrace.llm.toxicity import fit, held_out, score
from clustertrace.llm.url_filter import judge_urls
from clustertrace.llm.warc import read_archives, write_archives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed by the query's contract.
URL_RULES = """
    SELECT * FROM VALUES
        ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow') AS rules (host, path, verdict)
"""


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "duplicate.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns, F.crc32("ids").alias("ids_crc32"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, spark.sql(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder)
    read = read_archives(folder, spark)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = letter_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    runs = runs.withColumn("h", h).withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    # The contract takes a letter out of some runs.
    less = F.expr("concat(substring(run, 1, at), substring(run, at + 2))")
    return spelling_variants(runs.select(F.when(F.col("h") % 199 == 0, less).otherwise(F.col("run")).alias("word")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_resistance(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_language_id": op2_language_id,
    "op3_packing": op3_packing,
    "op4_url_filter": op4_url_filter,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_ngram_join": op7_ngram_join,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_warc": op9_warc,
    "op10_html_text": op10_html_text,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_fingerprint": op13_fingerprint,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op4_url_filter": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                                 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), rules (rule_host, rule_path, rule_verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), ranked AS (
            SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict,
                   row_number() OVER (PARTITION BY page_id
                                      ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS k
            FROM parts LEFT JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM ranked WHERE k = 1
    """,
    "op7_ngram_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), runs AS (
            SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) AS i FROM split
        ), members AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM runs
        ), sets AS MATERIALIZED (
            SELECT doc_id, list(shingle ORDER BY shingle) AS shingles FROM members GROUP BY doc_id
        ), nodes AS MATERIALIZED (
            SELECT shingles, min(doc_id) AS node, len(shingles) AS size FROM sets GROUP BY shingles
        ), spread AS MATERIALIZED (
            SELECT node, size, unnest(shingles) AS shingle FROM nodes
        ), links AS MATERIALIZED (
            SELECT x.node AS a, y.node AS b FROM spread x JOIN spread y ON x.shingle = y.shingle AND x.node <> y.node
            GROUP BY x.node, x.size, y.node, y.size HAVING 100 * count(*) >= 75 * (x.size + y.size - count(*))
        ), reached AS (
            SELECT node, node AS far FROM nodes
            UNION
            SELECT reached.node, b FROM reached JOIN links ON a = far
        ), least_of AS (
            SELECT node, min(far) AS component_id FROM reached GROUP BY node
        )
        SELECT split.doc_id, coalesce(size, 0)::BIGINT AS n_shingles, coalesce(component_id, split.doc_id) AS component_id
        FROM split LEFT JOIN sets USING (doc_id) LEFT JOIN nodes USING (shingles) LEFT JOIN least_of USING (node)
    """,
    "op8_embedding_dedup": """
        WITH RECURSIVE usable AS MATERIALIZED (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS MATERIALIZED (
            SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
            WHERE list_cosine_similarity(x.v, y.v) >= 0.95
        ), reached AS (
            SELECT vec_id, vec_id AS far FROM embeddings
            UNION
            SELECT vec_id, b FROM reached JOIN links ON a = far
        ), least_of AS (
            SELECT vec_id, min(far) AS component_id FROM reached GROUP BY vec_id
        ), counted AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN least_of USING (vec_id) LEFT JOIN counted USING (vec_id)
    """,
    "op9_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
        ), coded AS (
            -- Five hexadecimal digits are four letters of base 32.
            SELECT page_id, payload, array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       (('0x' || substr(hex, (k // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - k % 4 * 5)::INTEGER) % 32 + 1, 1)), '') AS payload_digest
            FROM payloads
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM coded
        )
        SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op11_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(v ORDER BY b) AS t
            FROM (SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS v
                  FROM range(256) AS bytes (b))
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) AS run FROM documents)
            GROUP BY ALL
        ), coded AS (
            SELECT run, k, flatten(list_transform(string_split(id || ':' || run, ''),
                lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes
            FROM runs
        ), hashed AS (
            SELECT run, k, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) AS h
            FROM coded, crc_table
        ), words AS MATERIALIZED (
            SELECT word, sum(k)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
        ), holes AS (
            SELECT word, n, substr(word, 1, i) AS before, substr(word, i + 2) AS behind
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
        ), near AS (
            SELECT DISTINCT x.word AS word, y.word AS near, y.n AS n FROM holes x JOIN holes y USING (before, behind) WHERE x.word <> y.word
            UNION
            SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.before || h.behind
            UNION
            SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.before || h.behind
        ), best AS (
            SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS form, max(n) AS form_n FROM near GROUP BY word
        ), formed AS (
            SELECT word, CASE WHEN form_n >= 5 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), chain AS (
            SELECT word, word AS step FROM formed
            UNION ALL
            SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.step WHERE formed.form IS NOT NULL
        )
        SELECT formed.word, form, step AS root, n, n_near, form_n
        FROM formed JOIN (SELECT chain.word, step FROM chain JOIN formed ON formed.word = step WHERE formed.form IS NULL) USING (word)
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), places AS (
            SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split
        ), sized AS (
            SELECT lang, words, i, unnest(range(1, 6)) AS k FROM places
        ), f AS MATERIALIZED (
            SELECT lang, words[i:i + k - 1] AS phrase, count(*) AS f FROM sized WHERE i + k - 1 <= len(words)
            GROUP BY ALL HAVING count(*) >= 100
        ), n AS (
            SELECT lang, count(*) AS n FROM places GROUP BY lang
        ), cuts AS (
            SELECT lang, phrase, f AS a, unnest(range(1, len(phrase))) AS k FROM f WHERE len(phrase) > 1
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts JOIN n ON n.lang = cuts.lang
            JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.phrase[1:k]
            JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.phrase[k + 1:]
        ), weakest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), spans AS (
            SELECT lang, phrase, f, unnest(range(1, len(phrase))) AS i FROM f WHERE len(phrase) > 2
        ), inner_phrases AS (
            SELECT lang, phrase, f, i, unnest(range(i + 1, len(phrase) + 1)) AS j FROM spans
        ), covers AS (
            SELECT lang, phrase[i:j] AS phrase, max(f) AS cover FROM inner_phrases WHERE j - i + 1 < len(phrase) GROUP BY ALL
        ), kept AS (
            SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score
            FROM weakest LEFT JOIN covers USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 100 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM kept QUALIFY rank <= 2000
    """,
}
