"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.llm import bytebpe, chat, chunks, decontaminate, hardnegatives, language, secrets, sentencepiece, simhash, spelling, topk, toxicity, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").withColumn("held_out", language.held_out("doc_id", 4, 2))
    profiles = language.learn(docs.where("not held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), topk.scaled(F.col("embedding")).alias("v"))
    return topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").where(~language.held_out("doc_id", 3, 1))
    scored = toxicity.score(docs, labels.select("doc_id", F.col("toxic").alias("y")))
    return scored.select(
        "doc_id", language.held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence"
    )


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(_table(spark, folder, "pages"))


#: The vocabulary of the query; the operator takes any path.
SENTENCEPIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encoded(_table(spark, folder, "documents"), SENTENCEPIECE_MODEL)


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    marked = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", marked), (-1, 1, "assistant", marked)], rows.schema)
    rows = rows.union(own).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.formatted_turns(rows))


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeated_passages(_table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


def op11_hardnegatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").select("vec_id", moved.alias("label"), hardnegatives.scaled(F.col("embedding")).alias("v"))
    return hardnegatives.mine(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.words(_table(spark, folder, "documents")))


def op13_bytebpe(spark: SparkSession, folder: str) -> DataFrame:
    return bytebpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_topk": op3_topk,
    "op4_decontaminate": op4_decontaminate,
    "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_chat": op8_chat,
    "op9_passages": op9_passages,
    "op10_secrets": op10_secrets,
    "op11_hardnegatives": op11_hardnegatives,
    "op12_spelling": op12_spelling,
    "op13_bytebpe": op13_bytebpe,
}
ORACLE: dict[str, str] = {
    "op3_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
        WHERE r <= 10
    """,
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
            f AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
            CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first < page_id THEN first END AS refers_to, true AS intact
        FROM p LEFT JOIN f USING (h)
    """,
    "op8_chat": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)
        ), c AS (
            SELECT *, len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\]|</?SYS>>)')) AS escapes FROM r
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('<|turn|><|body|><|end|>') + length(role) + length(text) + escapes)::BIGINT AS formatted_chars,
            0::BIGINT AS attachment_tokens
        FROM c GROUP BY conv_id
    """,
    "op11_hardnegatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id
            WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
            s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
        QUALIFY rank <= 5
    """,
    "op12_spelling": r"""
        WITH RECURSIVE codes AS (
            SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) AS r(i)
        ), found AS (
            SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
        ), seen AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM found GROUP BY ALL
        ), hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(
                list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'), lambda b: CAST('0x' || b AS BIGINT)),
                lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS BIGINT) + 1]), 4294967295)) AS h
            FROM seen, codes
        ), lost AS (
            SELECT n, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
            FROM hashed
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM lost WHERE length(word) >= 6 GROUP BY word HAVING sum(lost.n) >= 5
        ), cut AS (
            SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)
        ), near AS (
            SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
            UNION SELECT x.word, x.n, y.word, y.n FROM cut x JOIN words y ON x.a || x.b = y.word
            UNION SELECT y.word, y.n, x.word, x.n FROM cut x JOIN words y ON x.a || x.b = y.word
        ), best AS (
            SELECT word, count(*) AS n_near, min({'least': -near_n, 'near': near}) AS best FROM near GROUP BY word
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.least >= 5 * n THEN best.near END AS form,
                CASE WHEN -best.least >= 5 * n THEN -best.least END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), followed AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT f.word, g.form FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL
        ), roots AS (
            SELECT f.word, f.root FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """,
}
