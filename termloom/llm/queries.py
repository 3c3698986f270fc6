"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, dartminhash, embedding_dedup, mixing, pivot_search, quality, token_counts, toxicity, zipwarc

#: The public tokenizer files that the queries use; their paths are parameters of the operators.
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
#: Target shares of the mix: languages by name, six hundredths for all others; sources and topics by their tokens.
TARGETS = {"lang": {"en": 0.4, "de": 0.18, "es": 0.18, "fr": 0.18}}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op2_section_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, rule="most")


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_order(table(spark, sf_dir, "conversations"))


def quoting_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on the same conversations, in which turns quote earlier ones."""
    rows = spark.sql(chat.QUOTING.replace("chr(10)", "char(10)"), conversations=table(spark, sf_dir, "conversations"))
    return chat.reply_order(rows)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op5_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipwarc.round_trip(spark, table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.toxicity(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), BYTE_BPE, targets=TARGETS)


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.quality(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pivot_search, op2_section_token_counts, op3_quotation_linking, op4_bpe_round_trip, op5_zip_warc,
        op6_toxicity, op7_near_duplicates, op8_source_mix, op9_embedding_near_duplicates, op10_quality, quoting_conversations,
    )
}

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
#: The operators that SQL can express; the others are held against plain Python in the tests.
ORACLE_SQL: dict[str, str] = {
    "op1_pivot_search": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 20
""",
    "op3_quotation_linking": chat.ORACLE,
    "quoting_conversations": chat.ORACLE_QUOTING,
    "op5_zip_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
t AS (SELECT *, CASE WHEN strlen(payload) >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS top FROM p)
SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM t
""",
    "op9_embedding_near_duplicates": f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE} AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(least(a, b)) AS m FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.m, vec_id) AS component_id, coalesce(c.m, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
}
