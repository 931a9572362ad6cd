"""The operators of this subpackage as queries over the given tables, and the SQL they must agree with."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.llm import op01_simhash, op02_topk, op03_quality_rules, op04_lines, op05_bpe, op06_quality_cnn, op07_secrets, op08_passages, op09_chat, op10_packing, op11_url_filters, op13_conversations
from sitewright.llm import op12_ranked_search as ranked_search
from sitewright.llm.common import table

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return op02_topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_quality_rules.judged(table(spark, sf_dir, "documents"))


@query
def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_lines.line_report(table(spark, sf_dir, "documents"))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return op05_bpe.encoded_digests(table(spark, sf_dir, "documents"), ranks)


@query
def op6_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_quality_cnn.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_secrets.scan(table(spark, sf_dir, "documents"))


@query
def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_passages.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return op09_chat.digests(op09_chat.formatted(turns, ranks))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return op10_packing.pack(table(spark, sf_dir, "documents"), path)


@query
def op11_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return op11_url_filters.judged(pages, op11_url_filters.RULES, op11_url_filters.page_outcomes(pages))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_conversations.report(op13_conversations.damaged(table(spark, sf_dir, "conversations")))


ORACLE = {
    "op2_vector_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        ) WHERE rank <= 5
    """,
    "op3_quality_rules": op03_quality_rules.oracle(),
    "op11_url_reputation": op11_url_filters.oracle(),
    "op12_ranked_search": ranked_search.oracle(),
    "op13_conversation_repair": op13_conversations.oracle(),
}
