"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    hard_negatives,
    i_match,
    language_id,
    mixing,
    pii,
    prefix_trie,
    secret_scan,
    simhash,
    substrings,
    token_count,
    url_filter,
    vector_search,
)
from .common import table

#: Vocabulary file of the token counts.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = build
        return build

    return register


@query("op1_language_id")
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.train(docs.filter("doc_id is not null").filter(~language_id.held_out()))
    return language_id.identify(docs, model)


@query("op2_simhash")
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op3_pii")
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.find_pii(docs, pii.train(docs))
    count = {f"n_{kind}": F.size(F.filter("base", lambda s: s.kind == kind)).cast("long") for kind in pii.KINDS}
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
    )


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents"))
    count = {
        f"n_{kind}": F.size(secret_scan.of_kind(F.col("base"), kind)).cast("long")
        for kind in ("assign", "access", "hex")
    }
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(secret_scan.digest(F.col("base")), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


@query("op6_mixing")
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op7_url_filter")
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = {"block": list(url_filter.BLOCK_RULES), "allow": list(url_filter.ALLOW_RULES)}
    return url_filter.judge(table(spark, folder, "pages"), rules)


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_vector_search")
def op9_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    found = vector_search.top_k(vectors, F.col("vec_id") % 100 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


@query("op10_token_count")
def op10_token_count(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.count_tokens(table(spark, folder, "documents"), token_count.read_vocabulary(VOCABULARY))


@query("op11_i_match")
def op11_i_match(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return i_match.compare_in_order(docs, i_match.learn_lexicon(docs))


@query("op12_hard_negatives")
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op13_prefix_trie")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
