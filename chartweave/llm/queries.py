"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from .ann_forest import nearest
from .common import table
from .conversation_query import op13_turn_repair
from .decontaminate import match_items
from .minhash import near_duplicates
from .mixing_query import OP8_SQL, op8_mix_sources
from .run_index import cut_earlier_bytes
from .runs_query import op12_periodic_runs
from .seed_extend import cut_repeated_words
from .secrets import find_secrets
from .token_counts import count_tokens
from .toxicity import held_out, learn_lexicon, score_toxicity
from .url_query import OP11_SQL, op11_url_rules
from .wrappers import extract_text

TOXIC_FROM = 0.3
TOKEN_LIMIT = 512


def op1_run_index(spark: SparkSession, folder: str) -> DataFrame:
    cut = cut_earlier_bytes(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random"
    )


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=3, similarity=(85, 100))


def op4_hash_forest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_page_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = match_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated"
    )


def op7_seed_extend(spark: SparkSession, folder: str) -> DataFrame:
    cut = cut_repeated_words(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lexicon = learn_lexicon(docs, table(spark, folder, "labels").where(~held_out()))
    return score_toxicity(docs, lexicon).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES = {
    query.__name__: query
    for query in (
        op1_run_index,
        op2_secret_scan,
        op3_minhash,
        op4_hash_forest,
        op5_page_wrappers,
        op6_decontaminate,
        op7_seed_extend,
        op8_mix_sources,
        op9_toxicity,
        op10_token_counts,
        op11_url_rules,
        op12_periodic_runs,
        op13_turn_repair,
    )
}
SQL = {"op8_mix_sources": OP8_SQL, "op11_url_rules": OP11_SQL}
