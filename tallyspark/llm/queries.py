"""One registered query for each operator, over its whole table, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, fingerprint, lexical, lm, near, packing, preference, quality, sharding, spans, tokenbin, toxicity, trie
from .common import held_out
from .twins import ORACLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
END, CAPACITY, SHARDS = 2, 1024, 40


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_lm_scores(spark, sf_dir):
    docs, out = documents(spark, sf_dir), held_out("doc_id", 7, 2)
    scored = lm.score(docs, ~out)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op2_quality_rules(spark, sf_dir):
    judged = quality.judge(documents(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(
        "doc_id", *[F.col(f"q_{c}").alias(c) for c in counts], F.col("q_kept").alias("kept")
    )


@query
def op3_near_dedup(spark, sf_dir):
    return near.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


@query
def op4_bpe(spark, sf_dir):
    return bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


@query
def op5_token_files(spark, sf_dir):
    blocks, _ = tokenbin.write(documents(spark, sf_dir), TOKENIZER, end_id=END)
    return tokenbin.read(blocks)


@query
def op6_toxicity(spark, sf_dir):
    docs, out = documents(spark, sf_dir), held_out("doc_id", 5, 0)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~out)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op7_substring_dedup(spark, sf_dir):
    cleaned = spans.dedup(documents(spark, sf_dir), report=True)
    return cleaned.select("doc_id", "n_sentences", "n_removed", "words_removed", "text")


@query
def op8_fingerprints(spark, sf_dir):
    return fingerprint.neighbours(documents(spark, sf_dir))


@query
def op9_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), TOKENIZER, CAPACITY, END)


@query
def op10_sharding(spark, sf_dir):
    placed = sharding.shard(documents(spark, sf_dir), SHARDS)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op11_quality_classifier(spark, sf_dir):
    docs, out = documents(spark, sf_dir), held_out("doc_id", 4, 2)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~out)
    model = preference.train(docs, labels, cut=0.7)
    scored = preference.score(docs, model)
    return scored.select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted")
    )


@query
def op12_conversation_trie(spark, sf_dir):
    turns = trie.ranked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie.nodes(*trie.shared_heads(turns))


@query
def op13_lexical_search(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.search(documents(spark, sf_dir), items, k=20)
