"""Corpus cleaning and packing: five stages from documents to training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyspark.llm import near, packing, quality, spans, toxicity
from tallyspark.llm.common import park
from tallyspark.llm.queries import CAPACITY, END, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below one half of the toxicity score; the model learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = toxicity.score(docs.select(row, F.col("text")), toxicity.train(docs, labels))
    return scored.where("score < 0.5").select("row.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; ``n_chars`` follows the text. Documents of which
    nothing is left go; those that held nothing before stay."""
    left = spans.dedup(docs, drop_emptied=True)
    if "n_chars" in left.columns:
        left = left.withColumn("n_chars", F.length("text").cast(left.schema["n_chars"].dataType)).select(*docs.columns)
    return left


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, CAPACITY, END)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_spans),
    ("packing", pack_sequences),
]

#: A trained model, sketches and a tokenizer have no SQL twin; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
