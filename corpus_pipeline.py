"""Pipeline over ``documents``: language, near duplicates, repeated passages, mixing, token ids.

Every stage takes (spark, docs, sf_dir), reads all of ``docs`` and returns a frame; all but the
last return the columns of ``documents``. Each result is written and read again before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.llm.bpe import round_trip
from registry_spark.llm.language import recognised, train
from registry_spark.llm.mixing import mixed_documents
from registry_spark.llm.near_duplicates import one_of_each
from registry_spark.llm.queries import BYTE_BPE
from registry_spark.llm.repeats import Repeats
from registry_spark.llm.tasks import id_remainder
from registry_spark.sources.shared import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; the model learns from three quarters of them."""
    model = train(docs.filter(id_remainder(F.col("doc_id"), 4) != 2))
    return recognised(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return one_of_each(docs, words=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes met more than once; documents left without a word go."""
    rest = [c for c in docs.columns if c != "text"]
    numbered = [f"__r{i}" for i in range(len(rest))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, numbered)], F.col("text").alias("__text"))
    left = Repeats(renamed, text="__text", length=200, keep=numbered).result(with_text=True)
    columns = {c: F.col(n) for c, n in zip(rest, numbered)} | {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return left.filter(F.col("left").rlike(r"[^\x20\x09-\x0D]")).select(*[columns[c].alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text of every document of the mix."""
    return round_trip(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mixing", mixing), ("tokens", tokens),
]

# Trained models, sketches and byte-level merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
