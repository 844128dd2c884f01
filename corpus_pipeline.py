"""The corpus pipeline: stages over documents, each written and read again before the next.

Every stage takes what its predecessor kept and returns rows with the columns of documents; the
last returns ids. Rows that repeat (same id and text) are one document throughout. A stage works
by the id and the text's hash, so ids that are null or not unique are no matter.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import byte_bpe, decontaminate, language, line_dedup, near_dups
from tidegate.llm.store import storage, unused
from tidegate.session import new_folder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear: texts without a letter and ambiguous ones go.

    The classifier learns from all rows that name a language; the language itself is no input of a
    verdict and is left as it stands.
    """
    identify = language.predictor(language.fit(docs.select("lang", "text")))
    (found,) = unused(docs, "found")
    judged = docs.withColumn(found, identify("text"))
    clear = (F.col(f"{found}.lang_pred") != language.UNKNOWN) & ~F.col(f"{found}.ambiguous")
    return judged.where(clear).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; documents that were copies as a whole go. ``n_chars`` follows the text."""
    reports = n_lines, n_deleted, kept = tuple(unused(docs, "n_lines", "n_deleted", "kept"))
    found = line_dedup.dedup_lines(docs, storage(docs, "lines"), reports=reports).where(F.col(kept))
    if "n_chars" in docs.columns:
        length = F.when(F.col(n_deleted) > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    store = storage(docs, "near")
    return near_dups.keep_one(docs, store(near_dups.find_classes(docs.select("doc_id", "text"), store), "classes"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    store = storage(docs, "leaks")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = store(decontaminate.find_leaks(docs.select("doc_id", "text"), benchmark, store), "leaks")
    return decontaminate.remove_leaks(docs, leaks)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left, digested, and whether they decode to the text again."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    coded = byte_bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", languages),
    ("line_dedup", lines),
    ("near_dups", near_duplicates),
    ("decontaminate", benchmark_leaks),
    ("byte_bpe", tokens),
]

#: SQL cannot express the learned classifier, the similarity classes or the ids: the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
