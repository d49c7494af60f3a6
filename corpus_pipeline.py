"""Corpus pipeline: five filters and the encoder, each one of the training-data operators.

Every stage takes what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``. Stages don't look at
``sf_dir`` but for the benchmark table.

Stages that hand whole texts to Python do so ``ARROW_ROWS`` rows at a time. They store what
they return, as the session's setting counts when a frame is run, not when it is made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abode.llm import bpe, decontam, exactdup, langid, neardup
from abode.llm.queries import tokenizer_path
from abode.llm.tables import few_arrow_rows, forget, stored

ARROW_ROWS = 1000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Profiles learned from the labelled rows that aren't held out; texts without a letter, and only those, go."""
    with few_arrow_rows(spark, ARROW_ROWS):
        profiles = langid.Profiles(langid.train(docs.where(~langid.held_out())))
        return stored(langid.drop_unknown(docs, profiles), "language")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the smallest identifier stays."""
    return exactdup.drop_exact_copies(docs, keep="min")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest identifier."""
    return neardup.drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, within its edit budget, go."""
    with few_arrow_rows(spark, ARROW_ROWS):
        return stored(decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "benchmark_leaks")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text.

    The ids are stored first, so that no task has a Python worker that encodes and one that decodes.
    """
    path = tokenizer_path()
    with few_arrow_rows(spark, ARROW_ROWS):
        ids = stored(bpe.encode_texts(docs, path, digest=True), "ids")
        report = stored(bpe.token_report(ids, path).select("doc_id", "n_tokens", "ids_sha256", "round_trip"), "tokens")
    forget(ids)
    return report


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("tokens", tokens),
]

#: Language profiles, edit distances and the encoder have no SQL; tests hold the rows against plain Python.
ORACLE_SQL = None

STORED = {"language", "benchmark_leaks"}  # what these return is in the shared folder already


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what stands between them is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        docs = out if name in STORED else stored(out, name)
    return STAGES[-1][1](spark, docs, sf_dir)
