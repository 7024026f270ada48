"""A training-corpus pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)`` and returns all its predecessor kept, but for what it decides to drop or
change; the last returns token ids with their digests. Stages work on rows, so null or equal ids are fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import bpe, decontam, langid, pii, simhash
from casebook.llm.common import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model learned from ``lang`` doesn't know, or without a letter, go."""
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group stays."""
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in the benchmark go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced under the session's key, or one of this application; ``n_chars`` follows the text."""
    found = "found" + "_" * max(map(len, docs.columns))
    out = pii.pseudonymize(docs, found_col=found, key=pii.query_key(spark)).drop(found)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of the bytes that they decode to."""
    return bpe.digests(docs, "ids")


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pseudonyms), ("bpe", tokens)]
#: No SQL form: the language model, the fingerprints' components and the tokenizer are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
