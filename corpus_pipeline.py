"""The corpus pipeline: documents to token ids, each stage written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm import bpe, lines, mixing, simhash, toxicity
from playlens.llm.common import checkpointed, documents, prepare, table
from playlens.llm.queries import quality_domains, vocabulary_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go. Labels of documents that aren't here don't count."""
    prepare(spark)
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), evidence=None)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least three documents hold stay in one of them; ``n_chars`` follows the text. No document goes."""
    prepare(spark)
    out = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, by fingerprints of 4-word shingles at most 4 bits apart."""
    prepare(spark)
    return simhash.keep_one(docs).select(*docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say: a domain below its target weight is repeated. The budget thins no domain as a whole."""
    prepare(spark)
    return mixing.resample(mixing.mix(docs, quality_domains(spark, sf_dir)), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and as ``text`` what the ids decode to."""
    prepare(spark)
    out = bpe.encode_documents(docs, vocabulary_path())
    return out.select(*[F.col("decoded").alias("text") if c == "text" else c for c in docs.columns], "n_tokens", "ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("mixing", mix_domains),
    ("bpe", encode),
]

#: SQL can't express the stages: nearest examples, fingerprints, fitted rates, an encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
