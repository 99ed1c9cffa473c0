"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import materialize

__all__ = ["any_names", "SPACE", "WORD", "checkpointed", "documents", "prepare", "table", "task_count"]

# The white space between words, and a word, as regular expressions of Java and Python.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows and bytes of one Arrow batch. Very long texts must not add up to a batch that a Python worker can't hold.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches of the session. The one session setting that the operators change; every query
    calls it first."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def checkpointed(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` into the shared folder (``spark.checkpoint.dir``) and reads it back: cuts the lineage, and
    survives lost executors."""
    return materialize(df, f"llm-{label}")


def any_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Operators name their own columns with two leading underscores. Columns of the input that begin so, in any case, have another name
    while the operator runs, also where they are its arguments. Other inputs go through as they are."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **settings) -> DataFrame:
        own = {c: f"kept{i} {c.lstrip('_')}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        if not own:
            return operator(docs, *args, **settings)
        now = lambda x: own.get(x, x) if isinstance(x, str) else x
        out = operator(docs.withColumnsRenamed(own), *map(now, args), **{k: now(v) for k, v in settings.items()})
        return out.withColumnsRenamed({v: k for k, v in own.items()})

    return run


def task_count(spark: SparkSession, rows: int, rows_a_task: int) -> int:
    """Tasks so that none gets more than ``rows_a_task`` rows, and no fewer than the shuffle setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_task))


def ascii_lower(text) -> "F.Column":
    """A-Z only: other letters keep their case."""
    return F.translate(text, UPPER, LOWER)
