"""Readers for raw logs, metadata caches, audit logs and feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.sources import schemas


def read_raw(spark: SparkSession, directory: str, pattern: str = "Streaming_History_Audio_*.json") -> DataFrame:
    """All matching JSON-array files below ``directory``. Listing and reading are Spark's; a folder
    without a match is an error."""
    df = (
        spark.read.schema(schemas.RAW_PLAYS)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .json(directory)
    )
    if df.isEmpty():
        raise FileNotFoundError(f"no {pattern} below {directory}")
    return df


def read_table(spark: SparkSession, *names: str) -> DataFrame:
    """The first of the named catalog tables that exists."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    raise LookupError(f"none of {names} exists")


def common_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def filtered_history(df: DataFrame, ts: str, min_year: int, before: str, year: str | None = None) -> DataFrame:
    """Rows from ``min_year`` on and before a cut. Plain range predicates, so they reach the scan. ``year``: the column by whose values
    the table is laid out, the year of ``ts``; the same range as years leaves the other folders unread. A row without a time is in
    neither range."""
    rows = df.where((F.col(ts) >= F.lit(f"{min_year}-01-01").cast("timestamp_ntz")) & (F.col(ts) < F.lit(before).cast("timestamp_ntz")))
    return rows if year is None else rows.where((F.col(year) >= min_year) & (F.col(year) <= int(before[:4])))


# --- generations of one table ---------------------------------------------------------------------
#: Kinds that hold all values of those before them.
_WIDER = ([T.ByteType, T.ShortType, T.IntegerType, T.LongType], [T.FloatType, T.DoubleType], [T.ByteType, T.ShortType, T.IntegerType, T.DoubleType], [T.DateType, T.TimestampNTZType])


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The kind that holds the values of both; a ValueError if none does."""
    if a == b:
        return a
    for kinds in _WIDER:
        if type(a) in kinds and type(b) in kinds:
            return max(a, b, key=lambda k: kinds.index(type(k)))
    raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common kind")


def read_generations(spark: SparkSession, *paths: str) -> DataFrame:
    """One table from Parquet folders written at different times, oldest first: later ones may have more, fewer or wider columns. Columns
    stand in the order in which they first appear and are null where a generation lacks them. One schema is read from each
    folder, and all files in a single scan."""
    merged: dict[str, T.StructField] = {}
    for path in paths:
        for f in spark.read.parquet(path).schema:
            known = merged.get(f.name.lower())
            merged[f.name.lower()] = T.StructField(f.name if known is None else known.name, f.dataType if known is None else wider(known.dataType, f.dataType))
    return spark.read.schema(T.StructType(list(merged.values()))).parquet(*paths)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_audit(spark: SparkSession, path: str, resolved_only: bool = True) -> DataFrame:
    """JSON Lines audit log; blank and broken lines are dropped. Resolved means status RESOLVED or a
    known outcome."""
    df = spark.read.schema(schemas.AUDIT).option("mode", "DROPMALFORMED").json(path)
    if not resolved_only:
        return df
    return df.where((F.col("status") == "RESOLVED") | F.col("actual_skipped").isNotNull())


def read_live_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_meta_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Metadata cache written as records, one JSON array per file or one record per line; unreadable
    records are dropped."""
    return spark.read.schema(schemas.TRACK_META).option("multiLine", multi_line).option("mode", "DROPMALFORMED").json(path)


def meta_from_map(text: DataFrame, column: str = "value") -> DataFrame:
    """Metadata caches written as one object per file keyed ``artist|||song``: one row per entry.
    An unreadable text yields no rows."""
    entry = "map<string, struct<genres: array<string>, listeners: bigint, playcount: bigint>>"
    parsed = text.select(F.explode(F.map_entries(F.from_json(column, entry))).alias("e"))
    key = F.split("e.key", r"\|\|\|", 2)
    return parsed.select(
        key[0].alias("artist_name"),
        key[1].alias("song_name"),
        F.coalesce("e.value.genres", F.array().cast("array<string>")).alias("genres"),
        F.col("e.value.listeners").alias("listeners"),
        F.col("e.value.playcount").alias("playcount"),
    )


def top_tags(raw: DataFrame, column: str, n: int = 5) -> DataFrame:
    """``tags``: the first ``n`` lower-cased names of a tag node that is a list or a single object."""
    one = "struct<name: string>"
    text = F.col(column)
    listed = F.when(text.startswith("["), F.from_json(text, f"array<{one}>"))
    single = F.when(text.startswith("{"), F.array(F.from_json(text, one)))
    nodes = F.coalesce(listed, single, F.array().cast(f"array<{one}>"))
    names = F.transform(F.filter(nodes, lambda x: x["name"].isNotNull()), lambda x: F.lower(x["name"]))
    return raw.withColumn("tags", F.slice(names, 1, n))
