"""Writers: tables, append-once logs, report sections, lookup snapshots."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from playlens.operators.enrich import latest_rates, new_events
from playlens.session import materialize


#: Rows of a table that the Markdown of a report shows.
SHOWN = 1000


def overwrite_table(df: DataFrame, path: str, partition: str | None = "year") -> None:
    """Replace the table at ``path``. Rows stay in the tasks they are in, so a year that holds most rows
    is written by many tasks, and files are bounded in rows."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
    if partition and partition in df.columns:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str], schema: str) -> tuple[int, int]:
    """Append the records whose key the JSON Lines log does not hold yet; (inserted, duplicates).
    The new rows are fixed on disk before they are counted and appended."""
    spark = df.sparkSession
    stored = read_log(spark, path, schema)
    fresh = materialize(new_events(df, stored, keys), "append")
    inserted, total = fresh.count(), df.count()
    if inserted:
        fresh.write.mode("append").json(path)
    return inserted, total - inserted


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The log so far; empty when nothing has been written yet."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def report_sections(sections: dict[str, dict[str, DataFrame]], directory: str, top_n: int | None = None) -> str:
    """Write each table as JSON under its section, and return a Markdown index of them.

    Each table is whole unless ``top_n`` asks for its first rows; a frame that is cut must come sorted. The Markdown is made
    from the written rows, so that both agree; it shows at most ``SHOWN`` rows of a table and says how many there are."""
    lines = ["# Listening report", ""]
    for section, tables in sections.items():
        lines += [f"## {section}", ""]
        for title, df in tables.items():
            path = f"{directory}/{section}/{title}".replace(" ", "_").lower()
            (df if top_n is None else df.limit(top_n)).write.mode("overwrite").json(path)
            written = df.sparkSession.read.schema(df.schema).json(path)
            rows, total = written.limit(SHOWN).collect(), written.count()
            lines += [f"### {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
            lines += ["| " + " | ".join(_cell(v) for v in r) + " |" for r in rows]
            lines += [f"{total} rows" if total > len(rows) else "", ""]
    return "\n".join(lines)


def _cell(v) -> str:
    return json.dumps(v) if isinstance(v, (list, dict)) else str(v)


def lookup_snapshot(features: DataFrame, path: str) -> None:
    """Persist the artist and song rate lookups for scoring jobs."""
    latest_rates(features, "artist_name", "artist_smoothed_skip_rate").write.mode("overwrite").parquet(f"{path}/artist")
    latest_rates(features, "song_name", "song_smoothed_skip_rate").write.mode("overwrite").parquet(f"{path}/song")
