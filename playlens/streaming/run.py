"""Running a streaming frame to the end of the available input with an idempotent file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from playlens.operators.enrich import new_events
from playlens.session import scratch_path

BATCH = "batch_id"
DAY = "day"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a missing day
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, directory: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(directory)


def write_batch(path: str):
    """A micro-batch owns its folder and overwrites it, so a retried batch leaves one copy."""

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return sink


def append_once(path: str, keys: list[str], time: str):
    """Like `write_batch`, and records whose key an earlier batch already stored are left out.

    Files lie by the day of ``time`` (one of the keys), then by batch. A batch lists and reads only the folders of the days that it
    holds itself, so its cost follows the look-back of the polls and neither the age of the table nor its number of batches."""

    def sink(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        fresh = df.dropDuplicates(keys).withColumn(DAY, F.to_date(time))
        days = [r[0] for r in fresh.select(F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))).distinct().collect()]
        stored = existing(spark, [f"{path}/{DAY}={d}" for d in days])
        if stored:
            kept = spark.read.schema(StructType([*df.schema, StructField(DAY, DateType()), StructField(BATCH, LongType())])).option("basePath", path).parquet(*stored)
            fresh = new_events(fresh, kept.where(F.col(BATCH) != batch_id), keys)
        # only the batch's own folders are replaced
        rows = fresh.withColumn(BATCH, F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(path)

    return sink


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = [(p, jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, x in at if x.getFileSystem(conf).exists(x)]


def state_partitions(spark: SparkSession) -> int:
    """Every state partition is an open store. Twice the cores keeps all of them busy; a session that asks
    for fewer shuffle partitions, or sets ``playlens.stream.partitions``, decides itself."""
    wanted = spark.conf.get("playlens.stream.partitions", None)
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return int(wanted) if wanted else min(shuffle, 2 * spark.sparkContext.defaultParallelism)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", sink=None) -> StreamingQuery:
    """Process everything that is there now, then stop. State lives in RocksDB on the executors' disks, with its changes under
    ``checkpoint``: it need not fit in memory."""
    spark = stream.sparkSession
    own = {"spark.sql.shuffle.partitions": str(state_partitions(spark)), "spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:  # a started query keeps its own copy of the settings
        query = (
            stream.writeStream.outputMode(mode)
            .foreachBatch(sink or write_batch(path))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return query


def collect_stream(stream: DataFrame, label: str, mode: str = "append", sink_keys: list[str] | None = None, time: str | None = None) -> DataFrame:
    """Drain into the scratch folder and return what was written, with the batch id of every row."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    sink = append_once(path, sink_keys, time) if sink_keys else None
    drain(stream, path, checkpoint, mode, sink)
    return spark.read.schema(StructType([*stream.schema.fields, StructField(BATCH, IntegerType())])).parquet(path)


def last_batch(written: DataFrame) -> DataFrame:
    """The newest full result of a complete-mode query."""
    newest = written.agg(F.max(BATCH)).scalar()
    return written.where(F.col(BATCH) == newest).drop(BATCH)
