"""Which files and folders reads touch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.session import scratch_path
from playlens.sources import readers, sinks
from playlens.streaming import run


def test_only_the_years_asked_for_are_read(spark):
    path = scratch_path(spark, "years")
    rows = [(i, dt.datetime(1995 + i % 8, 6, 1)) for i in range(80)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz").withColumn("year", F.year("at"))
    sinks.overwrite_table(df, path)
    out = readers.filtered_history(spark.read.parquet(path), "at", 1997, "1999-03-01", "year")
    assert sorted({r.year for r in out.collect()}) == [1997, 1998]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(at)" in plan
    files = {f.split("year=")[1][:4] for f in readers.filtered_history(spark.read.parquet(path), "at", 1997, "1999-03-01", "year").select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {"1997", "1998"}


def test_generations_with_missing_and_wider_columns(spark):
    path = scratch_path(spark, "generations")
    spark.createDataFrame([(1, 1.5)], "id int, x float").write.parquet(f"{path}/0")
    spark.createDataFrame([(2, "b")], "ID int, name string").write.parquet(f"{path}/1")
    spark.createDataFrame([(1 << 40, 2.25, "c")], "id long, x double, name string").write.parquet(f"{path}/2")
    out = readers.read_generations(spark, *[f"{path}/{i}" for i in range(3)])
    assert out.schema.simpleString() == "struct<id:bigint,x:double,name:string>"
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.5, None), (2, None, "b"), (1 << 40, 2.25, "c")]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(ValueError, match="string and bigint"):
        readers.wider(T.StringType(), T.LongType())


def test_a_batch_reads_only_its_own_days(spark, monkeypatch):
    path = scratch_path(spark, "once")
    sink = run.append_once(path, ["user_id", "played_at"], "played_at")
    frame = lambda *rows: spark.createDataFrame(rows, "user_id long, played_at timestamp")
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    old = frame(*[(1, at(1 + i % 9, i % 24)) for i in range(200)])
    sink(old, 0)
    for batch in range(1, 4):
        sink(frame((1, at(20 + batch))), batch)
    read = []
    plain = run.existing
    monkeypatch.setattr(run, "existing", lambda s, paths: read.extend(found := plain(s, paths)) or found)
    sink(frame((1, at(21)), (1, at(21, 5)), (2, None)), 4)
    sink(frame((1, at(21)), (1, at(21, 5)), (2, None)), 4)  # again, as after a lost driver
    assert sorted({p.rsplit("/", 1)[1] for p in read}) == ["day=2024-01-21", f"day={run.NO_DAY}"]
    got = spark.read.parquet(path)
    assert got.count() == old.distinct().count() + 3 + 2 and got.where("batch_id = 4").count() == 2
