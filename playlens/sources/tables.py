"""Canonical play tables over the given Parquet tables.

``plays`` is the event stream seen as a 30-day play log, ``plays_long`` the order history seen as a
multi-year one. Both have the schema in `playlens.sources.schemas.PLAYS`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.functions import exprs as X


def _choose(c: Column, names: dict) -> Column:
    """Map listed values; anything else becomes null."""
    out = None
    for value, name in names.items():
        out = (F.when if out is None else out.when)(c == value, F.lit(name))
    return out


END_REASONS = {
    "click": "fwdbtn", "view": "trackdone", "purchase": "endplay",
    "error": "unexpected-exit", "signup": "logout",
}
START_REASONS = {0: "clickrow", 1: "trackdone", 2: "fwdbtn", 3: "backbtn", 4: "playbtn"}
PLATFORMS = {
    0: "Android OS 9 API 28", 1: "Windows 10 (10.0.19042)", 2: "iOS 14.4 (iPhone12,1)",
    3: "OS X 11.2", 4: "Linux x86", 5: "web_player", 6: "",
}
ORDER_END = {"F": "fwdbtn", "O": "trackdone", "P": "endplay"}
ORDER_START = {"1-URGENT": "clickrow", "2-HIGH": "trackdone", "3-MEDIUM": "fwdbtn", "5-LOW": "backbtn"}


EPOCH_2024_US = 1704067200000000


def _compressed(ts: Column | str) -> Column:
    """2024-01-01 plus a hundredth of the time since then."""
    return F.timestamp_micros(F.lit(EPOCH_2024_US) + F.floor((X.micros(ts) - EPOCH_2024_US) / 100))


class Tables:
    """Lazy views; every access builds a plan, nothing is read before an action."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def plays(self) -> DataFrame:
        # a non-null key spares the inferred IS NOT NULL filter, which would parse the JSON a second time
        key = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(-1))
        e = self.table("events").withColumn("k", key)
        p = self.table("part").select("p_partkey", "p_name", "p_brand", "p_type")
        # a unique right side lets Catalyst drop the join wherever the country is not used
        n = self.table("nation").groupBy("n_nationkey").agg(F.min("n_name").alias("n_name"))
        joined = e.join(p, F.col("k") == F.col("p_partkey")).join(
            n, (F.col("user_id") % 25).cast("int") == F.col("n_nationkey"), "left"
        )
        return joined.select(
            "user_id",
            "event_id",
            F.col("ts").cast("timestamp").alias("time_stamp"),
            F.col("p_partkey").cast("string").alias("song_name"),
            F.concat_ws("/", "p_brand", "p_type").alias("artist_name"),
            F.col("p_type").alias("album_name"),
            F.split("p_name", " ").alias("tags"),
            F.col("value").cast("int").alias("sec_played"),
            _choose(F.col("event_type"), END_REASONS).alias("reason_end"),
            _choose(F.col("event_id") % 6, START_REASONS).alias("reason_start"),
            _choose(F.col("user_id") % 7, PLATFORMS).alias("platform"),
            (F.col("event_id") % 3 == 0).cast("int").alias("shuffle"),
            (F.col("event_id") % 7 == 0).cast("int").alias("offline"),
            F.col("n_name").alias("country"),
            (F.col("event_type") == "click").cast("int").alias("skipped"),
        )

    @cached_property
    def plays_long(self) -> DataFrame:
        o = self.table("orders")
        artist = F.col("o_custkey").cast("string")
        return o.select(
            (F.col("o_custkey") % 40).alias("user_id"),
            F.col("o_orderkey").alias("event_id"),
            F.col("o_orderdate").cast("timestamp").alias("time_stamp"),
            F.concat_ws("-", artist, F.substring("o_orderpriority", 1, 1)).alias("song_name"),
            artist.alias("artist_name"),
            F.when(F.col("o_orderstatus") != "P", F.concat_ws("-", artist, "o_orderstatus")).alias("album_name"),
            F.array(F.lower("o_orderstatus"), F.lower("o_orderpriority")).alias("tags"),
            F.col("o_totalprice").cast("int").alias("sec_played"),
            _choose(F.col("o_orderstatus"), ORDER_END).alias("reason_end"),
            _choose(F.col("o_orderpriority"), ORDER_START).alias("reason_start"),
            _choose(F.col("o_custkey") % 7, PLATFORMS).alias("platform"),
            (F.col("o_orderkey") % 3 == 0).cast("int").alias("shuffle"),
            (F.col("o_orderkey") % 7 == 0).cast("int").alias("offline"),
            F.lit(None).cast("string").alias("country"),
            (F.col("o_orderstatus") == "F").cast("int").alias("skipped"),
        )

    @cached_property
    def raw_plays(self) -> DataFrame:
        """``events`` in the shape of a raw export: original column names, milliseconds, null songs."""
        e = self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        music = F.col("k") % 10 != 9
        return e.select(
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
            _choose(F.col("user_id") % 7, PLATFORMS).alias("platform"),
            (F.col("value") * 1000).cast("bigint").alias("ms_played"),
            F.lit("IN").alias("conn_country"),
            F.lit("10.0.0.1").alias("ip_addr"),
            F.when(music, F.col("k").cast("string")).alias("master_metadata_track_name"),
            F.when(F.col("k") % 20 != 8, F.concat(F.lit("a"), (F.col("k") % 30).cast("string"))).alias(
                "master_metadata_album_artist_name"
            ),
            F.concat(F.lit("b"), (F.col("k") % 15).cast("string")).alias("master_metadata_album_album_name"),
            F.when(~music, F.lit("episode")).alias("episode_name"),
            F.lit(None).cast("string").alias("audiobook_title"),
            _choose(F.col("event_id") % 6, START_REASONS).alias("reason_start"),
            _choose(F.col("event_type"), END_REASONS).alias("reason_end"),
            (F.col("event_id") % 3 == 0).alias("shuffle"),
            F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 7 == 0).alias("offline"),
            "user_id",
            "event_id",
        )

    @cached_property
    def track_meta(self) -> DataFrame:
        """Tag metadata per (artist, song) with duplicate keys and empty lists, from ``part``."""
        p = self.table("part")
        return p.select(
            F.concat_ws("/", "p_brand", "p_type").alias("artist_name"),
            (F.col("p_partkey") % 100).cast("string").alias("song_name"),
            F.when(F.col("p_partkey") % 3 == 0, F.array().cast("array<string>"))
            .otherwise(F.split("p_name", " "))
            .alias("genres"),
            F.col("p_partkey").alias("version"),
        )

    @cached_property
    def artist_meta(self) -> DataFrame:
        p = self.table("part").where("p_size % 2 = 0")
        return (
            p.groupBy(F.concat_ws("/", "p_brand", "p_type").alias("artist_name"))
            .agg(F.array_sort(F.collect_set(F.lower("p_type"))).alias("genres"))
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Two deterministic scores per line item; the label is the returned flag."""
        li = self.table("lineitem")
        mix = (
            F.col("l_orderkey") * 31 + F.col("l_partkey") * 7919 + F.col("l_suppkey") * 104729
            + F.col("l_linenumber") * 17
        )
        label = (F.col("l_returnflag") == "R").cast("int")
        return li.select(
            F.col("l_orderkey").alias("event_id"),
            label.alias("label"),
            ((mix % 701 + label * 299) / 1000).alias("champion"),
            ((mix % 503 + label * 400 + 97) / 1000).alias("high_recall"),
        )

    def scored_long(self) -> DataFrame:
        return self.scored.select(
            "event_id",
            "label",
            F.inline(
                F.array(
                    F.struct(F.lit("champion").alias("model"), F.col("champion").alias("score")),
                    F.struct(F.lit("high_recall").alias("model"), F.col("high_recall").alias("score")),
                )
            ),
        )

    @cached_property
    def recent_plays(self) -> DataFrame:
        """Finished plays as a poll reports them: an end time and a track duration. The time axis is
        compressed 100-fold, which brings a user's median gap to a few minutes."""
        p = self.plays
        return p.select(
            "user_id",
            "event_id",
            _compressed("time_stamp").alias("played_at"),
            F.concat_ws("::", "song_name", "artist_name").alias("track_id"),
            "song_name",
            "artist_name",
            "album_name",
            (F.lit(10.0) + F.col("song_name").cast("int") * 5).alias("duration_sec"),
        )

    @cached_property
    def progress(self) -> DataFrame:
        """Polled playback snapshots over ``events`` on the compressed time axis."""
        e = self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        return e.select(
            "user_id",
            "event_id",
            _compressed(F.col("ts").cast("timestamp")).alias("poll_ts"),
            F.floor(F.col("k") / 20).cast("string").alias("track_id"),
            F.col("value").alias("progress_sec"),
            (F.lit(5.0) + F.col("k")).alias("duration_sec"),
            F.when(F.col("event_type") == "error", "IDLE").otherwise("ACTIVE").alias("status"),
        )

    @cached_property
    def audit(self) -> DataFrame:
        """A resolved / pending audit log over ``events``."""
        e = self.table("events")
        prob = (F.col("event_id") * 37 % 1000) / 1000
        pending = F.col("event_id") % 10 == 0
        skipped = (F.col("event_type") == "click").cast("int")
        predicted = (prob >= 0.45).cast("int")
        return e.select(
            "user_id",
            "event_id",
            F.col("ts").cast("timestamp").alias("played_at"),
            F.get_json_object("props", "$.k").alias("song_name"),
            prob.alias("predicted_prob"),
            predicted.alias("predicted_skip"),
            F.when(~pending, F.col("value")).alias("actual_played_sec"),
            F.when(~pending, skipped).alias("actual_skipped"),
            F.when(~pending, X.grade(predicted, skipped)).alias("evaluation_result"),
            F.when(~pending, X.mb_saved(predicted, skipped, F.col("value"))).otherwise(0.0).alias("cdn_mb_saved"),
            F.when(pending, "PENDING").otherwise("RESOLVED").alias("status"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Predictions logged per upcoming track: the ``view`` and ``purchase`` events."""
        e = self.table("events").where(F.col("event_type").isin("view", "purchase", "signup"))
        return e.select(
            "user_id",
            "event_id",
            F.col("ts").cast("timestamp").alias("made_at"),
            F.get_json_object("props", "$.k").alias("song_name"),
            F.lit("a").alias("artist_name"),
            ((F.col("event_id") * 37 % 1000) / 1000).alias("prob"),
            (F.col("event_id") % 50 == 0).cast("int").alias("flagged"),
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        e = self.table("events").where(F.col("event_type").isin("click", "error"))
        return e.select(
            "user_id",
            "event_id",
            F.col("ts").cast("timestamp").alias("made_at"),
            F.get_json_object("props", "$.k").alias("song_name"),
            F.lit("a").alias("artist_name"),
            F.col("value").alias("listen_sec"),
            (F.col("value") + 60).alias("total_sec"),
            (F.col("event_type") == "click").cast("int").alias("was_skipped"),
        )
