"""Wall-clock of the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores), BENCH_QUERIES (blank-separated
names, or 'all'). Every result is consumed in full by the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from playlens.plans import registry
from playlens.session import build_session

HEADLINE = """
rank_artist_alltime_plays rank_song_day rank_artist_season_year genre_listened_alltime genre_explored_month
volume_hour traffic_heatmap skip_heatmap skip_rate_artist lifecycle_flows platform_outcome_ratio
quickest_skipped_artists daily_usage_trend sessionize marathons_12h binge_histogram artist_month_streaks
artist_streak_days silent_breaks genre_cascade artist_top3_imputation latest_rate_lookup
target_encode_artist target_encode_multitag rolling_skips asof_last_skip feature_matrix feature_matrix_long
session_replay_features resolve_outcomes audit_metrics session_mood
pr_curve roc_auc threshold_sweep strategy_compare temporal_split_fraction_70
lookup_with_fallback queue_forecast reason_start_share genre_coverage sink_report_sections
stream_dedup train_boosted
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    asked = os.environ.get("BENCH_QUERIES", "").split()
    registry.load()
    names = list(registry.QUERIES) if asked == ["all"] else (asked or HEADLINE)
    spark = build_session(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    registry.QUERIES["feature_matrix"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()  # JVM warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
