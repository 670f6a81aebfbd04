"""Headline timings: one JSON line, median wall seconds of warm runs per query."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestar.session import build_session  # noqa: E402
from lakestar.suite import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "mean_songs_between_home", "downgrade_timeline", "running_sum_range", "running_sum_rows",
    "songs_dimension", "artists_dimension", "users_distinct", "users_latest_level", "time_dimension_millis",
    "songplays_inner_distinct", "songplays_left_md5", "songplays_lookup_first", "songplays_with_time",
    "chained_name_join", "session_item_table", "user_session_table", "listeners_of_song",
    "insert_or_ignore", "upsert_named_column", "last_write_wins",
    "web_log_parsed", "top_hosts", "title_word_frequency", "proper_noun_frequency",
    "top_artists_with_ties", "pages_not_visited", "revenue_per_month", "listings_per_month_for_hosts",
    "listing_table", "bookings_table", "table_profile", "quality_findings",
    "json_by_field_paths", "csv_with_free_text", "partitioned_table", "streamed_upsert",
    "full_load_row_counts", "full_load_findings", "lodging_load_row_counts",
)


def run(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        {"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name)  # warm-up
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
