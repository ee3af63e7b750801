"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all) choose the data and the cores. Each query
is planned and run to the end without collecting its rows. ``score_table`` is the whole scoring job, which also
builds the stored table the record and rollup queries read; state queries such as t01 run the job again themselves.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("t01_running_score", "t01_tiers_by_region", "g01_event_sums", "d01_rule_join", "b02_payload_split",
            "b13_risk", "b13_trend", "b13_geography", "f23_f33_risk", "g02_hourly_activity", "g03_daily_subject",
            "g04_system_daily", "g10_event_summary", "g16_statistics", "w01_moving_average", "w05_percentile_rank",
            "t04_cooldown", "t05_decay", "t06_neighbour_scores", "n04_network_density", "a09_archive")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("scoreloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from scoreloom.plans import tables
    from scoreloom.plans.catalog import QUERIES

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds: dict[str, float] = {}

    def timed(name, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("score_table", lambda: tables.processed(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    rows = tables.events(spark, sf_dir).count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "events": rows,
        "scored_events_per_sec": round(rows / seconds["t01_running_score"], 1), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
