"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local threads. Each query is run
to the last row into Spark's no-op sink; the better of two runs counts. ``--duckdb`` also times the
SQL of the same queries in DuckDB, on as many threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame

from check_queries import database, session
from shelfwise.catalog import QUERIES, SQL

HEADLINE = [
    "text_length_by_label",
    "json_lines_read",
    "text_flat",
    "text_listed",
    "words_counted",
    "requests_checked",
    "word_ids",
    "words_encoded",
    "pieces_encoded",
    "truncation_by_label",
    "label_counts",
    "word_count_boxes",
    "label_examples",
    "seeded_shuffle",
    "mini_batches",
    "running_step_metrics",
    "sample_of_share",
    "sample_of_size",
    "split_by_share",
    "split_by_size",
    "weighted_scores",
    "confusion_table",
    "class_report",
    "mean_cross_entropy",
    "features_scaled",
    "features_projected",
    "text_classifier",
    "table_predictions",
    "stream_texts",
    "etl_job",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(runs: int, work) -> float:
    times = []
    for _ in range(runs):
        begun = time.perf_counter()
        work()
        times.append(time.perf_counter() - begun)
    return round(min(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("OFF")
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    drain(QUERIES["text_length_by_label"](spark, folder))  # warm-up
    times = {}
    for name in names:
        times[name] = best_of(2, lambda: drain(QUERIES[name](spark, folder)))
        print(f"{name:24} {times[name]:8.3f}", file=sys.stderr, flush=True)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "--duckdb" in sys.argv:
        connection = database(folder)
        connection.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
        out["duckdb"] = {n: best_of(2, lambda: connection.execute(SQL[n]).fetchall()) for n in names if n in SQL}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
