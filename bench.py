"""Headline timings: prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. The telemetry
tables are derived from the test data and stored once, untimed; the jobs read
those and write the three target tables. The other queries derive their input
from the test data as they run and discard their rows. Everything is run once
to warm up and then timed.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql.types import IntegerType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kvloom import fixtures as fx  # noqa: E402
from kvloom.model import RunOptions  # noqa: E402
from kvloom.operators.enrich import latest_rows, shape_history  # noqa: E402
from kvloom.plans import jobs  # noqa: E402
from kvloom.plans.target import Batch, Target  # noqa: E402
from kvloom.registry import registered  # noqa: E402
from kvloom.scratch import scratch_folder  # noqa: E402
from kvloom.sources import ParquetSource, load_dimensions  # noqa: E402

HEADLINES = [
    "history_rows",
    "history_rows_cast",
    "partition_index",
    "latest_from_history",
    "rejected_rows",
    "migrated_counts",
    "changed_since",
    "sync_once",
    "entity_page",
    "changed_page",
]
REPEATS = 3


def store_source(spark: SparkSession, sf_dir: str) -> str:
    """Store the telemetry tables as the jobs meet them elsewhere: as files."""
    folder = scratch_folder(spark, "source")
    source = fx.telemetry_source(spark, sf_dir)
    for table in ("ts_kv", "ts_kv_latest", "key_dictionary", "device", "asset"):
        rows = source.find(table)
        if table == "ts_kv":
            rows = rows.repartitionByRange("ts")
        rows.write.parquet(f"{folder}/{table}")
    return folder


def three_tables(spark: SparkSession, folder: str) -> None:
    """History, index and latest from source to stored tables."""
    source = ParquetSource(spark, folder, IntegerType())
    options = RunOptions()
    dims = load_dimensions(source, keep=True)
    target = Target(spark, scratch_folder(spark, "bench"))
    batch = Batch("history", 1, 0)
    target.write_history(shape_history(source.history(), dims, options), batch, "MONTHS")
    target.write_index(batch)
    target.write_latest(latest_rows(source.latest(), dims, options), batch)
    dims.release()


def full_job(spark: SparkSession, folder: str) -> None:
    """The same with preload, progress records and counts."""
    target = Target(spark, scratch_folder(spark, "bench"))
    jobs.run_historical(ParquetSource(spark, folder, IntegerType()), target, RunOptions())


def discard(query):
    def run(spark: SparkSession, sf_dir: str) -> None:
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    return run


def timed(run, spark: SparkSession, sf_dir: str) -> float:
    run(spark, sf_dir)
    seconds = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run(spark, sf_dir)
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    logging.disable(logging.WARNING)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="kvloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    stored = store_source(spark, sf_dir)
    queries = {
        "three_tables": timed(three_tables, spark, stored),
        "full_job": timed(full_job, spark, stored),
    }
    for name in HEADLINES:
        queries[name] = timed(discard(registered()[name]), spark, sf_dir)
    rows = fx.read_table(spark, sf_dir, "events").count()
    print(
        json.dumps(
            {
                "metric": "history, index and latest from source to stored tables",
                "value": queries["three_tables"],
                "unit": "sec",
                "queries": queries,
                "source_rows": rows,
                "rows_per_sec": round(rows / queries["three_tables"]),
                "sf": os.path.basename(os.path.normpath(sf_dir)),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
