"""Time every registered query; print one JSON line.

BENCH_SF_DIR  the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one to warm up; the median counts (default 3)

Results go to Spark's no-op sink: all rows are computed, none are collected. CSV inputs are
written in the warm-up run and are not timed. The last part loads lineitem as CSV step by step
(infer types, count, write, count again) and with this library and known types.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import lakeload as ll
from lakeload.queries import DAY_1, QUERIES, as_csv, drop_workspaces, given, workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakeload-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(spark: SparkSession, key: str) -> None:
    QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()


STATS = {
    "n_lines": ("count", "*"),
    "n_flags": ("count_distinct", "l_returnflag"),
    "avg_price": ("avg", "l_extendedprice"),
    "total_quantity": ("sum", "l_quantity"),
}


def daily_step_by_step(spark: SparkSession, path: str, table: str) -> None:
    rows = spark.read.csv(path, header=True, inferSchema=True)
    rows.count()
    stamped = rows.withColumn("logical_date", F.to_timestamp(F.lit("2024-11-10")))
    stamped.writeTo(table).using("parquet").create()
    stamped.count()


def daily_in_one_pass(spark: SparkSession, path: str, table: str) -> None:
    schema = given(spark, SF_DIR, "lineitem").schema
    ll.load_day(ll.load_csv(spark, path, schema=schema), table, DAY_1)


def refresh_step_by_step(spark: SparkSession, path: str, table: str) -> None:
    rows = spark.read.csv(path, header=True, inferSchema=True)
    rows.count()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows.withColumn("processed_at", F.current_timestamp()).writeTo(table).using("parquet").create()
    spark.table(table).count()
    ll.profile(spark.table(table), STATS).collect()


def refresh_in_one_pass(spark: SparkSession, path: str, table: str) -> None:
    schema = given(spark, SF_DIR, "lineitem").schema
    stamps = ["processed_at"]
    ll.refresh_and_profile(spark, path, table, STATS, stamps=stamps, schema=schema).collect()


def compare_loads(spark: SparkSession) -> dict:
    path = as_csv(spark, SF_DIR, "lineitem")
    status = spark.sparkContext.statusTracker()
    compared = {}
    for load in (
        daily_step_by_step,
        daily_in_one_pass,
        refresh_step_by_step,
        refresh_in_one_pass,
    ):
        times = []
        for n in range(RUNS + 1):
            table = workspace(spark).table("loaded")
            group = f"{load.__name__}-{n}"
            spark.sparkContext.setJobGroup(group, group)
            times.append(timed(lambda: load(spark, path, table)))
            jobs = len(status.getJobIdsForGroup(group))
        compared[load.__name__] = {
            "sec": round(statistics.median(times[1:]), 4),
            "spark_jobs": jobs,
        }
        spark.sparkContext.setJobGroup("bench", "bench")
        drop_workspaces(spark, keep_inputs=True)
    return compared


def main() -> None:
    spark = session()
    seconds = {}
    for key in QUERIES:
        run(spark, key)
        seconds[key] = round(
            statistics.median(timed(lambda: run(spark, key)) for _ in range(RUNS)), 4
        )
        drop_workspaces(spark, keep_inputs=True)
    loads = compare_loads(spark)
    drop_workspaces(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "lineitem_csv_load": loads,
            }
        )
    )


if __name__ == "__main__":
    main()
