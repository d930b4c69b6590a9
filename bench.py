"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores for local[*]     (default 8)
    BENCH_QUERIES  comma-separated keys, or "all" for every registered query
    BENCH_RUNS     runs per query, the median counts (default 1)

Each query writes its whole result to Spark's no-op sink. A small query runs first, so that
session start is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from parityframe.operators.prefix import weighted_cdf, weighted_rows  # noqa: E402
from parityframe.plans import stages  # noqa: E402
from parityframe.plans.catalog import BY, INCOME, QUERIES, WEIGHT, incomes, raw  # noqa: E402
from parityframe.plans.persons import persons  # noqa: E402
from parityframe.sources import ingest  # noqa: E402
from parityframe.workspace import scratch_path  # noqa: E402

HEADLINE = [
    "csv_ingest",
    "partitioned_roundtrip",
    "refined_layer",
    "dedup",
    "income_stats",
    "describe_income",
    "demog_age",
    "null_percent",
    "weighted_percentiles",
    "qcut_bins",
    "iqr_outliers",
    "income_histogram_trimmed",
    "attrition",
    "gini",
    "theil",
    "palma",
    "poverty_half_median",
    "quantile_shares",
    "lorenz_points",
    "shared_prosperity",
    "baseline_metrics",
    "inequality_summary",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def single_window(rows: DataFrame, by: list[str]) -> DataFrame:
    """The plain alternative to the kernel: one ordered window per group over all rows."""
    ranked = Window.partitionBy(*by).orderBy("value", "w")
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(
        *by,
        "value",
        F.sum("w").over(running).alias("weight_reached"),
        F.sum(F.col("w") * F.col("value")).over(running).alias("income_reached"),
    )


def kernel(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Cell-wise running totals against a single window, by number of groups."""
    people = incomes(spark, sf_dir)
    found = {}
    for name, by in (("country_year", BY), ("country", ["COUNTRY"]), ("one_group", [])):
        rows = weighted_rows(people, INCOME, WEIGHT, by)
        found[f"kernel_{name}"] = timed(lambda: drain(weighted_cdf(rows, by)))
        found[f"window_{name}"] = timed(lambda: drain(single_window(rows, by)))
    return found


def staged(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, float]]:
    """Raw CSV to aggregate tables, stage by stage."""
    source, root = scratch_path(spark, "bench-csv"), scratch_path(spark, "bench")
    raw(spark, sf_dir).write.option("header", True).csv(source)
    n_rows = persons(spark, sf_dir).count()
    seconds = {"stage_bronze": timed(lambda: ingest.ensure_bronze(spark, source, f"{root}/bronze"))}
    bronze = spark.read.parquet(f"{root}/bronze")
    seconds["stage_silver"] = timed(
        lambda: stages.build_silver(bronze, f"{root}/silver", order_by=["SAMPLE", "PERWT", "AGE"])
    )
    silver = spark.read.parquet(f"{root}/silver")
    seconds["stage_gold"] = timed(lambda: stages.build_gold(silver, f"{root}/gold"))
    total = sum(seconds.values())
    rates = {
        "ingest_rows_per_sec": n_rows / seconds["stage_bronze"],
        "end_to_end_rows_per_sec": n_rows / total,
        "csv_to_parquet_ratio": size(spark, source) / size(spark, f"{root}/bronze"),
    }
    return seconds, rates


def size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if chosen == "all" else [k for k in chosen.split(",") if k] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parityframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["gini"](spark, sf_dir))

    seconds: dict[str, float] = {}
    for key in keys:
        times = [timed(lambda: drain(QUERIES[key](spark, sf_dir))) for _ in range(runs)]
        seconds[key] = statistics.median(times)
    rates: dict[str, float] = {}
    totals: dict[str, float] = {}
    if not chosen or chosen == "all":
        stage_seconds, rates = staged(spark, sf_dir)
        seconds |= stage_seconds
        totals = kernel(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "running_totals": {k: round(v, 3) for k, v in totals.items()},
                "rates": {k: round(v, 2) for k, v in rates.items()},
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
