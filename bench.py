"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (local threads), ``BENCH_RUNS`` (timed runs after one warm
run). ``BENCH_PLAIN=1`` times the same questions asked as one plain Spark SQL statement each, for comparison.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deltaextract.plans.oracle import oracle_sql
from deltaextract.plans.queries import queries

HEADLINE = (
    "cohort_keys",
    "fingerprint_parent",
    "fingerprint_child",
    "changed_keys",
    "delta_parent",
    "delta_child",
    "merge_snapshot",
    "live_keys",
    "csv_roundtrip",
    "run_feed",
)
ONLY_AS_JOB = {"csv_roundtrip", "run_feed"}


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def spark_sql(text: str) -> str:
        for old, new in (("CAST('0x' || ", "CAST(conv("), (", 15) AS BIGINT)", ", 15), 16, 10) AS DECIMAL(20,0))")):
            text = text.replace(old, new)
        return re.sub(r"\\(\d)", r"$\1", text.replace("varchar", "string"))

    def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
        for table in ("orders", "customer", "lineitem", "nation", "region"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
        spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sha256(x STRING) RETURNS STRING RETURN sha2(x, 256)")
        return spark.sql(spark_sql(text))

    return {
        name: lambda spark, sf_dir, text=text: run(spark, sf_dir, text)
        for name, text in oracle_sql().items()
        if name not in ONLY_AS_JOB
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    plain = os.environ.get("BENCH_PLAIN") == "1"
    found = plain_queries() if plain else queries()
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds = {}
    for name in HEADLINE:
        if name not in found:
            continue
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            found[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_plain_sql" if plain else "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
