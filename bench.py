"""Time every named query once warm; prints one JSON line.

``silver_build``, ``soiled_build`` and ``bronze_build`` are the tables that the others read:
the market cells from the order tables, the same with faults, and the report text.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymark.registry.queries import all_queries  # noqa: E402
from tallymark.schemas import GRAINS  # noqa: E402
from tallymark.sources.market import Market  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = os.environ.get("BENCH_ONLY", "")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        # Plans are built by many small calls; noting the source line of each costs more
        # than the calls do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    market = Market(spark, SF_DIR)
    run(spark.range(1000))
    seconds = {
        # The whole path of each report from the order tables, nothing staged.
        **{f"{g.name}_path": timed(lambda g=g: run(market.compute(g))) for g in GRAINS},
        "silver_build": timed(market.silver),
        "soiled_build": timed(market.dirty),
        "bronze_build": timed(market.report_lines),
    }
    chosen = {
        name: query for name, query in all_queries().items() if not ONLY or name in ONLY.split(",")
    }
    for name, query in chosen.items():
        # One cold run, then the median of the warm ones, for every query alike.
        times = [timed(lambda: run(query(spark, SF_DIR))) for _ in range(RUNS + 1)]
        seconds[name] = statistics.median(times[1:])
    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
