"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), CAREMESA_SHARED_DIR (folder for scratch data). Each query is
run once to warm up and once for the figure; both runs build the plan anew and
compute every output column and row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from caremesa import registry

HEADLINE = (
    "V01 V02 V03 V04 V05 V06 V07 V09 V10 V11 V12 V13 V14 V15 V16 V17 V18 "
    "Q01 Q03 Q09 Q12 Q15 Q25 Q28 Q29 Q30 Q32 Q34 Q39 "
    "P03 P05 P08 D32 D45 D46 D47 D48 E08 E09 E15 E18 M04 M06 "
    "D44 E05 E06 E07 E16 P02 P10 P11 M03 M07"
).split()


def run(spark: SparkSession, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("CAREMESA_SHARED_DIR", "file:///tmp/caremesa-shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    wanted = sys.argv[1:] or HEADLINE
    plans = registry.queries()
    seconds = {}
    for key in wanted:
        run(spark, plans[key], folder)
        seconds[key] = round(run(spark, plans[key], folder), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
