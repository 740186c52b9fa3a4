"""Headline queries on whole tables; prints one JSON line with seconds per query.

Every query is run to its last row (the ``noop`` sink takes the output), after
one untimed warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabprep.plans import registry  # noqa: E402
from tabprep.session import drop_scratch  # noqa: E402

HEADLINE = (
    "clean_strings_documents",
    "clean_table_lineitem",
    "clean_table_orders",
    "clean_drop_duplicate_columns",
    "src_csv_lineitem",
    "src_detect_dialect",
    "sink_fanout_counts",
    "agg_value_counts",
    "sql_join_cleaned_tables",
    "doc_update_many",
    "inc_stream_clean_load",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabprep-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    registry.queries()["clean_table_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
