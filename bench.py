"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lossgrain.queries import QUERIES  # noqa: E402
from lossgrain.session import release, session  # noqa: E402

HEADLINE = [
    "a2_last_per_loan",
    "a5_vintage_stats",
    "a16_months_delinquent",
    "j1_join_loans",
    "q5_validate_rows",
    "p4_fill_median",
    "p8_with_ltv_at_default",
    "p15_feature_matrix",
    "a9_binned_mean",
    "a13_corr_with_target",
    "m1_split_stratified",
    "m9_regression_metrics",
    "m12_calibration",
    "m7_interval_of_members",
    "m15_macro_scenarios",
    "mon2_json_feature_means",
    "mon5_ks_statistic",
    "x2_stream_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        # The sink takes every row, so nothing is pruned away or collected.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        release(spark)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        "spark": spark.version,
        "shuffle_partitions": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
