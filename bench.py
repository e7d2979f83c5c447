"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. What the queries read is made of the tables, and timed, first."""

import json
import os
import time

from pyspark.sql import SparkSession

from tickweave.plans import registry
from tickweave.plans.registry import QUERIES

NAMES = ["trades_by_symbol", "trades_decode", "bba_decode", "depth_diff_decode", "rest_decode", "symbol_exact", "gap_detect", "throttle_admit", "rotation_files", "framelog_roundtrip", "log_stream", "log_days", "idle_sessions"]
#: Builders of messages, each timed as a query of its own.
MADE = {"encode_trades": ("trade_frames",), "encode_depth_diff": ("depth_frames", registry.sbe.DIFF), "encode_best": ("best_frames",), "encode_rest": ("rest_frames",), "encode_updates": ("diff_frames",), "write_log": ("written_log",)}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}

    def timed(name, f):
        began = time.time()
        f()
        took[name] = round(time.time() - began, 3)

    for name, (make, *args) in MADE.items():
        timed(name, lambda make=make, args=args: registry.FRAMES[make](spark, sf, *args))
    for name in NAMES:
        timed(name, lambda name=name: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total seconds of the headline queries, messages included", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
