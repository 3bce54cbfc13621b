"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run in full into the noop sink, once to warm up and then BENCH_RUNS times; the
median counts.
"""

import json
import os
import statistics
import time
from pathlib import Path

from checks.queries import QUERIES
from tickloom.session import local_session

HEADLINES = [
    "flagship", "ind_sma", "ind_rsi", "ind_adx", "ind_ema", "ind_atr", "ind_vwap", "ind_supertrend", "ind_daily",
    "ind_long_registry", "ind_pivot_merge", "feat_all", "sig_features", "sig_incremental", "label_horizon", "label_minute",
    "stage_dedup", "stage_merge_snapshot", "raw_dedup", "upsert_features", "ingest_filter", "ingest_summary",
    "dq_dupe_rows", "dq_low_coverage", "dq_table_counts", "dq_report", "train_split", "eval_report", "runlog_symbols",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINES
    spark = local_session(
        os.environ.get("BENCH_CPUS", "8"),
        # windows are heavy per byte: small partitions keep every core busy
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
