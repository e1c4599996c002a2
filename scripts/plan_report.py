"""Formatted physical plans of the gold models on stored silver (the production shape)
and of the flagship end to end, summarised: exchanges, broadcasts, partial window
limits, scan pruning.  Usage: python scripts/plan_report.py [--sf DIR] [--full]"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snaplake import fixtures  # noqa: E402
from snaplake.plans import gold, silver  # noqa: E402
from snaplake.session import get_session, scratch_path  # noqa: E402
from snaplake.sinks import lake  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def summary(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"\bExchange \(", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "partial_window_limits": text.count("row_number(), 1, Partial")
        + len(re.findall(r"WindowGroupLimit.*\n.*Partial", text)),
        "partition_filters": sorted(set(re.findall(r"PartitionFilters: \[(.*)\]", text))),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<.*>)", text))),
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--full", action="store_true")
    a = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=16)
    root = scratch_path(spark, "plan-report")
    s = silver.build_silver(fixtures.raw_tables(spark, a.sf))
    stored = {k: lake.materialise(v, root, "core", k, partition_by=(
        ["snapshot_date", "source"] if k == "core_movies" else ["snapshot_date"]))
        for k, v in s.items()}
    for name, df in gold.build_gold(stored).items():
        text = plan_text(df)
        print(f"## {name}\n{summary(text)}\n")
        if a.full:
            print(text)


if __name__ == "__main__":
    main()
