"""Measure the profile plans from Spark's event log: wall time, tasks,
shuffle bytes and records written per plan.

    python tests/profile_shuffle_report.py [sf_dir]

The event log goes to a fresh scratch folder (uncompressed, so it can be
read back here); nothing else is written.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from quarry import profile_detailed  # noqa: E402
from quarry.session import local_session  # noqa: E402

PLANS = [
    ("per_column", dict(exact_plan="per_column")),
    ("narrow", dict(exact_plan="narrow")),
    ("exact_single_pass", dict(distinct="exact_single_pass")),
    ("approx", dict(distinct="approx")),
]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="quarry-eventlog-")
    spark = local_session(conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    profile_detailed(spark.read.parquet(f"{sf_dir}/orders.parquet")).collect()  # warm-up
    seconds = {}
    for label, options in PLANS:
        sc.setJobGroup(label, label)
        t0 = time.time()
        profile_detailed(lineitem, samples=False, **options).collect()
        seconds[label] = round(time.time() - t0, 2)
    spark.stop()

    group_of_stage, stats = {}, {}
    for path in sorted(f for f in glob.glob(f"{log_dir}/**", recursive=True) if os.path.isfile(f)):
        for line in open(path):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    group_of_stage[stage] = group
            elif event["Event"] == "SparkListenerTaskEnd":
                group = group_of_stage.get(event["Stage ID"])
                if group is None:
                    continue
                shuffle = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                s = stats.setdefault(group, {"tasks": 0, "shuffle_bytes": 0, "shuffle_records": 0})
                s["tasks"] += 1
                s["shuffle_bytes"] += shuffle.get("Shuffle Bytes Written", 0)
                s["shuffle_records"] += shuffle.get("Shuffle Records Written", 0)
    print("| plan | seconds | tasks | shuffle bytes | shuffle records |")
    print("| --- | --- | --- | --- | --- |")
    for label, _ in PLANS:
        s = stats.get(label, {})
        print(f"| {label} | {seconds[label]} | {s.get('tasks')} | {s.get('shuffle_bytes'):,} | "
              f"{s.get('shuffle_records'):,} |")


if __name__ == "__main__":
    main(sys.argv)
