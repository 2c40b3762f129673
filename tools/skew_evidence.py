"""Task-level evidence for the skew-safe path, from Spark's event log.

    python tools/skew_evidence.py <request-log parquet dir>

Runs the pacing audit over a request log twice, with a plain lag() window
and with the forced skew-safe path, writing Spark's event log to a scratch
folder. Then reports, per stage, the largest task's shuffle-read records next
to the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dcflow.operators.ledger import pacing_audit  # noqa: E402
from dcflow.session import build_session  # noqa: E402


def stage_tasks(log_dir: str, job_group: str) -> list[dict]:
    """Per stage of the jobs tagged ``job_group``: tasks, max and median shuffle-read records."""
    files = [os.path.join(d, f) for d, _, fs in os.walk(log_dir) for f in fs
             if not f.startswith(".") and not f.endswith(".crc")]
    stages_of_group, tasks = set(), {}
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages_of_group.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    tasks.setdefault(ev["Stage ID"], []).append(m.get("Total Records Read", 0))
    out = []
    for sid in sorted(stages_of_group):
        recs = tasks.get(sid, [])
        if recs and max(recs) > 0:
            out.append({"stage": sid, "tasks": len(recs), "max_records": max(recs),
                        "median_records": int(statistics.median(recs))})
    return out


def main() -> None:
    log_parquet = sys.argv[1]
    ev_dir = tempfile.mkdtemp(prefix="dcflow-eventlog-", dir="/tmp")
    spark = build_session("local[8]", app="dcflow-skew-evidence", shuffle_partitions=32,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.driver.memory": "16g"})
    log = spark.read.parquet(log_parquet)
    sc = spark.sparkContext
    sc.setJobGroup("plain", "plain lag window")
    w = Window.partitionBy("client").orderBy("ts", "request_id", "attempt")
    log.withColumn("prev", F.lag("ts").over(w)).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("skew_safe", "forced skew-safe path")
    pacing_audit(log).write.format("noop").mode("overwrite").save()
    spark.stop()
    out = {"plain": stage_tasks(ev_dir, "plain"),
           "skew_safe": stage_tasks(ev_dir, "skew_safe"), "event_log": ev_dir}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
