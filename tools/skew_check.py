"""Skew check: one device holds a third of all readings.

    python tools/skew_check.py [sf_dir]

Derives a skewed reading set from ``events`` (every third event belongs to
``device-hot``), runs the key operators with Spark's event log written to a
fresh local scratch folder ($SKEW_LOG_ROOT, default /tmp; a local diagnostic),
and reports, per operator, the largest
share of shuffle-read records that a single task received in any reduce stage.
With 32 reduce partitions an even spread is ~3%; a hot key processed whole in
one task would show >= 33%.  ``counter_rate`` is also run with one bucket
spanning all time (the naive per-series window) for comparison.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sensorstream.operators import aggregates as A  # noqa: E402
from sensorstream.operators import latest as LW  # noqa: E402
from sensorstream.operators import timeseries as TS  # noqa: E402
from sensorstream.operators import topn as TN  # noqa: E402
from sensorstream.operators.anomalies import anomalies  # noqa: E402
from sensorstream.session import build_session  # noqa: E402

PARTS = 32


def skewed(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(PARTS)
    dev = F.when(F.col("event_id") % 3 == 0, F.lit("device-hot")).otherwise(
        F.concat(F.lit("device-"), F.col("user_id").cast("string")))
    return ev.select("event_id", dev.alias("device_id"), F.col("ts").cast("timestamp").alias("ts"),
                     F.col("value").alias("temperature"),
                     (F.floor(F.col("event_id") / 10) % 50).cast("double").alias("counter"))


def stage_skew(log_dir: str, job_group: str) -> float:
    """Max share of shuffle-read records held by one task, over the reduce
    stages of the jobs tagged ``job_group``."""
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(f)]
    stages, jobs = {}, set()
    for f in files:
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    props = e.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        for s in e.get("Stage IDs", []):
                            jobs.add(s)
                elif ev == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    stages.setdefault(e["Stage ID"], []).append(recs)
    worst = 0.0
    for sid, recs in stages.items():
        if sid in jobs and sum(recs) > 0 and len(recs) > 1:
            worst = max(worst, max(recs) / sum(recs))
    return worst


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    root = "/tmp" if not os.environ.get("SKEW_LOG_ROOT") else os.environ["SKEW_LOG_ROOT"]
    log_dir = os.path.join(root, f"sensorstream-eventlog-{uuid.uuid4().hex[:8]}")
    os.makedirs(log_dir)
    spark = build_session("local[8]", PARTS, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    r = skewed(spark, sf_dir)
    series = r.withColumnRenamed("counter", "value")
    ops = {
        "tumbling_avg (1 hour)": A.tumbling_avg(r, "device_id", "ts", "1 hour"),
        "count_by device": A.count_by(r, "device_id"),
        "latest_n (3 per device)": TN.latest_n(r, "device_id", "ts", 3),
        "latest_wins (device, hour)": LW.latest_wins(r.withColumn("ts", F.date_trunc("hour", "ts")),
                                                      ["device_id", "ts"], "event_id", "window"),
        "counter_rate (1 hour buckets)": TS.counter_rate(series, "device_id", bucket="1 hour"),
        "counter_rate (one bucket = naive)": TS.counter_rate(series, "device_id", bucket="100000 days"),
    }
    windows = A.tumbling_avg(r, "device_id", "ts", "1 minute")
    ops |= {"anomalies (1-day buckets)": anomalies(windows, bucket="1 day"), "anomalies (whole histories)": anomalies(windows)}
    sc = spark.sparkContext
    groups = {}
    for name, df in ops.items():
        g = "skew-" + uuid.uuid4().hex[:8]
        groups[name] = g
        sc.setJobGroup(g, name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    print(f"hot key = 1/3 of {sf_dir}/events rows; {PARTS} reduce partitions; even spread = {100 / PARTS:.1f}%")
    print("| operator | largest share of a reduce stage in one task |")
    print("|---|---|")
    for name, g in groups.items():
        print(f"| {name} | {100 * stage_skew(log_dir, g):.1f}% |")


if __name__ == "__main__":
    main(sys.argv[1:])
