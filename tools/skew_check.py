"""Skew check: one key holds a third of all rows.  Runs the fact
de-duplication, the gold aggregate and the SCD2 source stage, then reads
per-task shuffle-read record counts from Spark's event log (written to a
fresh scratch folder) and prints the largest share any single reduce task
received.  Usage: python tools/skew_check.py [rows]"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.config import build_session  # noqa: E402
from strata.operators import build_daily_product_sales, stage_source, transform_fact_orders  # noqa: E402
from strata.sinks.writers import export_landing  # noqa: E402


def read_events(log_dir: str) -> list[dict]:
    events = []
    for path in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*.*")):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        events += [json.loads(line) for line in raw.decode().splitlines() if line]
    return events


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 300_000
    log_dir = tempfile.mkdtemp(prefix="strata-skew-")
    spark = build_session("local[8]", 16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # scaled down with the data: the hot day is then many advisory sizes
        # large, as a third of a day's data is on a cluster
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    })
    hot = F.col("id") % 3 == 0  # a third of all rows share one key
    base = spark.range(0, n, 1, 16)
    orders = base.select(
        F.to_date(F.lit("2026-02-20")).alias("dt"),
        F.when(hot, F.lit("O-HOT")).otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").cast("timestamp").alias("order_ts"),
        (F.col("id") % 1000).cast("string").alias("customer_id"),
        F.when(hot, F.lit("P-HOT")).otherwise((F.col("id") % 5000).cast("string")).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(2.5).alias("unit_price"),
        F.to_timestamp(F.lit("2026-02-21 06:00:00")).alias("ingest_ts"),
    )
    fact_in = base.select(
        F.to_date(F.lit("2026-02-20")).alias("dt"), F.col("id").cast("string").alias("order_id"),
        (F.col("id") % 1000).cast("string").alias("customer_id"),
        F.when(hot, F.lit("P-HOT")).otherwise((F.col("id") % 5000).cast("string")).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(1).cast("decimal(18,2)").alias("order_amount"),
    )
    dim = spark.range(5000).select(F.col("id").cast("string").alias("product_id"), F.lit("c").alias("category"))
    stg = base.select(
        F.when(hot, F.lit("C-HOT")).otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit("n").alias("full_name"), F.lit("e").alias("email"), (F.col("id") % 7).cast("string").alias("city"),
        F.col("id").cast("timestamp").alias("updated_at"), F.to_timestamp(F.lit("2026-02-21 06:00:00")).alias("ingest_ts"),
    )
    jobs = {
        "fact dedupe (hot order_id)": transform_fact_orders(orders),
        "gold aggregate (hot product)": build_daily_product_sales(fact_in, dim),
        "scd2 source (hot customer)": stage_source(stg, "customer_id", ["full_name", "email", "city"], ["updated_at", "ingest_ts"]),
    }
    groups = {}
    for name, df in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    landing = base.select(
        F.col("id").cast("string").alias("order_id"), F.lit("2026-02-20 09:00:00").alias("order_ts"),
        F.lit("C1").alias("customer_id"), F.lit("P1").alias("product_id"), F.lit("1").alias("quantity"),
        F.lit("1.0").alias("unit_price"),
        F.when(hot, F.to_date(F.lit("2026-02-20"))).otherwise(F.date_add(F.to_date(F.lit("2025-01-01")), (F.col("id") % 97).cast("int"))).alias("dt"),
    )
    spark.sparkContext.setJobGroup("landing export (hot day)", "landing export (hot day)")
    export_landing(landing, tempfile.mkdtemp(prefix="strata-skew-landing-"), "orders")
    spark.stop()

    stage_group, task_reads = {}, {}
    for e in read_events(log_dir):
        if e["Event"] == "SparkListenerStageSubmitted":
            props = e.get("Properties") or {}
            stage_group[e["Stage Info"]["Stage ID"]] = props.get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            recs = m.get("Total Records Read", 0)
            if recs:
                task_reads.setdefault(e["Stage ID"], []).append(recs)
    for stage, reads in task_reads.items():
        g = stage_group.get(stage)
        if not g:
            continue
        mean = sum(reads) / len(reads)
        worst = groups.get(g)
        if worst is None or max(reads) > worst["max_task_records"]:
            groups[g] = {
                "max_task_records": max(reads),
                "share_of_rows": round(max(reads) / n, 4),
                "stage_records": sum(reads),
                "max_over_mean_task": round(max(reads) / mean, 2),
            }
    print(json.dumps({"rows": n, "hot_share": round(1 / 3, 4), "jobs": groups}))

if __name__ == "__main__":
    main()
