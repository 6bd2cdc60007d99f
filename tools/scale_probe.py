"""Skewed-scale probe for ingest + integrate (a tool, not a registered query).

    python tools/scale_probe.py ROWS [CPUS]

Generates ROWS trips in a fresh scratch folder with the shapes that break naive
plans: one pickup zone holds a third of the rows, one group of exact copies
holds another third, and a tenth of the rows have a drop-off zone that no
context row matches (a null would break the primary key, which includes it).  Then it
times ``ingest`` (conform, rules, dedup, key, audit, publish) and
``integrate`` (four context joins) and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from quality_lake import bundled_contract
    from quality_lake.plans import ingest, integrate
    from tests.fixtures import write_air_quality, write_weather, write_zones

    work = tempfile.mkdtemp(prefix="run-scale-", dir="/tmp")
    os.makedirs(f"{work}/events")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 4))
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"{work}/events")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.perf_counter()
    i = F.col("id")
    third = rows // 3
    copy = i < third                      # one exact-copy group: a third of the rows
    hot = (i >= third) & (i < 2 * third)  # one pickup zone: another third
    pickup = F.when(copy, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).otherwise(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (i % 7_776_000).cast("decimal(18,6)")))
    trips = spark.range(rows, numPartitions=int(cpus) * 4).select(
        F.when(copy, F.lit(1)).otherwise((i % 2 + 1).cast("int")).alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.expr("INTERVAL 15 MINUTES")).alias("tpep_dropoff_datetime"),
        F.lit(1).cast("long").alias("passenger_count"),
        F.when(copy, F.lit(1.0)).otherwise((i % 1000) / 100.0 + i / 1e9).alias("trip_distance"),
        F.lit(1).cast("long").alias("RatecodeID"), F.lit("N").alias("store_and_fwd_flag"),
        F.when(copy | hot, F.lit(2)).otherwise((i % 8 + 1).cast("int")).alias("PULocationID"),
        F.when(i % 10 == 5, F.lit(999)).otherwise((i % 8 + 1).cast("int")).cast("int").alias("DOLocationID"),
        F.lit(1).cast("long").alias("payment_type"),
        F.lit(10.0).alias("fare_amount"), F.lit(0.5).alias("extra"), F.lit(0.5).alias("mta_tax"),
        F.lit(1.0).alias("tip_amount"), F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.when(copy, F.lit(12.0)).otherwise(12.0 + i / 1e6).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"), F.lit(0.0).alias("Airport_fee"))
    trips.write.parquet(f"{work}/trips/yellow_tripdata_2024-01.parquet")
    gen = time.perf_counter() - t0

    sources = {"taxi": (f"{work}/trips/yellow_tripdata_2024-*.parquet", "taxi_trips"),
               "zones": (write_zones(f"{work}/zones.csv"), "taxi_zone_lookup"),
               "weather": (write_weather(f"{work}/weather.csv"), "weather"),
               "air_quality": (write_air_quality(f"{work}/aq.csv"), "air_quality")}
    timings, records = {}, {}
    for role, (path, contract) in sources.items():
        c = bundled_contract(contract)
        t = time.perf_counter()
        res = ingest(spark, path, c, f"{work}/cleaned/{c.table_name}", stage_counts=(role == "taxi"))
        timings[f"ingest_{role}"] = round(time.perf_counter() - t, 2)
        records[role] = res.stage_rows or res.record["processed_records"]
    tables = {role: spark.read.parquet(f"{work}/cleaned/{bundled_contract(c).table_name}")
              for role, (_, c) in sources.items()}
    t = time.perf_counter()
    metrics = integrate(tables, f"{work}/integrated")
    timings["integrate"] = round(time.perf_counter() - t, 2)
    spark.stop()
    print(json.dumps({"rows": rows, "cpus": int(cpus), "generate_s": round(gen, 2), "timings": timings,
                      "taxi_stages": records["taxi"], "integrated_rows": metrics["rows"],
                      "pickup_matches": metrics["pickup"]["matches"],
                      "heaviest_stages": task_balance(f"{work}/events"), "scratch": work}))


def task_balance(events_dir: str, top: int = 6) -> list[dict]:
    """From the event log: the stages with the most task time, with their task
    count and max / median task duration (a skewed stage has max >> median)."""
    import statistics
    import io

    import zstandard
    durations: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for folder, _, files in os.walk(events_dir):
        for name in files:
            if not name.startswith("events_"):
                continue
            path = os.path.join(folder, name)
            with open(path, "rb") as raw:
                stream = (zstandard.ZstdDecompressor().stream_reader(raw) if name.endswith(".zstd")
                          else raw)
                for line in io.TextIOWrapper(stream, encoding="utf-8"):
                    e = json.loads(line)
                    if e.get("Event") == "SparkListenerStageSubmitted":
                        # the physical operators of the stage, from its RDDs' scopes
                        info, ops = e["Stage Info"], []
                        for rdd in sorted(info.get("RDD Info", []), key=lambda r: r["RDD ID"]):
                            op = json.loads(rdd["Scope"])["name"] if rdd.get("Scope") else ""
                            if op and op not in ops:
                                ops.append(op)
                        names[info["Stage ID"]] = " > ".join(ops)
                    if e.get("Event") == "SparkListenerTaskEnd":
                        info = e["Task Info"]
                        durations.setdefault(e["Stage ID"], []).append(
                            info["Finish Time"] - info["Launch Time"])
    heavy = sorted(durations.items(), key=lambda kv: -sum(kv[1]))[:top]
    return [{"stage": sid, "name": names.get(sid, ""), "tasks": len(d), "total_ms": sum(d),
             "max_ms": max(d), "median_ms": statistics.median(d)} for sid, d in heavy]


if __name__ == "__main__":
    main()
