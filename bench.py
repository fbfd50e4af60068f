"""Benchmark: batch refresh time of the maintained tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (every row is produced, nothing
is collected), once to warm up and then ``BENCH_REPEAT`` times; the per-query figure is
the median. With ``BENCH_STREAM=1`` (default) the stream-static refresh of Q6 and Q3 is
also timed as rows/s, and with ``BENCH_LANDED=1`` (default) the landed-table refresh of Q6,
Q3 and Q5b (rows/s). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bankroll.catalog import run_query  # noqa: E402
from bankroll.session import get_session  # noqa: E402

HEADLINE = ["q1", "q2", "q3", "q3r", "q4", "q5a", "q5b", "q5", "q6", "d6"]
STREAMED = ["q6", "q3"]
STREAM_FILES = 8


def stream_rates(spark, sf_dir: str) -> dict[str, float]:
    """Rows/s of the stream-static refresh: the transactions are published once as wire
    records (Parquet, ``STREAM_FILES`` files) and consumed one file per micro-batch."""
    from pyspark.sql import functions as F

    from bankroll.session import scratch_dir
    from bankroll.sources import records, testdata
    from bankroll.streaming import stream_static
    from bankroll.streaming.sources import read_stream

    t = testdata.tables(spark, sf_dir)
    src = scratch_dir(spark, "bench-src")
    wire = records.encode(t["transaction"], "transaction").withColumn("seq", F.lit(0).cast("long"))
    wire.repartition(STREAM_FILES).write.parquet(src)
    n = spark.read.parquet(src).count()
    dims = {k: t[k].select(*[F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c)
                             for c in t[k].columns]) for k in ("account", "branch")}
    rates = {}
    for name in STREAMED:
        out = scratch_dir(spark, f"bench-{name}")
        t0 = time.perf_counter()
        q = stream_static.start(name, read_stream(spark, src, "transaction", fmt="parquet",
                                                  max_files_per_trigger=1),
                                dims, out, f"{out}_ckpt", available_now=True, watermark=None)
        q.awaitTermination()
        rates[f"stream_{name}_rows_per_sec"] = round(n / (time.perf_counter() - t0), 1)
    return rates


def landed_rate(spark, sf_dir: str) -> dict[str, float]:
    """Rows/s of the landed-table refresh of three aggregates: transactions published as 4
    wire files, dimension changelogs as one file each, one file per source and batch."""
    from pyspark.sql import functions as F

    from bankroll.session import scratch_dir
    from bankroll.sources import records, testdata
    from bankroll.streaming.landed import LandedRefresh

    t = testdata.tables(spark, sf_dir)
    # the test tables lack two required contract columns: publish a fixed value
    tables = {"transaction": t["transaction"],
              "account": t["account"].withColumn("account_type", F.lit("Savings")),
              "branch": t["branch"],
              "employee": t["employee"].withColumn("hire_date", F.lit("2015-01-01").cast("date"))}
    root = scratch_dir(spark, "bench-landed")
    src = {k: f"{root}/src/{k}" for k in tables}
    for k, df in tables.items():
        (records.encode(df, k).withColumn("seq", F.lit(0).cast("long"))
         .repartition(4 if k == "transaction" else 1).write.parquet(src[k]))
    n = spark.read.parquet(src["transaction"]).count()
    t0 = time.perf_counter()
    q = LandedRefresh(spark, f"{root}/state", results=("q3", "q5b", "q6"), check_ids=False).start(src, fmt="parquet", max_files_per_trigger=1,
                                                     available_now=True)
    q.awaitTermination()
    return {"landed_rows_per_sec": round(n / (time.perf_counter() - t0), 1)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="bankroll-bench", shuffle_partitions=2 * cpus,
                        extra_conf={"spark.driver.memory": os.environ.get("BENCH_MEM", "8g")})
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            run_query(spark, name, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms caches and the JIT
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    extra = stream_rates(spark, sf_dir) if os.environ.get("BENCH_STREAM", "1") == "1" else {}
    if os.environ.get("BENCH_LANDED", "1") == "1":
        extra.update(landed_rate(spark, sf_dir))
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "batch_refresh_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "repeat": repeat, **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
