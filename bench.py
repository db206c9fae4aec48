"""Benchmark: load the warehouse from the test tables, then run every
analytical query over it; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martflow.plans import olap  # noqa: E402
from martflow.plans.warehouse import Warehouse, build_warehouse  # noqa: E402
from martflow.session import build_session, shared_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          app_name="martflow-bench")
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")

    # Warm-up (untimed): the whole pipeline once on the smallest data set, so
    # the timings below measure steady-state work, not JIT compilation.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = os.environ.get("BENCH_WARMUP", "1") == "1" and os.path.isdir(warm_dir)
    if warm:
        wwh = Warehouse(spark, f"{shared_dir(spark)}/martflow/bench-warm-{uuid.uuid4().hex[:12]}")
        build_warehouse(wwh, warm_dir)
        for fn in olap.QUERIES.values():
            fn(wwh).write.format("noop").mode("overwrite").save()
    spark.read.parquet(f"{sf_dir}/region.parquet").collect()

    timings: dict[str, float] = {}
    root = f"{shared_dir(spark)}/martflow/bench-{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, root)
    t0 = time.perf_counter()
    build_warehouse(wh, sf_dir)
    timings["etl_load"] = round(time.perf_counter() - t0, 3)

    rows = {}
    # Exact dimension sizes (from the manifest), used by every query's broadcast
    # decision; timed on its own.
    t0 = time.perf_counter()
    wh.row_count("dim_customer")
    timings["dim_sizes"] = round(time.perf_counter() - t0, 3)
    for name, fn in olap.QUERIES.items():
        # Each query is executed completely (every result row produced) into
        # the no-op sink; an Observation counts the rows on the way.
        t0 = time.perf_counter()
        obs = Observation(name)
        fn(wh).observe(obs, F.count(F.lit(1)).alias("n")).write.format("noop") \
            .mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        rows[name] = obs.get["n"]

    total = round(sum(timings.values()), 3)

    # Extra (not in the headline value): the same feed delivered as CSV files
    # and loaded by the Structured Streaming ingest, in four micro-batches or more.
    extra = {}
    fact_rows = wh.row_count("fact_sales") or 0
    extra["fact_rows"] = fact_rows
    extra["load_rows_per_sec"] = round(fact_rows / timings["etl_load"]) if timings["etl_load"] else 0
    if os.environ.get("BENCH_STREAM", "1") == "1":
        from martflow.plans.etl_queries import delivered_files, micro_batch_bytes
        from martflow.sources import testdata
        from martflow.sources.csv_files import write_transaction_files
        from martflow.sources.feed import Feed
        from martflow.streaming.ingest import run_ingest
        sroot = f"{root}-stream"
        files = delivered_files(spark, sf_dir)
        t0 = time.perf_counter()
        write_transaction_files(testdata.transactions(spark, sf_dir), f"{sroot}/drop", files)
        extra["stream_deliver_csv"] = round(time.perf_counter() - t0, 3)
        masters = Feed(transactions=None, customers=testdata.customers(spark, sf_dir),
                       products=testdata.products(spark, sf_dir),
                       suppliers=testdata.suppliers(spark, sf_dir),
                       master_rows=testdata.master_rows(spark, sf_dir))
        swh = Warehouse(spark, f"{sroot}/warehouse")
        t0 = time.perf_counter()
        totals = run_ingest(spark, swh, f"{sroot}/drop", masters, f"{sroot}/checkpoint",
                            max_bytes_per_trigger=micro_batch_bytes(spark, f"{sroot}/drop"), lines=True, product_type="bigint")
        extra["stream_ingest"] = round(time.perf_counter() - t0, 3)
        extra["stream_micro_batches"] = totals["micro_batches"]
        extra["stream_rows"] = totals["fact_rows"]
        extra["stream_rows_per_sec"] = round(extra["stream_rows"] / extra["stream_ingest"])
    print(json.dumps({
        "metric": "etl_load_plus_all_queries",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "extra": extra,
        "sf": sf,
        "cpus": cpus,
        "jvm": "warm (one untimed pass on the smallest data set)" if warm else "cold",
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
