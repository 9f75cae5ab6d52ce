"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs twice and
the second, warm run counts, as the published latencies are those of warm stores. Results
are produced in full and discarded. The document and wide queries run on stored models, whose
building is timed as well; ``batch_*`` answers 500 lookups in one job.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import adapters as a  # noqa: E402
from reshelve.operators.document import nest_documents  # noqa: E402
from reshelve.operators.prepare import enrich  # noqa: E402
from reshelve.operators.wide import to_wide  # noqa: E402
from reshelve.plans import batch, document, latency, relational, wide  # noqa: E402
from reshelve.session import build_session  # noqa: E402
from reshelve.sinks.documents import write_documents  # noqa: E402
from reshelve.sinks.wide import write_wide  # noqa: E402
from reshelve.sources.stores import read_documents, read_wide  # noqa: E402

LOOKUPS = 500


def spend(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_seconds(action) -> float:
    seconds = 0.0
    for _ in range(2):
        started = time.perf_counter()
        action()
        seconds = time.perf_counter() - started
    return round(seconds, 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    tables = a.source_tables(spark, folder)
    log = a.request_log(spark, folder)
    customers = tables["customer"].count()
    params = batch.parameters(spark, LOOKUPS, customers)

    with tempfile.TemporaryDirectory(prefix="bench-") as work:
        enriched_path = f"{work}/enriched"
        documents_path, wide_path = f"{work}/documents", f"{work}/wide"
        queries: dict[str, float] = {}

        def measure(name, action):
            queries[name] = warm_seconds(action)

        measure("build_enriched",
                lambda: enrich(tables).write.mode("overwrite").parquet(enriched_path))
        enriched = spark.read.parquet(enriched_path)
        measure("build_documents",
                lambda: write_documents(nest_documents(enriched), documents_path))
        measure("build_wide",
                lambda: write_wide(to_wide(enriched), wide_path, truncate=True, buckets=8))
        docs = read_documents(spark, documents_path)
        rows = read_wide(spark, wide_path)

        headline = {
            "r1": lambda: relational.r1(tables), "r2": lambda: relational.r2(tables),
            "r2_summary": lambda: relational.r2_summary(tables),
            "r3": lambda: relational.r3(tables), "r4": lambda: relational.r4_count(tables),
            "r5": lambda: relational.r5(tables),
            "d1": lambda: document.d1(docs), "d2": lambda: document.d2(docs),
            "d3": lambda: document.d3(docs), "d4": lambda: document.d4_count(docs),
            "d5": lambda: document.d5(docs),
            "k1": lambda: wide.k1(rows), "k2": lambda: wide.k2_summary(rows),
            "k3": lambda: wide.k3(rows), "k4": lambda: wide.k4(rows), "k5": lambda: wide.k5(rows),
            "batch_r1": lambda: batch.r1(params, tables),
            "batch_r2": lambda: batch.r2(params, tables),
            "batch_r3": lambda: batch.r3(params, tables),
            "batch_r4": lambda: batch.r4(params, tables),
            "batch_r5": lambda: batch.r5(params, tables),
            "batch_d1": lambda: batch.d1(params, docs), "batch_d2": lambda: batch.d2(params, docs),
            "batch_d3": lambda: batch.d3(params, docs), "batch_d4": lambda: batch.d4(params, docs),
            "batch_d5": lambda: batch.d5(params, docs),
            "batch_k1": lambda: batch.k1(params, rows), "batch_k2": lambda: batch.k2(params, rows),
            "batch_k3": lambda: batch.k3(params, rows), "batch_k4": lambda: batch.k4(params, rows),
            "batch_k5": lambda: batch.k5(params, rows),
            "lookup_r1": lambda: relational.r1(tables, 7),
            "lookup_r2": lambda: relational.r2(tables, 7),
            "lookup_r3": lambda: relational.r3(tables, 7),
            "lookup_d1": lambda: document.d1(docs, 7), "lookup_d2": lambda: document.d2(docs, 7),
            "lookup_d3": lambda: document.d3(docs, 7),
            "lookup_d5": lambda: document.d5(docs, 100, 110),
            "lookup_k1": lambda: wide.k1(rows, 7), "lookup_k2": lambda: wide.k2(rows, 7),
            "lookup_k3": lambda: wide.k3(rows, 7), "lookup_k4": lambda: wide.k4(rows, 7),
            "lookup_k5": lambda: wide.k5(rows, 7),
            "log_rollup": lambda: latency.rollup(log),
            "log_statistics": lambda: latency.statistics(log),
            "log_apdex": lambda: latency.apdex(log),
            "log_percentile_curve": lambda: latency.percentile_curve(log),
            "log_percentiles_over_time": lambda: latency.percentiles_over_time(log, a_day),
            "log_median_by_load": lambda: latency.median_by_load(log, "elapsed", a_day // 24),
        }
        a_day = 86_400_000
        for name, query in headline.items():
            measure(name, lambda query=query: spend(query()))

    lookups = {name: round(LOOKUPS / seconds, 1) for name, seconds in queries.items()
               if name.startswith("batch_")}
    spark.stop()
    print(json.dumps({
        "metric": "total warm seconds of the headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "lookups_per_second": lookups,
        "sf": folder.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
