"""Headline timings at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every figure is a full run from the given tables: nothing is cached between
runs, and results go to the no-op sink, so all columns are computed. The tables
are first copied into several files each, as stored data is: a table in a single
file of one row group is read by a single task, whatever runs it.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewlake import queries as registry  # noqa: E402
from reviewlake.plans import medallion  # noqa: E402
from reviewlake.queries import fixtures as fx  # noqa: E402
from reviewlake.session import get_session  # noqa: E402
from reviewlake.sources.layers import write_layer  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = (
    "to_bronze", "to_silver", "agency_performance_kpis", "temporal_sentiment_analysis",
    "risk_alerts", "executive_dashboard", "nps_ranking", "business_metrics_summary",
    "run_stats", "sentiment_share", "pii_anomalies", "bairro_kpis", "layer_summary",
    "rating_sentiment_corr", "benchmark_vs_region", "agency_kpis_daily", "sentiment_trend",
    "monthly_trend", "risk_alerts_full", "unique_branch_metrics", "uniqueness_review",
    "range_violations", "temporal_violations", "orphans_silver_in_bronze", "nav_functions",
    "pii_types_documents", "anonymize_documents", "clean_text_documents", "validate_bairros",
    "has_pending", "compliance_report",
)


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def median(action) -> float:
    action()
    return round(statistics.median(timed(action) for _ in range(RUNS)), 3)


def spread(spark, source: str, target: str, files: int) -> str:
    """The given tables, each of the larger ones in ``files`` files."""
    for path in sorted(glob.glob(f"{source}/*.parquet")):
        rows = spark.read.parquet(path)
        rows.repartition(files if rows.count() >= 1000 * files else 1).write.parquet(
            f"{target}/{os.path.basename(path)}")
    return target


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    with tempfile.TemporaryDirectory(prefix="bench-") as root:
        tables = spread(spark, SF_DIR, f"{root}/tables", 2 * int(CPUS))
        for name in HEADLINES:
            build = registry.QUERIES[name]
            results[name] = median(
                lambda: build(spark, tables).write.format("noop").mode("overwrite").save())

        # The stages of the flow over stored layers, each writing its output.
        results["layer_bronze_write"] = median(
            lambda: write_layer(fx.bronze(spark, tables), root, "bronze"))
        results["layer_bronze_to_silver"] = median(
            lambda: medallion.bronze_to_silver(spark, root, fx.AS_OF))
        results["layer_silver_to_gold"] = median(
            lambda: medallion.silver_to_gold(spark, root, fx.AS_OF))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS), "runs": RUNS,
    }))


if __name__ == "__main__":
    registry.load_all()
    main()
