"""Headline timings: the star build, then the read side; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default all) choose data and cores. The
build is timed once, from a warm session; each query is the better of two runs, the first of which
pays for code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.context import build_context, lay_out  # noqa: E402
from tallystar.operators import quality  # noqa: E402
from tallystar.plans import measures, queries, views  # noqa: E402
from tallystar.storage import run_dir  # noqa: E402

INDICATOR, STATE, YEAR = 3, "NATION_3", 1998

QUERIES = {
    "national_view": lambda s: views.national(s),
    "series_of_one_indicator": lambda s: queries.temporal(s, INDICATOR),
    "state_ranking_one_indicator_year": lambda s: queries.ranking_of_states(s, INDICATOR, YEAR),
    "direct_fact_query": lambda s: queries.kpis(s, jurisdiction="F"),
    "municipalities_one_state_one_indicator": lambda s: queries.by_municipality(s, INDICATOR, state=STATE).rows,
    "state_view": lambda s: views.by_state(s),
    "municipality_view": lambda s: views.by_municipality(s),
    "municipality_ranking": lambda s: views.municipality_ranking(s),
    "monthly_metrics": lambda s: views.monthly_metrics(s),
    "deviation_from_history": lambda s: views.deviation_from_history(s),
    "weight_percentiles": lambda s: views.weight_percentiles(s),
    "outlier_impact": lambda s: views.outlier_impact(s),
    "kpis_by_state_and_year": lambda s: measures.core(s, ["state", "year"]),
    "year_over_year": lambda s: queries.year_over_year(s, INDICATOR),
    "not_reported": lambda s: views.quality_not_reported(s),
    "quality_checks": lambda s: quality.run_checks(s.raw, s.staging, s.fact, s.dims),
    "reconciliation": lambda s: quality.reconcile(s.raw, s.staging, s.fact, s.dim("indicator")),
}


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "*")
    partitions = cpus if cpus.isdigit() else str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.range(1000).selectExpr("sum(id)").collect()

    root = run_dir(spark, "bench")
    started = time.perf_counter()
    paths = lay_out(spark, folder, root)
    laid_out = time.perf_counter()
    star = build_context(spark, folder, root, paths).star
    times = {"lay_out_feed": laid_out - started, "build_star": time.perf_counter() - laid_out}
    for name, query in QUERIES.items():
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            query(star).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = min(runs)
    print(
        json.dumps(
            {
                "metric": "star build and read queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "fact_rows": star.fact.count(),
            }
        )
    )


if __name__ == "__main__":
    main()
