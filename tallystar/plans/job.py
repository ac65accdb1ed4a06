"""The end-to-end run: feeds in, star, checks and summary out.

    spark-submit -m tallystar.plans.job --feed 2030=/data/2030 --feed 2031=/data/2031 --out /warehouse/run
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.errors import ContractError
from tallystar.operators import quality
from tallystar.operators.facts import not_reported
from tallystar.operators.staging import require_same_rows
from tallystar.plans import views
from tallystar.plans.publish import publish
from tallystar.plans.star import Star, write_star
from tallystar.reference import Reference, default_reference
from tallystar.sources import tables
from tallystar.sources.raw import read_feed


@dataclass(frozen=True)
class Outcome:
    star: Star
    summary: dict
    passed: bool


def quality_results(star: Star) -> dict[str, DataFrame]:
    """The result sets of a run: layer counts, checks, not-reported table, reconciliation, constraints.

    Layers that were counted while they were written are not read again for their counts.
    """
    layers = {"raw": star.raw, "staging": star.staging, "grain": star.grain, "fact": star.fact}
    return {
        "layer_counts": quality.known_counts(star.spark, star.counts) if star.counts else quality.layer_counts(layers),
        "checks": quality.run_checks(star.raw, star.staging, star.fact, star.dims, star.counts).unionByName(
            quality.check_source_year(star.grain)
        ),
        "not_reported": not_reported(star.grain, star.dim("indicator")),
        "reconciliation": quality.reconcile(star.raw, star.staging, star.fact, star.dim("indicator")),
        "constraints": quality.constraint_violations(star.fact, star.dims),
    }


def run_summary(star: Star) -> DataFrame:
    """One row: layer counts, coverage and the partial years."""
    time_dim = star.dim("time").agg(
        F.struct(
            F.min("ref_month").alias("first_month"),
            F.max("ref_month").alias("last_month"),
            F.array_sort(F.collect_set(F.when(F.col("is_partial_year"), F.col("year")))).alias("partial_years"),
        )
    )
    place = star.dim("place").agg(
        F.struct(F.count_distinct("state").alias("states"), F.count_distinct("municipality").alias("municipalities"))
    )

    def rows(layer: str):
        known = (star.counts or {}).get(layer)
        return getattr(star, layer).agg(F.count("*")).scalar() if known is None else F.lit(known).cast("bigint")

    return (
        star.spark.range(1)
        .withColumns(
            {
                "staging_rows": rows("staging"),
                "grain_rows": rows("grain"),
                "fact_rows": rows("fact"),
                "indicators": F.lit(len(star.lookup.indicators)).cast("bigint"),
                "_place": place.scalar(),
                "_time": time_dim.scalar(),
            }
        )
        .select("staging_rows", "grain_rows", "fact_rows", "indicators", "_place.*", "_time.*")
    )


def run(
    raw: Mapping[int, DataFrame] | DataFrame, reference: Reference, out: str, database: str | None = None
) -> Outcome:
    """Build and write the star, then its result sets; a failed warehouse load does not fail the run."""
    started = time.monotonic()
    star = write_star(raw, reference, f"{out}/star")
    results = {}
    for name, df in quality_results(star).items():
        tables.write_table(df, f"{out}/quality/{name}")
        results[name] = tables.read_table(star.spark, f"{out}/quality/{name}")
    counts = {row.layer: row.row_count for row in results["layer_counts"].collect()}
    require_same_rows(counts["raw"], counts["staging"])

    warehouse = "not asked for"
    if database is not None:
        try:
            publish(star, f"{out}/star", database)
            warehouse = "OK"
        except Exception as problem:  # the written files stay valid whatever the target does
            warehouse = f"FAILED: {problem}"

    checks = quality.tally(results["checks"]).first()
    reconciled = quality.tally(results["reconciliation"]).first()
    violated = results["constraints"].where(F.col("violations") > 0).count()
    summary = run_summary(star).first().asDict() | {
        "raw_rows": counts["raw"],
        "checks_passed": checks.passed,
        "checks_total": checks.checked,
        "reconciled_passed": reconciled.passed,
        "reconciled_total": reconciled.checked,
        "constraints_violated": violated,
        "warehouse": warehouse,
        "elapsed_minutes": round((time.monotonic() - started) / 60, 1),
    }
    return Outcome(star, summary, checks.failed == 0 and reconciled.failed == 0 and violated == 0)


def require_passed(outcome: Outcome) -> None:
    if not outcome.passed:
        raise ContractError(f"the run did not pass its checks: {outcome.summary}")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--feed", action="append", required=True, metavar="YEAR=PATH")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv", "orc", "json"))
    parser.add_argument("--out", required=True)
    parser.add_argument("--database")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tallystar").getOrCreate()
    paths = {int(year): path for year, path in (feed.split("=", 1) for feed in options.feed)}
    outcome = run(read_feed(spark, paths, options.format), default_reference(spark), options.out, options.database)
    views.register_views(spark, outcome.star)
    print(outcome.summary)
    require_passed(outcome)


if __name__ == "__main__":
    main()
