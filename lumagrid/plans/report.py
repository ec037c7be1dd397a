"""From run logs to the report table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumagrid.operators.runs import run_summary, run_verdicts, with_speedup
from lumagrid.sources.reports import log_runs, scan_run_log


def run_report(
    spark: SparkSession,
    path: str,
    sep: str,
    base: str,
    variant: str,
    verdict: str | None = None,
) -> DataFrame:
    """Mean, median, least and largest timings and speedup per section of the logs in ``path``.

    ``base``, ``variant`` and ``verdict`` are column titles of the log's tables.
    """
    columns = {"base": base, "variant": variant}
    if verdict is not None:
        columns["verdict"] = verdict
    runs = with_speedup(log_runs(scan_run_log(spark, path, sep), columns), "base", "variant")
    report = run_summary(runs, "section", ["base", "variant", "ratio"], medians=["ratio"])
    return report if verdict is None else report.join(run_verdicts(runs), "section")
