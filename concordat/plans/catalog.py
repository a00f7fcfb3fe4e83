"""Variable catalog as a run: build, write, summarise."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from ..model import local_table
from ..operators.catalog import build_catalog, catalog_summary
from ..sources import write_table
from .tables import MERGE_METRICS_SCHEMA, RunLog, RunResult, _now, new_run_id, write_reports


@dataclass
class CatalogResult:
    run: RunResult
    catalog: DataFrame
    summary: DataFrame


def run_catalog(variables: DataFrame, *, out_dir: str, run_id: str | None = None, **options: Any) -> CatalogResult:
    """Write the catalog, then summarise it from the written columns."""
    spark, started_at = variables.sparkSession, _now()
    run_id = run_id or new_run_id("catalog")
    log = RunLog(spark)
    built = build_catalog(variables, **options)
    path = f"{out_dir}/{run_id}/curated/variable_catalog.parquet"
    write_table(built, path)
    catalog = spark.read.schema(built.schema).parquet(path)
    # six rows
    totals = [tuple(row) for row in catalog_summary(catalog).collect()]
    summary = local_table(spark, totals, "metric string, value long")
    log.add_step("variable_catalog_build", "variable_catalog", [], dict(totals), started_at, {"catalog": path})
    none = local_table(spark, [], MERGE_METRICS_SCHEMA)
    run = write_reports(
        RunResult(run_id, {"variable_catalog": catalog}, {}, log.step_results(), log.step_issues(), none), out_dir
    )
    return CatalogResult(run, catalog, summary)
