"""Two-source cohort steered by a codebook."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..model import DatasetSpec, local_table
from ..operators.harmonize import (
    SOURCES,
    codebook_coverage,
    codebook_questions,
    coverage_counts,
    harmonized_merge,
    load_codebook,
)
from ..operators.headers import select_variables, strip_names
from ..operators.merge import HOT_KEY_ROWS
from ..session import stored
from ..sources import write_table
from .tables import MERGE_METRICS_SCHEMA, RunLog, RunResult, curate, new_run_id, write_reports


@dataclass
class CohortResult:
    run: RunResult
    coverage: DataFrame
    counts: DataFrame
    merged: DataFrame


def harmonize_cohort(
    once: DataFrame,
    quince: DataFrame,
    codebook: DataFrame,
    *,
    out_dir: str,
    id_column: str = "patient_id",
    question_name_column: str = "QUESTION_NAME",
    review_column: str = "needs_review",
    order_by: Sequence[str] | None = None,
    sources: tuple[str, str] = SOURCES,
    run_id: str | None = None,
    hot_rows: int = HOT_KEY_ROWS,
) -> CohortResult:
    """Coverage of the codebook, both sources cut to it, their harmonised merge, all three judged."""
    spark = once.sparkSession
    run_id = run_id or new_run_id("cohort")
    root, log = f"{out_dir}/{run_id}", RunLog(spark)
    once, quince = strip_names(once), strip_names(quince)
    if id_column not in once.columns or id_column not in quince.columns:
        raise ValueError(f"patient_id column '{id_column}' must exist in both source datasets")

    loaded = stored(load_codebook(codebook, question_name_column, review_column, order_by))
    questions, review = codebook_questions(loaded, question_name_column, review_column, order_by)
    coverage = codebook_coverage(loaded, once, quince, question_name_column, review_column, sources)
    write_table(coverage, f"{root}/reports/codebook_coverage.parquet")

    views = {s: select_variables(df, id_column, questions) for s, df in zip(sources, (once, quince))}
    tables = {}
    for source, view in views.items():
        name = f"{source}_raw_analysis"
        tables[name], result = curate(view, _spec(name, id_column, view), f"{root}/curated/{name}.parquet")
        log.add_suite(result)
    a, b = (tables[f"{s}_raw_analysis"] for s in sources)
    merged = harmonized_merge(a, b, id_column, questions, review, sources=sources, hot_rows=hot_rows)
    name = "merged_harmonized_analysis"
    tables[name], result = curate(merged, _spec(name, id_column, merged), f"{root}/analytic/{name}.parquet")
    log.add_suite(result)
    none = local_table(spark, [], MERGE_METRICS_SCHEMA)
    run = write_reports(RunResult(run_id, tables, {}, log.step_results(), log.step_issues(), none), out_dir)
    return CohortResult(run, coverage, coverage_counts(coverage, sources), tables[name])


def _spec(dataset_id: str, id_column: str, df: DataFrame) -> DatasetSpec:
    return DatasetSpec(
        dataset_id,
        primary_key=id_column,
        required_columns=[id_column],
        optional_columns=[c for c in df.columns if c != id_column],
    )
