"""Report tables over findings, steps and merge metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..model import ERROR, WARNING


def issues_of(issues: DataFrame, severity: str) -> DataFrame:
    return issues.filter(F.upper("severity") == severity.upper())


def counts_by_stage(step_results: DataFrame) -> DataFrame:
    """Steps executed and failed and findings, per dataset (or step, where it has no dataset)."""
    stage = F.coalesce(F.when(F.col("dataset_id") != "", F.col("dataset_id")), F.col("step_name"))
    return step_results.groupBy(stage.alias("stage")).agg(
        F.count(F.lit(1)).alias("executed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("issue_count").alias("issues"),
    )


def run_summary(step_results: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: a run succeeds when it has no ERROR."""
    steps = step_results.select(F.lit("STEP").alias("kind"))
    counted = steps.unionByName(issues.select(F.upper("severity").alias("kind"))).agg(
        F.count_if(F.col("kind") == "STEP").alias("validations_executed"),
        F.count_if(F.col("kind") == ERROR).alias("error_count"),
        F.count_if(F.col("kind") == WARNING).alias("warning_count"),
    )
    return counted.select((F.col("error_count") == 0).alias("success"), "*")


def exclusion_totals(merge_metrics: DataFrame) -> DataFrame:
    return merge_metrics.agg(
        F.coalesce(F.sum("left_only_count"), F.lit(0)).alias("left_only_total"),
        F.coalesce(F.sum("right_only_count"), F.lit(0)).alias("right_only_total"),
    )
