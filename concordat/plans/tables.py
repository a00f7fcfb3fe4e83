"""Validate and curate a set of tables, then run the merge plan over them."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..model import ERROR, STEP_ISSUE_SCHEMA, STEP_SCHEMA, DatasetSpec, MergeStep, issue, local_table
from ..operators.checks import SuitePlan, SuiteResult, step_row, suite_result
from ..operators.headers import HeaderMapping, clean_base_table, domain_views, map_headers
from ..operators.merge import INDICATOR, MOST_ROWS, absent_keys, perform_merge
from ..operators.reports import counts_by_stage, exclusion_totals, run_summary
from ..session import settings
from ..sources import read_table_from_spec, validate_file_input, write_table


# Partition folders that begin with an underscore are hidden from many readers.
ORIGIN_PARTITION = "merge_origin"
# Fixed value: the step that maps the headers of a wide export.
NORMALIZATION_STEP = "single_workbook_normalization"

MERGE_METRICS_SCHEMA = (
    "step_name string, left_rows long, right_rows long, merged_rows long, both_count long, left_only_count long, "
    "right_only_count long, match_rate_against_left double, unmatched_left long, unmatched_right long, "
    "unexpected_duplication long, observed_cardinality string, expected_cardinality string, "
    "cardinality_matches_expectation boolean, max_key_fanout long"
)

INVALID_VALUES_SCHEMA = "dataset_id string, column_name string, value string, failing_rows long"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{_now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


@dataclass
class RunLog:
    """Steps and findings of a run, as the few plain rows they are."""

    spark: SparkSession
    steps: list[tuple] = field(default_factory=list)
    findings: list[tuple] = field(default_factory=list)

    def add_suite(self, result: SuiteResult) -> None:
        self.steps += result.step_rows
        self.findings += [(step, *row) for step, row in result.finding_rows]

    def add_step(
        self,
        step_name: str,
        dataset_id: str,
        issues: Sequence[tuple],
        metrics: Mapping[str, Any],
        started_at: dt.datetime,
        artifacts: Mapping[str, str] | None = None,
    ) -> None:
        self.steps.append(step_row(step_name, dataset_id, issues, metrics, started_at, artifacts))
        self.findings += [(step_name, *row) for row in issues]

    def step_results(self) -> DataFrame:
        return local_table(self.spark, self.steps, STEP_SCHEMA)

    def step_issues(self) -> DataFrame:
        return local_table(self.spark, self.findings, STEP_ISSUE_SCHEMA)


@dataclass
class WrittenMerge:
    """A merge as written: one table, partitioned by the origin of its rows."""

    path: str
    written: DataFrame

    @property
    def merged(self) -> DataFrame:
        return self.written.withColumnRenamed(ORIGIN_PARTITION, INDICATOR)

    @property
    def table(self) -> DataFrame:
        return self.written.drop(ORIGIN_PARTITION)

    @property
    def left_only(self) -> DataFrame:
        return self.written.filter(F.col(ORIGIN_PARTITION) == "left_only").drop(ORIGIN_PARTITION)

    @property
    def right_only(self) -> DataFrame:
        return self.written.filter(F.col(ORIGIN_PARTITION) == "right_only").drop(ORIGIN_PARTITION)


@dataclass
class RunResult:
    run_id: str
    tables: dict[str, DataFrame]
    merges: dict[str, WrittenMerge]
    step_results: DataFrame
    step_issues: DataFrame
    merge_metrics: DataFrame
    invalid_values: dict[str, DataFrame] = field(default_factory=dict)
    written_to: str | None = None

    @property
    def issues(self) -> DataFrame:
        return self.step_issues.drop("step_name", "run_id")

    def invalid_value_report(self) -> DataFrame:
        """Every value outside its list, of all tables of the run."""
        empty = local_table(self.step_results.sparkSession, [], INVALID_VALUES_SCHEMA)
        found = [t.select(F.lit(name).alias("dataset_id"), "*") for name, t in self.invalid_values.items()]
        return reduce(DataFrame.unionByName, found, empty)

    def summary(self) -> DataFrame:
        return run_summary(self.step_results, self.step_issues)

    def counts_by_stage(self) -> DataFrame:
        return counts_by_stage(self.step_results)

    def exclusions(self) -> DataFrame:
        return exclusion_totals(self.merge_metrics)


def curate(
    df: DataFrame,
    spec: DatasetSpec,
    path: str,
    *,
    as_of: dt.date | None = None,
    strict_nulls: bool = False,
    invalid_path: str | None = None,
) -> tuple[DataFrame, SuiteResult]:
    """Cast a table, write it and judge it, reading the source once.

    With ``invalid_path`` the values outside their lists are written there and counted from what was written. The counts ride along with the write; keys and value lists are then read from the columns of
    the written table. Every observed operator sits in the writing stage, so a task that runs again
    is not counted twice.
    """
    started_at = _now()
    plan = SuitePlan(df, spec, as_of, strict_nulls, coerce=True)
    observation = Observation(f"{spec.dataset_id}_{uuid.uuid4().hex[:8]}")
    table = plan.curated(plan.prepared.observe(observation, *plan.aggregates()))
    write_table(table, path)
    counts = observation.get
    curated = df.sparkSession.read.schema(table.schema).parquet(path)
    written = SuitePlan(curated, spec, as_of, strict_nulls, coerce=False)
    invalid = written.invalid_values()
    if invalid_path is not None:
        invalid = df.sparkSession.read.schema(invalid.schema).parquet(write_table(invalid, invalid_path))
    return curated, suite_result(plan, counts, written.key_counts(), invalid, written.invalid_counts(invalid), started_at)


def wide_export_domains(
    export: DataFrame,
    mapping: Mapping[str, Any],
    *,
    staging_path: str,
    id_column: str | None = "patient_id",
    fail_fast: bool = False,
) -> tuple[dict[str, DataFrame], HeaderMapping]:
    """Clean a wide export, map its headers and split it into domain tables.

    The mapped table is written once; each domain then reads only its own columns of it.
    """
    spark = export.sparkSession
    mapped = map_headers(clean_base_table(export, id_column), mapping)
    if fail_fast and not mapped.succeeded:
        raise ValueError("Wide export normalization failed: " + "; ".join(r.message for r in mapped.issues.collect()))
    write_table(mapped.table, staging_path)
    staged = spark.read.schema(mapped.table.schema).parquet(staging_path)
    return domain_views(staged, mapped.domains), mapped


def merge_and_write(
    tables: Mapping[str, DataFrame], steps: Sequence[MergeStep], out_dir: str, log: RunLog, row_budget: int = MOST_ROWS
) -> tuple[dict[str, WrittenMerge], DataFrame]:
    """Run an ordered merge plan; every result is written before a later step reads it."""
    spark, working = log.spark, dict(tables)
    written: dict[str, WrittenMerge] = {}
    rows: list[tuple] = []
    for step in steps:
        started_at = _now()
        absent = [name for name in (step.left, step.right) if name not in working]
        if absent:
            row = issue(step.name, "merge", "missing_input_table", ERROR, f"Tables not available: {absent}")
            log.add_step(f"{step.name}_merge", step.name, [row], {}, started_at)
            continue
        left, right = working[step.left], working[step.right]
        if any(key not in left.columns or key not in right.columns for key in step.on):
            raise KeyError("; ".join(row[4] for row in absent_keys(left, right, step.on, step.name)))
        if ORIGIN_PARTITION in {c.lower() for c in (*left.columns, *right.columns)}:
            raise ValueError(f"Step {step.name}: rename column {ORIGIN_PARTITION!r}, which names the origin of merged rows")
        result = perform_merge(left, right, step.how, list(step.on), step.name, step.expected_relationship, row_budget=row_budget)
        if result.refused:  # the audit says so
            log.add_step(f"{step.name}_merge", step.name, result.findings(), result.metrics_row, started_at)
            rows.append((step.name, *result.metrics_row.values()))
            continue
        path = f"{out_dir}/{step.name}.parquet"
        table = result.merged.withColumnRenamed(INDICATOR, ORIGIN_PARTITION)
        with settings(spark, result.write_settings()):
            write_table(table, path, partition_by=[ORIGIN_PARTITION])
        written[step.name] = WrittenMerge(path, spark.read.schema(table.schema).parquet(path))
        working[step.name] = written[step.name].table
        log.add_step(
            f"{step.name}_merge_key_validation", step.name, result.key_findings(), result.null_keys, started_at
        )
        log.add_step(
            f"{step.name}_merge", step.name, result.findings(), result.metrics_row, started_at, {"merged": path}
        )
        rows.append((step.name, *result.metrics_row.values()))
    return written, local_table(spark, rows, MERGE_METRICS_SCHEMA)


def curate_and_merge(
    spark: SparkSession,
    specs: Sequence[DatasetSpec],
    steps: Sequence[MergeStep] = (),
    *,
    out_dir: str,
    tables: Mapping[str, DataFrame] | None = None,
    normalization: HeaderMapping | None = None,
    run_id: str | None = None,
    as_of: dt.date | None = None,
    strict_nulls: bool = False,
    fail_fast: bool = False,
    hash_inputs: bool = True,
    row_budget: int = MOST_ROWS,
) -> RunResult:
    """Judge, cast and write each table, then merge them by plan and write the reports.

    A merge that its audit counts ``row_budget`` rows or more for is not run; the finding says so.
    ``tables`` stands in for the files of the specs it names (the domains of a wide export). ``normalization`` is the
    header mapping they come from: its counts and findings enter the run, and its audit is written.
    """
    run_id = run_id or new_run_id()
    root, log = f"{out_dir}/{run_id}", RunLog(spark)
    if normalization is not None:
        started_at, audit = _now(), f"{root}/reports/header_mapping.parquet"
        write_table(normalization.audit, audit)
        log.add_step(
            NORMALIZATION_STEP, None, [tuple(row) for row in normalization.issues.collect()],
            normalization.metrics.first().asDict(), started_at, {"header_mapping": audit},
        )
    given = dict(tables or {})
    curated: dict[str, DataFrame] = {}
    invalid: dict[str, DataFrame] = {}
    for spec in specs:
        source = given.get(spec.dataset_id)
        if source is None:
            started_at = _now()
            check = validate_file_input(spark, spec, include_hash=hash_inputs)
            issues = [tuple(row) for row in check.issues.collect()]
            # written before it is summed up: hashing reads the files whole, so it is done once
            listing = f"{root}/reports/files_{spec.dataset_id}.parquet"
            files = spark.read.schema(check.metrics.schema).parquet(write_table(check.metrics, listing))
            sizes = files.agg(F.count(F.lit(1)).alias("files"), F.sum("size_bytes").alias("size_bytes")).first()
            log.add_step(check.step_name, spec.dataset_id, issues, sizes.asDict(), started_at, {"files": listing})
            if issues:
                if fail_fast:
                    raise FileNotFoundError(f"Critical input error for {spec.dataset_id}")
                continue
            source = read_table_from_spec(spark, spec)
        path = f"{root}/curated/{spec.dataset_id}.parquet"
        bad = f"{root}/reports/invalid_values_{spec.dataset_id}.parquet"
        curated[spec.dataset_id], result = curate(
            source, spec, path, as_of=as_of, strict_nulls=strict_nulls, invalid_path=bad
        )
        invalid[spec.dataset_id] = result.invalid_values
        log.add_suite(result)
    merges, metrics = merge_and_write(curated, steps, f"{root}/analytic", log, row_budget)
    return write_reports(RunResult(run_id, curated, merges, log.step_results(), log.step_issues(), metrics, invalid), out_dir)


def write_reports(result: RunResult, out_dir: str) -> RunResult:
    """Write the report tables, partitioned by run, and return the result reading from them.

    A run's partition is replaced, so a report written twice has its rows once; other runs stay. A result that reads
    from these reports already is returned as it is.
    """
    if result.written_to == out_dir:
        return result
    spark = result.step_results.sparkSession
    reports = {
        "step_results": result.step_results,
        "issues": result.step_issues,
        "merge_metrics": result.merge_metrics,
        "invalid_values": result.invalid_value_report(),
    }
    stored = {}
    for name, table in reports.items():
        path = f"{out_dir}/reports/{name}.parquet"
        # the report of values grows with the data; the others hold a few rows
        rows = table if name == "invalid_values" else table.coalesce(1)
        rows.write.mode("overwrite").parquet(f"{path}/run_id={quote(result.run_id, safe='')}")
        tagged = table.withColumn("run_id", F.lit(result.run_id))
        stored[name] = spark.read.schema(tagged.schema).parquet(path).filter(F.col("run_id") == result.run_id)
    invalid = {
        name: stored["invalid_values"].filter(F.col("dataset_id") == name).drop("dataset_id", "run_id")
        for name in result.invalid_values
    }
    return RunResult(
        result.run_id, result.tables, result.merges, stored["step_results"], stored["issues"],
        stored["merge_metrics"], invalid, out_dir,
    )
