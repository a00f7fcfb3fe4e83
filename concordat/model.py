"""Plain values and fixed schemas shared by all operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("output_path", T.StringType()),
    ]
)
ISSUE_COLUMNS = ISSUE_SCHEMA.fieldNames()

# an issue together with the step that raised it
STEP_ISSUE_SCHEMA = T.StructType([T.StructField("step_name", T.StringType()), *ISSUE_SCHEMA.fields])

STEP_SCHEMA = T.StructType(
    [
        T.StructField("step_name", T.StringType()),
        T.StructField("dataset_id", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("issue_count", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
        T.StructField("artifacts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)

DEFAULT_DATE_FORMATS = ("yyyy-MM-dd",)


@dataclass(frozen=True)
class DatasetSpec:
    """Contract of one table: what it must hold and how to read it."""

    dataset_id: str
    path: str = ""
    file_type: str | None = None
    primary_key: str | None = None
    required_columns: Sequence[str] = ()
    optional_columns: Sequence[str] = ()
    expected_dtypes: Mapping[str, str] = field(default_factory=dict)
    allowed_values: Mapping[str, Sequence[Any]] = field(default_factory=dict)
    rules: Sequence[Mapping[str, Any]] = ()
    date_formats: Sequence[str] = DEFAULT_DATE_FORMATS
    header_strategy: str | None = None
    demographics_column_end: str = "N"
    demographics_header_row: int = 3
    clinical_header_row: int = 2
    skip_rows_after_header: int = 0
    multi_line: bool = False


@dataclass(frozen=True)
class MergeStep:
    """One join of a merge plan; ``left`` and ``right`` name earlier tables or steps."""

    name: str
    left: str
    right: str
    how: str
    on: Sequence[str]
    expected_relationship: str | None = None


@dataclass(frozen=True)
class CheckResult:
    """Outcome of one check, both tables lazily evaluated."""

    step_name: str
    dataset_id: str | None
    metrics: DataFrame
    issues: DataFrame

    def succeeded(self) -> bool:
        return self.issues.filter(self.issues.severity == ERROR).isEmpty()


def local_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType | str) -> DataFrame:
    """A few rows of plain values as a table.

    Through Arrow they become part of the plan itself: no Python worker reads them, and the planner
    knows how small they are.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [list(values) for values in zip(*rows)] if rows else [[] for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema)


def issue(
    dataset_id: str,
    stage: str,
    check_name: str,
    severity: str,
    message: str,
    column_name: str | None = None,
    row_count: int | None = None,
    output_path: str | None = None,
) -> tuple:
    return (dataset_id, stage, check_name, severity, message, column_name, row_count, output_path)


def issues_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Findings as a table whose eight columns are the same when there are none."""
    return local_table(spark, rows, ISSUE_SCHEMA)
