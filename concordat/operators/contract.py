"""Declarative contracts: coerce, check everything, then fail once with every failure case."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casting import as_date, as_number
from ..functions.text import ref
from ..model import local_table

# Declared type name to Spark type.
CONTRACT_TYPES = {
    "string": "string",
    "str": "string",
    "numeric": "double",
    "float": "double",
    "float64": "double",
    "int": "bigint",
    "int64": "bigint",
    "Int64": "bigint",
    "bool": "boolean",
    "boolean": "boolean",
    "date": "date",
    "datetime64[ns]": "timestamp",
}

FAILURE_SCHEMA = "column_name string, check_name string, failure_value string, failing_rows long"


@dataclass(frozen=True)
class DatasetSchemaSpec:
    required_columns: Sequence[str]
    dtypes: Mapping[str, str] = field(default_factory=dict)
    nullable_columns: Sequence[str] = ()
    allowed_values: Mapping[str, Sequence[Any]] = field(default_factory=dict)
    ranges: Mapping[str, Mapping[str, float]] = field(default_factory=dict)


class ContractError(ValueError):
    """Raised when a table breaks its contract; ``failures`` is the table of failure cases."""

    def __init__(self, message: str, failures: DataFrame):
        super().__init__(message)
        self.failures = failures


def _coerced(name: str, spec: DatasetSchemaSpec, data_type: T.DataType) -> Column:
    target = CONTRACT_TYPES.get(spec.dtypes.get(name, "string"), spec.dtypes.get(name, "string"))
    if target == "string":
        return ref(name).cast("string")
    if target == "double":
        return as_number(ref(name), data_type)
    if target == "date":
        return as_date(ref(name), data_type).cast("date")
    return ref(name).try_cast(target)


def coerce_to_contract(df: DataFrame, spec: DatasetSchemaSpec) -> DataFrame:
    """Required columns in their declared type; extra columns as they are."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[(_coerced(c, spec, types[c]) if c in spec.required_columns else ref(c)).alias(c) for c in df.columns]
    )


def contract_failures(df: DataFrame, spec: DatasetSchemaSpec) -> DataFrame:
    """Failure cases (column, check, value) with the number of rows holding each.

    Only failing rows are unfolded, and equal cases combine before they are shuffled.
    """
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    absent = [(c, "column_in_dataframe", c, 1) for c in spec.required_columns if c not in types]
    cases: list[tuple[str, str, Column]] = []
    for name in spec.required_columns:
        if name not in types:
            continue
        value = _coerced(name, spec, types[name])
        cases.append((name, "coerce_dtype", ref(name).isNotNull() & value.isNull()))
        if name not in spec.nullable_columns:
            cases.append((name, "not_nullable", ref(name).isNull()))
        if name in spec.allowed_values:
            cases.append((name, "isin", ~value.isin(*spec.allowed_values[name])))
        bounds = spec.ranges.get(name, {})
        if bounds.get("min") is not None:
            cases.append((name, "greater_than_or_equal_to", value < F.lit(bounds["min"])))
        if bounds.get("max") is not None:
            cases.append((name, "less_than_or_equal_to", value > F.lit(bounds["max"])))
    missing = local_table(spark, absent, FAILURE_SCHEMA)
    if not cases:
        return missing
    failed = [F.coalesce(condition, F.lit(False)) for _, _, condition in cases]
    unfolded = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(check).alias("check_name"),
                ref(name).cast("string").alias("failure_value"),
                fails.alias("failed"),
            )
            for (name, check, _), fails in zip(cases, failed)
        ]
    )
    found = (
        df.filter(reduce(lambda a, b: a | b, failed))
        .select(F.inline(unfolded))
        .filter("failed")
        .groupBy("column_name", "check_name", "failure_value")
        .agg(F.count(F.lit(1)).alias("failing_rows"))
    )
    return found.unionByName(missing) if absent else found


class SchemaRegistry:
    """Contracts by dataset id."""

    def __init__(self) -> None:
        self._specs: dict[str, DatasetSchemaSpec] = {}

    def register(self, dataset_id: str, spec: DatasetSchemaSpec) -> DatasetSchemaSpec:
        self._specs[dataset_id] = spec
        return spec

    def get(self, dataset_id: str) -> DatasetSchemaSpec:
        if dataset_id not in self._specs:
            raise KeyError(f"Schema not registered for dataset: {dataset_id}")
        return self._specs[dataset_id]

    def validate(self, dataset_id: str, df: DataFrame) -> DataFrame:
        """The coerced table, or ContractError with all failure cases."""
        spec = self.get(dataset_id)
        failures = contract_failures(df, spec)
        # one row per column and check at most
        summary = failures.groupBy("column_name", "check_name").agg(F.sum("failing_rows").alias("n")).collect()
        if summary:
            shown = ", ".join(f"{r.column_name}: {r.check_name} ({r.n})" for r in sorted(summary))
            raise ContractError(f"{dataset_id} breaks its contract: {shown}", failures)
        return coerce_to_contract(df, spec)


def build_schema_from_spec(spec: DatasetSchemaSpec) -> DatasetSchemaSpec:
    return SchemaRegistry().register("__anonymous__", spec)
