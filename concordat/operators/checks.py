"""Quality checks of one table against its contract.

Everything that is a count of rows compiles to probes (one fused pass, see ``probes``). Uniqueness
and value lists need keys and values: one grouped pass each, combined on the map side, so a key or
value held by a third of all rows leaves every task as a single row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.casting import as_date, as_number, cast_to, without_nan
from ..functions.text import is_missing, quoted, ref, strip
from ..model import (
    DEFAULT_DATE_FORMATS,
    ERROR,
    ISSUE_COLUMNS,
    STEP_SCHEMA,
    WARNING,
    CheckResult,
    DatasetSpec,
    issue,
    issues_frame,
    local_table,
)
from .probes import (
    N_ROWS,
    WIDE,
    CellTest,
    Probe,
    map_cells,
    probe_aggregates,
    probe_counts,
    probe_findings,
    probe_issues,
    probe_lines,
    run_probes,
)

COLUMN_STEP = "column_validation"
DTYPE_STEP = "dtype_validation"
MISSING_STEP = "missingness_profile"
KEY_STEP = "primary_key_validation"
ALLOWED_STEP = "allowed_values_validation"
RULE_STEP = "business_rules"
SANITY_STEP = "sanity_checks"
SUITE = (COLUMN_STEP, DTYPE_STEP, MISSING_STEP, KEY_STEP, ALLOWED_STEP, RULE_STEP, SANITY_STEP)


class Values:
    """Column expressions of a table by name, as they stand or as the cast columns beside them."""

    def __init__(self, schema: T.StructType, spec: DatasetSpec, casts: Mapping[str, str] | None = None):
        self.types = {f.name: f.dataType for f in schema.fields}
        self.spec = spec
        self.casts = casts or {}

    def __contains__(self, name: str) -> bool:
        return name in self.types

    def held_in(self, name: str) -> str:
        return self.casts.get(name, name)

    def value(self, name: str) -> Column:
        return ref(self.held_in(name))

    def data_type(self, name: str) -> T.DataType:
        return cast_type(self.types[name], self.spec.expected_dtypes[name]) if name in self.casts else self.types[name]

    def number(self, name: str) -> Column:
        return as_number(self.value(name), self.data_type(name))

    def date(self, name: str) -> Column:
        return as_date(self.value(name), self.data_type(name), self.spec.date_formats)

    def missing(self, name: str) -> Column:
        return is_missing(self.value(name), self.data_type(name))


def cast_type(data_type: T.DataType, target: str | None) -> T.DataType:
    """Type of a column once cast to its declared type; a column of another declaration keeps its own."""
    if target == "numeric":
        return T.DoubleType()
    if target == "string":
        return T.StringType()
    if target == "date" and not isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return T.DateType()
    return data_type


def needing_casts(schema: T.StructType, spec: DatasetSpec) -> list[str]:
    """Columns whose declared type is not the one they have."""
    return [f.name for f in schema.fields if cast_type(f.dataType, spec.expected_dtypes.get(f.name)) != f.dataType]


def declared_casts(schema: T.StructType, spec: DatasetSpec) -> dict[str, Column]:
    return {
        name: cast_to(ref(name), schema[name].dataType, spec.expected_dtypes[name], spec.date_formats)
        for name in needing_casts(schema, spec)
    }


def cast_expected_types(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Declared columns cast to their declared types, bad values to null, in one projection."""
    casts = declared_casts(df.schema, spec)
    return df.select(*[casts.get(name, ref(name)).alias(name) for name in df.columns])


# --- columns (schema only, no job) ------------------------------------------------------------


def column_differences(df: DataFrame, spec: DatasetSpec) -> tuple[list[str], list[str]]:
    actual, required = set(df.columns), set(spec.required_columns)
    return sorted(required - actual), sorted(actual - required - set(spec.optional_columns))


def _column_issues(df: DataFrame, spec: DatasetSpec) -> list[tuple]:
    missing, extra = column_differences(df, spec)
    found = []
    if missing:
        found.append(
            issue(spec.dataset_id, "structure", "missing_columns", ERROR, f"Missing required columns: {missing}")
        )
    if extra:
        found.append(
            issue(spec.dataset_id, "structure", "unexpected_columns", WARNING, f"Unexpected columns: {extra}")
        )
    return found


def validate_columns(df: DataFrame, spec: DatasetSpec) -> CheckResult:
    missing, extra = column_differences(df, spec)
    spark = df.sparkSession
    metrics = local_table(
        spark,
        [(len(df.columns), len(missing), len(extra))],
        "n_columns long, missing_required_count long, unexpected_count long",
    )
    return CheckResult(
        f"{spec.dataset_id}_{COLUMN_STEP}", spec.dataset_id, metrics, issues_frame(spark, _column_issues(df, spec))
    )


# --- probes per check -------------------------------------------------------------------------


def _dtype_probes(values: Values) -> list[Probe]:
    """Values present as read, but not castable."""
    probes = []
    for name, expected in values.spec.expected_dtypes.items():
        if name not in values:
            continue
        observed = values.types[name].simpleString()
        cell_test, check = None, f"{expected}_cast"
        if expected in ("numeric", "date"):
            cell_test = _cast_test(expected, name, values)
        probes.append(
            Probe(
                DTYPE_STEP,
                "dtype",
                check,
                ERROR,
                f"{{n}} invalid {expected} values in {name}",
                column_name=name,
                condition=F.lit(False) if cell_test is None else None,
                cell_test=cell_test,
                detail=f"{expected}|{observed}",
            )
        )
    return probes


def _cast_test(expected: str, name: str, values: Values) -> CellTest:
    raw_type, data_type = values.types[name], values.data_type(name)

    def not_castable(raw: Column, value: Column) -> Column:
        parsed = as_number(value, data_type) if expected == "numeric" else as_date(value, data_type, values.spec.date_formats)
        return without_nan(raw, raw_type).isNotNull() & parsed.isNull()

    kind = (expected, raw_type.simpleString(), data_type.simpleString())
    return CellTest(kind, (name, values.held_in(name)), not_castable)


def _missing_test(name: str, values: Values) -> CellTest:
    data_type = values.data_type(name)
    kind = ("missing", data_type.simpleString())
    return CellTest(kind, (values.held_in(name),), lambda value: is_missing(value, data_type))


def _missing_probes(values: Values) -> list[Probe]:
    return [
        Probe(
            MISSING_STEP,
            "missingness",
            "required_missing",
            WARNING,
            f"Required column {name} has {{n}} missing/blank values",
            column_name=name,
            cell_test=_missing_test(name, values),
            finding=name in values.spec.required_columns,
        )
        for name in values.types
    ]


def rule_condition(rule: Mapping[str, Any], values: Values, as_of: dt.date | None, strict_nulls: bool) -> Column | None:
    """Rows failing a rule; None for a rule type that does not exist."""
    kind = rule["type"]
    allow_na = bool(rule.get("allow_na", False))

    def known(key: str) -> str:
        name = rule[key]
        if name not in values:
            raise KeyError(f"Rule {rule['name']}: column {name} not found")
        return name

    if kind == "not_blank":
        return values.missing(known("column"))
    if kind == "between":
        number = values.number(known("column"))
        return F.coalesce((number < F.lit(rule["min"])) | (number > F.lit(rule["max"])), F.lit(False))
    if kind == "in_set":
        name = known("column")
        value = without_nan(values.value(name), values.data_type(name))
        allowed = [str(v) for v in rule["values"]]
        listed = value.cast("string").isin(*allowed) if allowed else F.lit(False)
        # a null is outside every list unless the rule lets it through
        return F.when(value.isNull(), F.lit(not allow_na)).otherwise(~listed)
    if kind == "date_not_future":
        today = F.current_date() if as_of is None else F.lit(as_of)
        return F.coalesce(values.date(known("column")) > today, F.lit(False))
    if kind == "compare_dates":
        left, right = values.date(known("left")), values.date(known("right"))
        operator = rule.get("operator", ">=")
        if operator not in (">=", ">"):
            raise ValueError(f"Unsupported date comparison operator: {operator}")
        violated = left < right if operator == ">=" else left <= right
        return F.coalesce(violated, F.lit(strict_nulls and not allow_na))
    return None


def _rule_probes(values: Values, as_of: dt.date | None, strict_nulls: bool) -> list[Probe]:
    probes = []
    for rule in values.spec.rules:
        condition = rule_condition(rule, values, as_of, strict_nulls)
        known = condition is not None
        probes.append(
            Probe(
                RULE_STEP,
                "business_rules",
                rule["name"],
                ERROR if known else WARNING,
                f"Rule {rule['name']} failed for {{n}} rows" if known else f"Unsupported rule type: {rule['type']}",
                condition=condition,
                detail=rule["type"],
            )
        )
    return probes


def _sanity_probe() -> Probe:
    return Probe(SANITY_STEP, "sanity", "empty_dataframe", ERROR, "Dataset has zero rows", empty_table=True)


def _check(df: DataFrame, spec: DatasetSpec, step: str, probes: Sequence[Probe], metrics) -> CheckResult:
    """Check made of probes alone; ``metrics`` turns the probe lines into the check's own table."""
    lines = run_probes(df, probes or [_sanity_probe()])
    if not probes:
        lines = lines.limit(0)
    return CheckResult(
        f"{spec.dataset_id}_{step}", spec.dataset_id, metrics(lines), probe_issues(lines, spec.dataset_id)
    )


def dtype_metrics(lines: DataFrame) -> DataFrame:
    parts = F.split("detail", r"\|", 2)
    return lines.filter(F.col("step_name") == DTYPE_STEP).select(
        "column_name", parts[0].alias("expected"), parts[1].alias("observed"), F.col("failing_rows").alias("invalid_count")
    )


def missingness_metrics(lines: DataFrame) -> DataFrame:
    rate = F.round(F.col("failing_rows") / F.greatest(F.col(N_ROWS), F.lit(1)), 4)
    return lines.filter(F.col("step_name") == MISSING_STEP).select(
        "column_name", F.col("failing_rows").alias("missing_count"), rate.alias("missing_pct")
    )


def rule_metrics(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("step_name") == RULE_STEP).select(
        F.col("check_name").alias("rule_name"), F.col("detail").alias("rule_type"), "failing_rows"
    )


def validate_dtypes(df: DataFrame, spec: DatasetSpec) -> CheckResult:
    return _check(df, spec, DTYPE_STEP, _dtype_probes(Values(df.schema, spec)), dtype_metrics)


def profile_missingness(df: DataFrame, spec: DatasetSpec) -> CheckResult:
    probes = _missing_probes(Values(df.schema, spec))
    return _check(df, spec, MISSING_STEP, probes, missingness_metrics)


def run_business_rules(
    df: DataFrame, spec: DatasetSpec, as_of: dt.date | None = None, strict_nulls: bool = False
) -> CheckResult:
    """All rules of a table in one pass.

    ``as_of`` stands for today. A comparison of dates with a null side passes; ``strict_nulls``
    makes it fail for rules without ``allow_na``.
    """
    probes = _rule_probes(Values(df.schema, spec), as_of, strict_nulls)
    return _check(df, spec, RULE_STEP, probes, rule_metrics)


def run_sanity_checks(df: DataFrame, spec: DatasetSpec) -> CheckResult:
    width = len(df.columns)
    return _check(
        df,
        spec,
        SANITY_STEP,
        [_sanity_probe()],
        lambda lines: lines.select(N_ROWS, F.lit(width).cast("long").alias("n_columns")),
    )


# --- uniqueness -------------------------------------------------------------------------------


def key_metrics(df: DataFrame, key: str, value: Column | None = None, data_type: T.DataType | None = None) -> DataFrame:
    """Blank, repeated and distinct keys from one key histogram."""
    value = ref(key) if value is None else value
    data_type = df.schema[key].dataType if data_type is None else data_type
    histogram = df.select(without_nan(value, data_type).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return histogram.agg(
        F.lit(key).alias("primary_key"),
        F.coalesce(F.sum(F.when(is_missing(F.col("k"), data_type), F.col("n"))), F.lit(0)).alias("blank_key_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_key_count"),
        F.count("k").alias("unique_key_count"),
    )


def _key_probes(key: str, with_info: bool, stage: str = "uniqueness") -> list[Probe]:
    shared = {"step": KEY_STEP, "stage": stage, "column_name": key}
    probes = [
        Probe(check_name="blank_primary_key", severity=ERROR, message="{n} blank/null primary key values",
              count_name="blank_key_count", **shared),
        Probe(check_name="duplicate_primary_key", severity=ERROR, message="{n} duplicated primary key rows",
              count_name="duplicate_key_count", **shared),
    ]
    if with_info:
        probes.append(
            Probe(check_name="", severity=ERROR, message="", count_name="defects", pass_check=KEY_STEP,
                  pass_message="Primary key validation passed", **shared)
        )
    return probes


_NO_KEY_METRICS = "primary_key string, blank_key_count long, duplicate_key_count long, unique_key_count long"


def _absent_key(dataset_id: str, key: str, stage: str = "uniqueness") -> tuple:
    return issue(dataset_id, stage, "primary_key_missing", ERROR, f"Primary key column missing: {key}", column_name=key)


def validate_primary_key(df: DataFrame, spec: DatasetSpec, with_info: bool = False) -> CheckResult:
    spark, key, dataset_id = df.sparkSession, spec.primary_key, spec.dataset_id
    step = f"{dataset_id}_{KEY_STEP}"
    if not key:
        return CheckResult(step, dataset_id, local_table(spark, [], _NO_KEY_METRICS), issues_frame(spark, []))
    if key not in df.columns:
        metrics = local_table(spark, [(key, 0, 0, 0)], _NO_KEY_METRICS)
        return CheckResult(step, dataset_id, metrics, issues_frame(spark, [_absent_key(dataset_id, key)]))
    metrics = key_metrics(df, key)
    counts = metrics.withColumn("defects", F.col("blank_key_count") + F.col("duplicate_key_count"))
    issues = probe_issues(probe_lines(counts, _key_probes(key, with_info)), dataset_id)
    return CheckResult(step, dataset_id, metrics, issues.filter(F.col("check_name") != ""))


def _of_repeated_digests(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """The rows whose key may repeat. Long keys are counted by a 64-bit digest, so that none of their text is shuffled.

    Equal keys have equal digests; unequal ones that meet are told apart by the caller. Keys that are no longer than a
    digest are left as they are.
    """
    short = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if all(isinstance(df.schema[c].dataType, short) for c in subset):
        return df
    digest = F.xxhash64(*[ref(c) for c in subset])
    counted = df.groupBy(digest.alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counted.filter(F.col("__n") > 1).select("__digest")
    return df.join(repeated, digest == F.col("__digest"), "left_semi")


def duplicate_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """All rows of every key that occurs more than once; nulls are a key like any other.

    The keys are counted first and joined back. A window over the key would gather all rows of a
    hot key in one task; here its rows sit on the splittable side of a semi join.
    """
    df = _of_repeated_digests(df, subset)
    names = [f"__k{i}" for i in range(len(subset))]
    counted = df.groupBy(*[ref(c).alias(n) for c, n in zip(subset, names)]).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counted.filter(F.col("__n") > 1).drop("__n")
    condition = reduce(lambda a, b: a & b, [ref(c).eqNullSafe(F.col(n)) for c, n in zip(subset, names)])
    return df.join(repeated, condition, "left_semi")


def detect_duplicates(
    df: DataFrame, subset: Sequence[str], dataset_id: str, stage: str = "uniqueness"
) -> tuple[DataFrame, DataFrame]:
    """Rows of repeated keys, and the finding about them (counted from the keys alone)."""
    candidates = _of_repeated_digests(df, subset)
    keys = candidates.groupBy(*[ref(c) for c in subset]).agg(F.count(F.lit(1)).alias("__n"))
    total = keys.agg(F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("repeated"))
    probe = Probe(
        "duplicates", stage, "duplicate_rows", ERROR, f"Detected {{n}} duplicated rows for subset={list(subset)}",
        count_name="repeated", pass_check="duplicate_rows",
        pass_message=f"No duplicated rows for subset={list(subset)}",
    )
    return duplicate_rows(df, subset), probe_issues(probe_lines(total, [probe]), dataset_id)


# --- value lists ------------------------------------------------------------------------------


def _text_of(value: Column, data_type: T.DataType) -> Column:
    return strip(without_nan(value, data_type).cast("string"))


def invalid_values(
    df: DataFrame,
    allowed: Mapping[str, Sequence[Any]],
    *,
    strip_allowed: bool = False,
) -> DataFrame:
    """Distinct non-null values outside their column's list, with the rows holding them.

    One scan for all columns; valid values are dropped before anything is shuffled.
    """
    values = Values(df.schema, DatasetSpec(""))
    lists = {c: [str(v).strip() if strip_allowed else str(v) for v in listed] for c, listed in allowed.items()}
    outside = {}
    for name, listed in lists.items():
        if name in values:
            text = _text_of(values.value(name), values.data_type(name))
            outside[name] = F.when(~text.isin(*listed), text) if listed else text
    if not outside:
        return local_table(df.sparkSession, [], "column_name string, value string, failing_rows long")
    pairs = [F.struct(F.lit(name).alias("column_name"), value.alias("value")) for name, value in outside.items()]
    return (
        df.filter(reduce(lambda a, b: a | b, [value.isNotNull() for value in outside.values()]))
        .select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("failing_rows"))
    )


def _domain_probes(columns: Iterable[str], stage: str, with_info: bool) -> list[Probe]:
    """Distinct bad values per column: conditions on the table of invalid values."""
    label = "invalid domain values" if with_info else "invalid values"
    return [
        Probe(
            ALLOWED_STEP, stage, "invalid_domain_value", ERROR, f"{{n}} distinct {label} in {name}", column_name=name,
            condition=F.col("column_name") == name, pass_check="domain_validation" if with_info else None,
            pass_message=f"All values in {name} are within the expected domain.",
        )
        for name in columns
    ]


def _domain_issues(
    invalid: DataFrame, columns: Sequence[str], dataset_id: str, stage: str, with_info: bool
) -> DataFrame:
    """One finding per checked column; the values themselves are in the invalid value table."""
    if not columns:
        return issues_frame(invalid.sparkSession, [])
    return probe_issues(run_probes(invalid, _domain_probes(columns, stage, with_info)), dataset_id)


def validate_allowed_values(df: DataFrame, spec: DatasetSpec) -> CheckResult:
    """Data trimmed, list as given; nulls ignored."""
    invalid = invalid_values(df, spec.allowed_values)
    present = [c for c in spec.allowed_values if c in df.columns]
    issues = _domain_issues(invalid, present, spec.dataset_id, "domain", False)
    return CheckResult(f"{spec.dataset_id}_{ALLOWED_STEP}", spec.dataset_id, invalid, issues)


def validate_domains(
    df: DataFrame, domain_rules: Mapping[str, Iterable[Any]], dataset_id: str, stage: str = "domain"
) -> CheckResult:
    """Data and list trimmed; absent columns and passes are reported too."""
    rules = {c: list(v) for c, v in domain_rules.items()}
    present = [c for c in rules if c in df.columns]
    absent = [
        issue(dataset_id, stage, "domain_column_missing", WARNING,
              f"Domain validation skipped; column not found: {c}", column_name=c)
        for c in rules if c not in df.columns
    ]
    invalid = invalid_values(df, rules, strip_allowed=True)
    issues = _domain_issues(invalid, present, dataset_id, stage, True)
    if absent:
        issues = issues.unionByName(issues_frame(df.sparkSession, absent))
    return CheckResult(f"{dataset_id}_domains", dataset_id, invalid, issues)


# --- single checks with their own reporting ---------------------------------------------------


def validate_required_fields(
    df: DataFrame, required_fields: Iterable[str], dataset_id: str, stage: str = "structure"
) -> CheckResult:
    required, step = list(required_fields), f"{dataset_id}_required_fields"
    spark = df.sparkSession
    absent = [c for c in required if c not in df.columns]
    if absent:
        rows = [issue(dataset_id, stage, "missing_columns", ERROR, f"Missing required columns: {absent}")]
        empty = local_table(spark, [], "column_name string, missing_count long")
        return CheckResult(step, dataset_id, empty, issues_frame(spark, rows))
    values = Values(df.schema, DatasetSpec(dataset_id))
    probes = [
        Probe("required_fields", stage, "required_field_missing_values", WARNING,
              f"Column {c} has {{n}} missing/blank values", column_name=c, condition=values.missing(c))
        for c in required
    ]
    any_missing = reduce(lambda a, b: a | b, [p.rows() for p in probes], F.lit(False))
    # one more probe carries the pass finding of the whole check
    probes.append(
        Probe("required_fields", stage, "", WARNING, "", condition=any_missing, pass_check="required_fields",
              pass_message="All required fields are present with no blank values.")
    )
    lines = run_probes(df, probes)
    metrics = lines.filter(F.col("column_name").isNotNull()).select(
        "column_name", F.col("failing_rows").alias("missing_count")
    )
    issues = probe_issues(lines, dataset_id).filter(F.col("check_name") != "")
    return CheckResult(step, dataset_id, metrics, issues)


def validate_ranges(
    df: DataFrame, range_rules: Mapping[str, Mapping[str, float]], dataset_id: str, stage: str = "business_rules"
) -> CheckResult:
    spark, step = df.sparkSession, f"{dataset_id}_ranges"
    values = Values(df.schema, DatasetSpec(dataset_id))
    absent, probes = [], []
    for name, bounds in range_rules.items():
        if name not in values:
            absent.append(
                issue(dataset_id, stage, "range_column_missing", WARNING,
                      f"Range validation skipped; column not found: {name}", column_name=name)
            )
            continue
        number = values.number(name)
        outside = F.lit(False)
        if bounds.get("min") is not None:
            outside = outside | (number < F.lit(float(bounds["min"])))
        if bounds.get("max") is not None:
            outside = outside | (number > F.lit(float(bounds["max"])))
        probes.append(
            Probe("ranges", stage, "range_violation", ERROR, f"{{n}} rows in {name} violate range {dict(bounds)}",
                  column_name=name, condition=F.coalesce(outside, F.lit(False)), pass_check="range_validation",
                  pass_message=f"Range validation passed for {name}")
        )
    missing = issues_frame(spark, absent)
    if not probes:
        return CheckResult(step, dataset_id, local_table(spark, [], "column_name string, failing_rows long"), missing)
    lines = run_probes(df, probes)
    issues = probe_issues(lines, dataset_id)
    return CheckResult(
        step, dataset_id, lines.select("column_name", "failing_rows"), issues.unionByName(missing) if absent else issues
    )


def parse_dates_safely(
    df: DataFrame, column_name: str, dataset_id: str, stage: str = "dtype",
    formats: Sequence[str] = DEFAULT_DATE_FORMATS,
) -> tuple[DataFrame, DataFrame]:
    """The table with the column parsed, and the finding with the number of unparsed values."""
    data_type = df.schema[column_name].dataType
    parsed = as_date(ref(column_name), data_type, formats)
    probe = Probe(
        "date_parse", stage, "date_parse", WARNING, f"{{n}} rows in {column_name} could not be parsed as dates",
        column_name=column_name, condition=ref(column_name).isNotNull() & parsed.isNull(),
        pass_check="date_parse", pass_message=f"Date parsing succeeded for {column_name}",
    )
    issues = probe_issues(run_probes(df, [probe]), dataset_id)
    return df.withColumn(column_name, parsed), issues


# --- the suite --------------------------------------------------------------------------------


@dataclass(frozen=True)
class SuitePlan:
    """The seven checks of one table, compiled against its schema before anything runs."""

    df: DataFrame
    spec: DatasetSpec
    as_of: dt.date | None = None
    strict_nulls: bool = False
    coerce: bool = True

    @cached_property
    def casts(self) -> dict[str, str]:
        """Name of the cast column standing beside each column that needs one."""
        names = needing_casts(self.df.schema, self.spec) if self.coerce else []
        return {name: f"__cast{i}" for i, name in enumerate(names)}

    @cached_property
    def prepared(self) -> DataFrame:
        """The table with its cast columns beside it, so every value is parsed once for all checks."""
        if not self.casts:
            return self.df
        if len(self.casts) <= WIDE:
            casts = declared_casts(self.df.schema, self.spec)
            return self.df.select("*", *[casts[name].alias(alias) for name, alias in self.casts.items()])
        return self._cast_in_blocks()

    def _cast_in_blocks(self) -> DataFrame:
        """One expression for all columns of a type and target, then its elements by name."""
        formats, kinds = self.spec.date_formats, {}
        for name in self.casts:
            data_type, target = self.df.schema[name].dataType, self.spec.expected_dtypes[name]
            kinds.setdefault((data_type.simpleString(), target), (data_type, []))[1].append(name)
        blocks, elements = [], {}
        for i, ((_, target), (data_type, names)) in enumerate(kinds.items()):
            cast = map_cells([(name,) for name in names], lambda x, t=data_type, to=target: cast_to(x, t, to, formats))
            blocks.append(cast.alias(f"__block{i}"))
            elements.update({name: f"__block{i}[{at}]" for at, name in enumerate(names)})
        beside = [f"{elements[name]} AS {alias}" for name, alias in self.casts.items()]
        return self.df.select("*", *blocks).selectExpr(*map(quoted, self.df.columns), *beside)

    @cached_property
    def values(self) -> Values:
        return Values(self.df.schema, self.spec, self.casts)

    def curated(self, prepared: DataFrame) -> DataFrame:
        """The cast table out of a prepared one."""
        return prepared.selectExpr(*[f"{quoted(self.values.held_in(c))} AS {quoted(c)}" for c in self.df.columns])

    @cached_property
    def probes(self) -> list[Probe]:
        return [
            *_dtype_probes(self.values),
            *_missing_probes(self.values),
            *_rule_probes(self.values, self.as_of, self.strict_nulls),
            _sanity_probe(),
        ]

    def aggregates(self) -> list[Column]:
        """Also fit for ``DataFrame.observe``: none of them is a distinct aggregate."""
        return probe_aggregates(self.probes)

    def key_counts(self) -> dict[str, Any]:
        key = self.spec.primary_key
        if not key or key not in self.values:
            return {}
        return key_metrics(self.cast_only([key]), key).first().asDict()

    def cast_only(self, names: Sequence[str]) -> DataFrame:
        """These columns alone, cast: what is filtered or grouped need not carry a wide table's expressions."""
        narrow = self.df.select(*[ref(name) for name in names])
        casts = declared_casts(narrow.schema, self.spec) if self.coerce else {}
        return narrow.select(*[casts.get(name, ref(name)).alias(name) for name in names])

    @cached_property
    def domain_probes(self) -> list[Probe]:
        return _domain_probes([c for c in self.spec.allowed_values if c in self.values], "domain", with_info=False)

    def invalid_values(self) -> DataFrame:
        return invalid_values(self.cast_only([c for c in self.spec.allowed_values if c in self.values]), self.spec.allowed_values)

    def invalid_counts(self, invalid: DataFrame | None = None) -> dict[str, Any]:
        """One row: the distinct bad values per column."""
        if not self.domain_probes:
            return {}
        return (self.invalid_values() if invalid is None else invalid).agg(*probe_aggregates(self.domain_probes)).first().asDict()


@dataclass(frozen=True)
class SuiteResult:
    """Outcome of one dataset's checks: a few counted numbers, and the table of invalid values."""

    spark: SparkSession
    dataset_id: str
    step_rows: list[tuple]
    finding_rows: list[tuple[str, tuple]]
    type_rows: list[tuple]
    missing_rows: list[tuple]
    rule_rows: list[tuple]
    key_row: dict[str, Any]
    invalid_values: DataFrame

    @property
    def step_results(self) -> DataFrame:
        return local_table(self.spark, self.step_rows, STEP_SCHEMA)

    @property
    def issues(self) -> DataFrame:
        return issues_frame(self.spark, [row for _, row in self.finding_rows])

    @property
    def dtypes(self) -> DataFrame:
        schema = "column_name string, expected string, observed string, invalid_count long"
        return local_table(self.spark, self.type_rows, schema)

    @property
    def missingness(self) -> DataFrame:
        return local_table(self.spark, self.missing_rows, "column_name string, missing_count long, missing_pct double")

    @property
    def rules(self) -> DataFrame:
        return local_table(self.spark, self.rule_rows, "rule_name string, rule_type string, failing_rows long")

    @property
    def keys(self) -> DataFrame:
        return local_table(self.spark, [tuple(self.key_row.values())] if self.key_row else [], _NO_KEY_METRICS)

    def succeeded(self) -> bool:
        return all(row[ISSUE_COLUMNS.index("severity")] != ERROR for _, row in self.finding_rows)


def suite_result(
    plan: SuitePlan,
    counts: Mapping[str, int],
    key_row: dict[str, Any],
    invalid: DataFrame,
    invalid_counts: Mapping[str, int],
    started_at: dt.datetime,
) -> SuiteResult:
    """Assemble the outcome from the few rows the passes returned."""
    spec, name = plan.spec, plan.spec.dataset_id
    found = [(COLUMN_STEP, row) for row in _column_issues(plan.df, spec)]
    found += probe_findings(counts, plan.probes, name)
    if key_row:
        found += probe_findings(key_row, _key_probes(spec.primary_key, with_info=False), name)
    elif spec.primary_key:
        found.append((KEY_STEP, _absent_key(name, spec.primary_key)))
    if invalid_counts:
        found += probe_findings(invalid_counts, plan.domain_probes, name)

    n_rows, width = counts[N_ROWS], len(plan.df.columns)
    types, missing, rules = [], [], []
    for i, probe in enumerate(plan.probes):
        n = counts.get(probe.counted_as(i))
        if probe.step == DTYPE_STEP:
            types.append((probe.column_name, *probe.detail.split("|", 1), n))
        elif probe.step == MISSING_STEP:
            missing.append((probe.column_name, n, round(n / max(n_rows, 1), 4)))
        elif probe.step == RULE_STEP:
            rules.append((probe.check_name, probe.detail, n))
    absent, extra = column_differences(plan.df, spec)
    metrics = {
        COLUMN_STEP: {"n_columns": width, "missing_required_count": len(absent), "unexpected_count": len(extra)},
        DTYPE_STEP: {
            f"{r[0]}.{key}": value
            for r in types
            for key, value in zip(("expected_type", "observed_type", "invalid_count"), r[1:])
        },
        MISSING_STEP: {f"{r[0]}.{key}": value for r in missing for key, value in zip(("missing_count", "missing_pct"), r[1:])},
        KEY_STEP: key_row,
        ALLOWED_STEP: {
            f"{probe.column_name}.invalid_values": invalid_counts.get(probe.counted_as(i))
            for i, probe in enumerate(plan.domain_probes)
        },
        RULE_STEP: {f"{r[0]}.{key}": value for r in rules for key, value in zip(("rule_type", "failing_rows"), r[1:])},
        SANITY_STEP: {"n_rows": n_rows, "n_columns": width},
    }
    steps = [
        step_row(f"{name}_{step}", name, [row for s, row in found if s == step], metrics[step], started_at)
        for step in SUITE
    ]
    findings = [(f"{name}_{step}", row) for step, row in found]
    return SuiteResult(plan.df.sparkSession, name, steps, findings, types, missing, rules, key_row, invalid)


def step_row(
    step_name: str,
    dataset_id: str | None,
    issues: Sequence[tuple],
    metrics: Mapping[str, Any],
    started_at: dt.datetime,
    artifacts: Mapping[str, str] | None = None,
) -> tuple:
    """A row of the step table; a step succeeds when it raised no ERROR."""
    finished_at = dt.datetime.now(dt.timezone.utc)
    severity = ISSUE_COLUMNS.index("severity")
    return (
        step_name,
        dataset_id,
        all(row[severity] != ERROR for row in issues),
        len(issues),
        {k: str(v) for k, v in metrics.items() if v is not None},
        dict(artifacts or {}),
        started_at,
        finished_at,
        round((finished_at - started_at).total_seconds(), 4),
    )


def validate(
    df: DataFrame,
    spec: DatasetSpec,
    *,
    as_of: dt.date | None = None,
    strict_nulls: bool = False,
    coerce: bool = True,
) -> SuiteResult:
    """Run the seven checks of a contract.

    At most three passes whatever the number of columns and rules: one fused count, one key
    histogram, one for all value lists. ``coerce`` judges the values as the declared types.
    """
    started_at = dt.datetime.now(dt.timezone.utc)
    plan = SuitePlan(df, spec, as_of, strict_nulls, coerce)
    counts = probe_counts(plan.prepared, plan.probes)
    return suite_result(plan, counts, plan.key_counts(), plan.invalid_values(), plan.invalid_counts(), started_at)
