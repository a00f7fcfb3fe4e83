import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from concordat.model import DatasetSpec
from concordat.operators import checks


def frame(spark, ddl, *values):
    return spark.createDataFrame(list(values), ddl)


def spec(**fields):
    return DatasetSpec("demo", **fields)


def rule_counts(result):
    return {r.rule_name: r.failing_rows for r in result.metrics.collect()}


def test_missing_required_column_fails(spark):
    result = checks.validate_columns(frame(spark, "patient_id string", ("P1",)), spec(required_columns=["patient_id", "sex"]))
    assert not result.succeeded()
    assert [r.check_name for r in result.issues.collect()] == ["missing_columns"]
    assert result.metrics.first().asDict() == {"n_columns": 1, "missing_required_count": 1, "unexpected_count": 0}


def test_unexpected_column_only_warns(spark):
    result = checks.validate_columns(frame(spark, "a string, b string", ("x", "y")), spec(required_columns=["a"]))
    assert result.succeeded()
    assert result.issues.first().severity == "WARNING"


def test_type_conformance_counts_raw_values(spark, rows):
    df = frame(spark, "n string, d string, s string, x double",
               ("1", "2020-01-01", "a", 1.0), ("x", "bad", "b", None), (None, None, None, float("nan")), ("1f", "2020", "c", 2.0))
    result = checks.validate_dtypes(
        df, spec(expected_dtypes={"n": "numeric", "d": "date", "s": "string", "x": "numeric", "absent": "date"})
    )
    assert rows(result.metrics) == [
        ("d", "date", "string", 2), ("n", "numeric", "string", 2), ("s", "string", "string", 0),
        ("x", "numeric", "double", 0),
    ]
    assert rows(result.issues, "check_name", "column_name", "row_count") == [("date_cast", "d", 2), ("numeric_cast", "n", 2)]


def test_missingness_profile_and_required_warning(spark, rows):
    df = frame(spark, "a string, b string, c double, d boolean",
               ("x", " \t", float("nan"), None), (None, "y", 1.0, True), (" ", "\n", None, False))
    result = checks.profile_missingness(df, spec(required_columns=["a"]))
    assert rows(result.metrics) == [("a", 2, 0.6667), ("b", 2, 0.6667), ("c", 2, 0.6667), ("d", 1, 0.3333)]
    assert rows(result.issues, "severity", "column_name", "row_count") == [("WARNING", "a", 2)]
    assert result.succeeded()


def test_missingness_of_an_empty_table(spark, rows):
    result = checks.profile_missingness(frame(spark, "a string"), spec(required_columns=["a"]))
    assert rows(result.metrics) == [("a", 0, 0.0)]
    assert result.issues.isEmpty()


def test_repeated_key_fails(spark):
    result = checks.validate_primary_key(frame(spark, "patient_id string", ("P1",), ("P1",)), spec(primary_key="patient_id"))
    assert not result.succeeded()
    assert result.metrics.first().duplicate_key_count == 1


def test_null_and_blank_keys(spark, rows):
    df = frame(spark, "k string", (None,), (None,), ("",), (" ",), ("a",), ("a",), ("b",))
    result = checks.validate_primary_key(df, spec(primary_key="k"))
    assert result.metrics.first().asDict() == {
        "primary_key": "k", "blank_key_count": 4, "duplicate_key_count": 2, "unique_key_count": 4,
    }
    assert rows(result.issues, "check_name", "row_count") == [("blank_primary_key", 4), ("duplicate_primary_key", 2)]


def test_key_info_absence_and_none(spark, rows):
    df = frame(spark, "k string", ("a",), ("b",))
    passed = checks.validate_primary_key(df, spec(primary_key="k"), with_info=True)
    assert rows(passed.issues, "check_name", "severity", "row_count") == [("primary_key_validation", "INFO", None)]
    absent = checks.validate_primary_key(df, spec(primary_key="z"))
    assert not absent.succeeded() and absent.issues.first().check_name == "primary_key_missing"
    assert checks.validate_primary_key(df, spec()).issues.isEmpty()


def test_duplicate_rows_keep_all_members_and_null_groups(spark, rows):
    df = frame(spark, "k string, j int, v int", ("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, None, 4), (None, None, 5), (None, 1, 6))
    assert rows(checks.duplicate_rows(df, ["k", "j"]), "v") == [(1,), (2,), (4,), (5,)]
    _, issues = checks.detect_duplicates(df, ["k", "j"], "demo")
    assert rows(issues, "severity", "row_count") == [("ERROR", 4)]
    _, clean = checks.detect_duplicates(df, ["v"], "demo")
    assert rows(clean, "severity", "message", "row_count") == [("INFO", "No duplicated rows for subset=['v']", None)]


def test_duplicate_rows_do_not_gather_a_group(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert "Window" not in plan_of(checks.duplicate_rows(df, ["k"]))


def test_long_keys_are_counted_by_digest_and_told_apart_by_value(spark, rows, plan_of, monkeypatch):
    values = [("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1), ("1", None), (None, None), ("c", 2)]
    df = frame(spark, "t string, n int", *values)
    expected = [(None, 1), (None, 1), ("a", 1), ("a", 1)]
    assert rows(checks.duplicate_rows(df, ["t", "n"])) == expected
    text = plan_of(checks.duplicate_rows(df, ["t", "n"]))
    first = [line for line in text.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert re.search(r"hashpartitioning\(_groupingexpression#\d+L, \d+\)", first)
    assert "xxhash64" not in plan_of(checks.duplicate_rows(df, ["n"]))
    # digests that all meet change nothing
    monkeypatch.setattr(checks.F, "xxhash64", lambda *columns: F.lit(7).cast("long") + F.length(F.lit("")))
    found, issues = checks.detect_duplicates(df, ["t", "n"], "demo")
    assert rows(found) == expected and issues.first().row_count == 4


def test_allowed_values_trim_data_only_and_skip_nulls(spark, rows):
    df = frame(spark, "sex string, n int", (" M ", 1), ("X", 2), ("X", 3), (None, 1), ("F", None))
    result = checks.validate_allowed_values(df, spec(allowed_values={"sex": ["M", "F "], "n": [1, 2], "absent": ["a"]}))
    assert rows(result.metrics) == [("n", "3", 1), ("sex", "F", 1), ("sex", "X", 2)]
    assert rows(result.issues, "column_name", "severity", "row_count") == [("n", "ERROR", 1), ("sex", "ERROR", 2)]


def test_domains_trim_both_sides_and_report_everything(spark, rows):
    df = frame(spark, "sex string, ok string", ("M", "a"), ("F ", "a"), ("X", None))
    result = checks.validate_domains(df, {"sex": ["M ", "F"], "ok": ["a"], "absent": ["q"]}, "demo")
    assert rows(result.issues, "check_name", "column_name", "severity", "row_count") == [
        ("domain_column_missing", "absent", "WARNING", None),
        ("domain_validation", "ok", "INFO", None),
        ("invalid_domain_value", "sex", "ERROR", 1),
    ]
    assert not result.succeeded()


def test_an_empty_list_allows_nothing(spark, rows):
    df = frame(spark, "a string", ("x",), (None,))
    assert rows(checks.invalid_values(df, {"a": []})) == [("a", "x", 1)]


def test_between_flags_out_of_range(spark):
    rule = {"name": "r", "type": "between", "column": "score", "min": 0, "max": 10}
    df = frame(spark, "score int", (5,), (12,))
    assert rule_counts(checks.run_business_rules(df, spec(rules=[rule]))) == {"r": 1}


@pytest.mark.parametrize("allow_na", [False, True])
def test_between_passes_nulls_and_text_that_is_no_number(spark, allow_na):
    rule = {"name": "r", "type": "between", "column": "v", "min": 0, "max": 10, "allow_na": allow_na}
    df = frame(spark, "v string", ("0",), ("10",), ("10.01",), ("x",), (None,), ("",))
    assert rule_counts(checks.run_business_rules(df, spec(rules=[rule]))) == {"r": 1}


def test_in_set_does_not_trim_and_fails_nulls_unless_allowed(spark):
    df = frame(spark, "v string", ("Y",), (" Y",), (None,), ("N",))
    base = {"type": "in_set", "column": "v", "values": ["Y", "N"]}
    rules = [{**base, "name": "strict"}, {**base, "name": "lax", "allow_na": True}, {**base, "name": "none", "values": []}]
    assert rule_counts(checks.run_business_rules(df, spec(rules=rules))) == {"strict": 2, "lax": 1, "none": 4}


def test_not_blank(spark):
    df = frame(spark, "v string", ("a",), (" ",), (None,), (" ",))
    rule = {"name": "r", "type": "not_blank", "column": "v"}
    assert rule_counts(checks.run_business_rules(df, spec(rules=[rule]))) == {"r": 3}


def test_date_not_future_uses_the_given_day(spark):
    df = frame(spark, "d string, t timestamp",
               ("2020-01-01", dt.datetime(2020, 1, 1, 0, 0)), ("2020-01-02", dt.datetime(2020, 1, 1, 0, 1)),
               ("bad", None), (None, None))
    rules = [{"name": c, "type": "date_not_future", "column": c} for c in ("d", "t")]
    result = checks.run_business_rules(df, spec(rules=rules), as_of=dt.date(2020, 1, 1))
    assert rule_counts(result) == {"d": 1, "t": 1}
    assert rule_counts(checks.run_business_rules(df, spec(rules=rules))) == {"d": 0, "t": 0}


DATE_PAIRS = [("2020-01-02", "2020-01-01"), ("2020-01-01", "2020-01-01"), ("2019-12-31", "2020-01-01"),
              (None, "2020-01-01"), ("2020-01-01", None), ("bad", "2020-01-01"), (None, None)]


@pytest.mark.parametrize(
    "operator, allow_na, strict, failing",
    [(">=", False, False, 1), (">=", True, False, 1), (">", False, False, 2), (">", True, False, 2),
     (">=", False, True, 5), (">=", True, True, 1), (">", False, True, 6)],
)
def test_compare_dates(spark, operator, allow_na, strict, failing):
    df = frame(spark, "l string, r string", *DATE_PAIRS)
    rule = {"name": "c", "type": "compare_dates", "left": "l", "right": "r", "operator": operator, "allow_na": allow_na}
    result = checks.run_business_rules(df, spec(rules=[rule]), strict_nulls=strict)
    assert rule_counts(result) == {"c": failing}


def test_bad_rules(spark, rows):
    df = frame(spark, "l string, r string", *DATE_PAIRS)
    with pytest.raises(ValueError, match="operator"):
        checks.run_business_rules(df, spec(rules=[{"name": "c", "type": "compare_dates", "left": "l", "right": "r", "operator": "<"}]))
    with pytest.raises(KeyError, match="zz"):
        checks.run_business_rules(df, spec(rules=[{"name": "c", "type": "not_blank", "column": "zz"}]))
    result = checks.run_business_rules(df, spec(rules=[{"name": "odd", "type": "magic"}]))
    assert rule_counts(result) == {"odd": None}
    assert rows(result.issues, "severity", "check_name", "row_count") == [("WARNING", "odd", None)]
    assert checks.run_business_rules(df, spec()).metrics.isEmpty()


def test_content_checks(spark, rows):
    df = frame(spark, "id string, sex string, score int, d string",
               ("1", "M", 3, "2020-01-01"), ("1", "X", 11, "bad"), ("", "F", 5, None))
    required = checks.validate_required_fields(df, ["id", "sex"], "demo")
    assert required.succeeded() and rows(required.issues, "severity", "column_name", "row_count") == [("WARNING", "id", 1)]
    assert rows(required.metrics) == [("id", 1), ("sex", 0)]
    full = checks.validate_required_fields(df, ["sex"], "demo")
    assert rows(full.issues, "severity", "check_name") == [("INFO", "required_fields")]
    assert not checks.validate_required_fields(df, ["zz"], "demo").succeeded()

    parsed, issues = checks.parse_dates_safely(df, "d", "demo")
    assert parsed.filter("d is null").count() == 2
    assert rows(issues, "severity", "row_count") == [("WARNING", 1)]
    good, passed = checks.parse_dates_safely(df.filter("id = '1'").limit(1), "d", "demo")
    assert rows(passed, "severity", "row_count") == [("INFO", None)]

    ranges = checks.validate_ranges(df, {"score": {"min": 0, "max": 10}, "zz": {"min": 1}}, "demo")
    assert rows(ranges.issues, "check_name", "severity", "row_count") == [
        ("range_column_missing", "WARNING", None), ("range_violation", "ERROR", 1),
    ]
    half = checks.validate_ranges(df, {"score": {"max": 11}}, "demo")
    assert rows(half.issues, "check_name") == [("range_validation",)]
    assert checks.validate_ranges(df, {}, "demo").issues.isEmpty()


def test_sanity(spark, rows):
    assert rows(checks.run_sanity_checks(frame(spark, "a int, b int", (1, 2)), spec()).metrics) == [(1, 2)]
    empty = checks.run_sanity_checks(frame(spark, "a int"), spec())
    assert not empty.succeeded()
    assert rows(empty.issues, "check_name", "row_count") == [("empty_dataframe", None)]


SUITE = DatasetSpec(
    "visits",
    primary_key="id",
    required_columns=["id", "day", "score", "gone"],
    expected_dtypes={"day": "date", "score": "numeric"},
    allowed_values={"kind": ["a"]},
    rules=[
        {"name": "range", "type": "between", "column": "score", "min": 0, "max": 10},
        {"name": "given", "type": "not_blank", "column": "day"},
    ],
)
SUITE_ROWS = [("1", "2020-01-01", "5", "a"), ("1", "bad", "50", "b"), (None, None, "x", " a ")]


def test_suite_judges_values_as_their_declared_types(spark, rows):
    result = checks.validate(frame(spark, "id string, day string, score string, kind string", *SUITE_ROWS), SUITE)
    found = {(r.check_name, r.column_name): r.row_count for r in result.issues.collect()}
    assert found == {
        ("missing_columns", None): None, ("unexpected_columns", None): None, ("date_cast", "day"): 1,
        ("numeric_cast", "score"): 1, ("required_missing", "id"): 1, ("required_missing", "day"): 2,
        ("required_missing", "score"): 1, ("blank_primary_key", "id"): 1, ("invalid_domain_value", "kind"): 1,
        ("range", None): 1, ("given", None): 2, ("duplicate_primary_key", "id"): 1,
    }
    steps = {r.step_name: (r.success, r.issue_count) for r in result.step_results.collect()}
    assert steps == {
        "visits_column_validation": (False, 2), "visits_dtype_validation": (False, 2),
        "visits_missingness_profile": (True, 3), "visits_primary_key_validation": (False, 2),
        "visits_allowed_values_validation": (False, 1), "visits_business_rules": (False, 2),
        "visits_sanity_checks": (True, 0),
    }
    assert rows(result.invalid_values) == [("kind", "b", 1)]
    assert not result.succeeded()
    assert result.step_results.filter("step_name = 'visits_sanity_checks'").first().metrics == {"n_rows": "3", "n_columns": "4"}


def test_suite_without_coercion_sees_text(spark):
    df = frame(spark, "id string, day string, score string, kind string", *SUITE_ROWS)
    found = {(r.check_name, r.column_name): r.row_count for r in checks.validate(df, SUITE, coerce=False).issues.collect()}
    assert found[("required_missing", "day")] == 1
    assert ("required_missing", "score") not in found


def test_fused_checks_scan_once(spark, plan_of, tmp_path):
    frame(spark, "id string, day string, score string, kind string", *SUITE_ROWS).write.parquet(str(tmp_path / "t"))
    plan = checks.SuitePlan(spark.read.parquet(str(tmp_path / "t")), SUITE)
    text = plan_of(plan.prepared.agg(*plan.aggregates()))
    assert text.count("FileScan") == 1
    assert "Python" not in text


def test_cast_expected_types(spark):
    df = frame(spark, "n string, d string, i int, t timestamp", ("1.5", "2020-01-01", 7, dt.datetime(2020, 1, 1, 5)))
    cast = checks.cast_expected_types(df, spec(expected_dtypes={"n": "numeric", "d": "date", "i": "string", "t": "date"}))
    assert [t for _, t in cast.dtypes] == ["double", "date", "string", "timestamp"]
    assert cast.first()[:3] == (1.5, dt.date(2020, 1, 1), "7")


def test_names_with_dots_and_quotes(spark, rows):
    df = frame(spark, "`a.b` string, `c``d` string", ("x", None), ("x", "y"))
    assert rows(checks.profile_missingness(df, spec()).metrics) == [("a.b", 0, 0.0), ("c`d", 1, 0.5)]
    assert checks.duplicate_rows(df, ["a.b"]).count() == 2
    assert checks.validate(df, spec(primary_key="a.b")).key_row["duplicate_key_count"] == 1


def test_nan_is_a_missing_value_everywhere(spark, rows):
    df = frame(spark, "k double", (float("nan"),), (None,), (1.0,))
    rules = [{"name": n, "type": "in_set", "column": "k", "values": ["1.0"], "allow_na": a} for n, a in (("s", False), ("l", True))]
    assert rule_counts(checks.run_business_rules(df, spec(rules=rules))) == {"s": 2, "l": 0}
    metrics = checks.validate_primary_key(df, spec(primary_key="k")).metrics.first()
    assert (metrics.blank_key_count, metrics.duplicate_key_count, metrics.unique_key_count) == (2, 1, 1)
    assert checks.invalid_values(df, {"k": ["1.0"]}).isEmpty()
    assert rows(checks.validate_dtypes(df, spec(expected_dtypes={"k": "numeric"})).metrics, "invalid_count") == [(0,)]


def wide_table(spark, rows, columns):
    cells = ["CAST(id AS STRING) AS id"]
    for i in range(columns):
        kinds = (f"IF((id + {i}) % 7 = 0, ' ', CAST(id AS STRING))", f"IF((id + {i}) % 5 = 0, double('NaN'), id / 2)",
                 f"IF((id + {i}) % 3 = 0, 'bad', '2020-02-03')", f"IF((id + {i}) % 4 = 0, NULL, int(id))")
        cells.append(f"{kinds[i % 4]} AS `c.{i}`")
    contract = DatasetSpec(
        "wide", primary_key="id", required_columns=["id", "c.0"], allowed_values={"c.0": ["1", "2"]},
        expected_dtypes={f"c.{i}": ("date" if i % 4 == 2 else "numeric") for i in range(columns) if i % 4 != 1},
        rules=[{"name": "low", "type": "between", "column": "c.3", "min": 2, "max": 9}, {"name": "odd", "type": "none"}],
    )
    return spark.range(rows).selectExpr(*cells), contract


@pytest.mark.parametrize("n_rows", [0, 23])
def test_blocks_count_what_single_aggregates_count(spark, rows, monkeypatch, n_rows):
    df, contract = wide_table(spark, n_rows, 60)

    def outcome():
        suite = checks.validate(df, contract, as_of=dt.date(2021, 1, 1))
        single = [checks.profile_missingness(df, contract), checks.validate_dtypes(df, contract)]
        tables = [t for c in single for t in (c.metrics, c.issues)]
        return [rows(t) for t in (suite.issues, suite.dtypes, suite.missingness, suite.rules, *tables)]

    plain = outcome()
    monkeypatch.setattr("concordat.operators.probes.WIDE", 5)
    monkeypatch.setattr("concordat.operators.checks.WIDE", 5)
    assert outcome() == plain
    assert n_rows == 0 or plain[0]


def test_wide_tables_have_one_test_per_type(spark, plan_of):
    df, contract = wide_table(spark, 5, 300)
    text = plan_of(checks.profile_missingness(df, contract).metrics)
    assert text.count("lambdafunction(") < 40 and text.count("count_if") == 0
