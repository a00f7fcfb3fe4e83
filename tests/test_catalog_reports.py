import pytest

from concordat.model import ERROR, INFO, ISSUE_COLUMNS, STEP_SCHEMA, WARNING, issue, issues_frame, local_table
from concordat.operators import catalog, reports
from concordat.operators.checks import step_row

import datetime as dt

ROWS = [
    (" b ", "both_studies", True, "1", None, 1, None),
    ("a", "once_only", True, "0", "Selected", 0, 1.0),
    ("c", "quince_only", None, "yes", "no", None, float("nan")),
    (None, None, False, None, None, 1, 2.0),
]
DDL = (
    "QUESTION_NAME string, MERGE_STATUS string, PRESENT_ONCE boolean, PRESENT_QUINCE string, "
    "SELECT_FOR_PIPELINE string, QUESTION_TEXTS_MATCH int, FORM_NAMES_MATCH double"
)


def test_catalog_flags_and_order(spark):
    built = catalog.build_catalog(spark.createDataFrame(ROWS, DDL))
    assert built.columns == [
        "selected_for_pipeline", "canonical_variable_name", "QUESTION_NAME", "MERGE_STATUS", "source_studies",
        "needs_harmonization_review",
    ]
    assert [tuple(r) for r in built.collect()] == [
        (True, "a", "a", "once_only", "once", True),
        (True, "b", " b ", "both_studies", "once,quince", False),
        (False, "", None, None, "", True),
        (False, "c", "c", "quince_only", "quince", False),
    ]


def test_other_modes_select_everything(spark):
    built = catalog.build_catalog(spark.createDataFrame(ROWS, DDL), mode="all")
    assert built.filter("selected_for_pipeline").count() == 4


def test_absent_match_and_selection_columns(spark):
    df = spark.createDataFrame(ROWS, DDL).select("QUESTION_NAME", "MERGE_STATUS", "PRESENT_ONCE", "PRESENT_QUINCE")
    built = catalog.build_catalog(df)
    assert built.filter("needs_harmonization_review").isEmpty()
    assert built.filter("selected_for_pipeline").count() == 1
    with pytest.raises(ValueError, match="PRESENT_ONCE"):
        catalog.build_catalog(df.drop("PRESENT_ONCE"))


def test_text_match_values(spark, rows):
    df = spark.createDataFrame(
        [("a", "1"), ("b", "1.0"), ("c", "no"), ("d", " "), ("e", None)], "QUESTION_NAME string, FORM_NAMES_MATCH string"
    )
    flagged = df.select("QUESTION_NAME", catalog.needs_review(df).alias("r"))
    assert rows(flagged) == [("a", False), ("b", False), ("c", True), ("d", False), ("e", False)]


def test_summary(spark, rows):
    built = catalog.build_catalog(spark.createDataFrame(ROWS, DDL))
    assert rows(catalog.catalog_summary(built)) == [
        ("both_studies", 1), ("harmonization_review_needed", 2), ("input_rows", 4), ("once_only", 1),
        ("quince_only", 1), ("selected_rows", 2),
    ]


def test_issue_table_has_its_columns_when_empty(spark):
    assert issues_frame(spark, []).columns == ISSUE_COLUMNS and issues_frame(spark, []).isEmpty()


def test_run_reports(spark, rows):
    found = [issue("demo", "input", "file_exists", ERROR, "Missing file"), issue("demo", "s", "c", WARNING, "w", row_count=3)]
    start = dt.datetime.now(dt.timezone.utc)
    steps = [
        step_row("demo_input_validation", "demo", found, {"n": 1, "gone": None}, start, {"file": "f"}),
        step_row("demo_rules", "demo", [issue("demo", "s", "c", INFO, "i")], {}, start),
        step_row("alone", None, [], {}, start),
    ]
    table = local_table(spark, steps, STEP_SCHEMA)
    assert rows(table, "step_name", "success", "issue_count") == [
        ("alone", True, 0), ("demo_input_validation", False, 2), ("demo_rules", True, 1),
    ]
    assert table.filter("step_name = 'demo_input_validation'").first().metrics == {"n": "1"}
    issues = issues_frame(spark, found)
    assert rows(reports.issues_of(issues, "error"), "check_name") == [("file_exists",)]
    assert rows(reports.counts_by_stage(table)) == [("alone", 1, 0, 0), ("demo", 2, 1, 3)]
    assert rows(reports.run_summary(table, issues)) == [(False, 3, 1, 1)]
    assert rows(reports.run_summary(table, issues_frame(spark, []))) == [(True, 3, 0, 0)]


def test_exclusions(spark, rows):
    metrics = spark.createDataFrame([(1, 0), (2, 5)], "left_only_count long, right_only_count long")
    assert rows(reports.exclusion_totals(metrics)) == [(3, 5)]
    assert rows(reports.exclusion_totals(metrics.limit(0))) == [(0, 0)]


def test_local_tables_are_part_of_the_plan(spark, plan_of):
    assert "LocalTableScan" in plan_of(local_table(spark, [(1, "a")], "n int, s string"))


def test_presence_as_a_number(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0, 0), ("b", float("nan"), 2), ("c", None, None)],
        "QUESTION_NAME string, PRESENT_ONCE double, PRESENT_QUINCE int",
    )
    named = df.select("QUESTION_NAME", catalog.source_studies(df))
    assert rows(named) == [("a", "once"), ("b", "quince"), ("c", "")]
