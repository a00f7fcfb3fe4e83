import datetime as dt

import pytest

from concordat import plans, session
from concordat.model import STEP_ISSUE_SCHEMA, STEP_SCHEMA, DatasetSpec, MergeStep, local_table
from concordat.operators import merge
from concordat.plans import tables

AS_OF = dt.date(2024, 1, 1)

# the contracts of the four sample tables
SPECS = {
    "demographics": DatasetSpec(
        "demographics", primary_key="patient_id", required_columns=["patient_id", "sex", "birth_date", "race"],
        optional_columns=["ethnicity", "death_date", "index_date"],
        expected_dtypes={
            "patient_id": "string", "sex": "string", "birth_date": "date", "race": "string", "ethnicity": "string",
            "death_date": "date", "index_date": "date",
        },
        allowed_values={"sex": ["M", "F", "U"]},
        rules=[
            {"name": "patient_id_not_blank", "type": "not_blank", "column": "patient_id"},
            {"name": "birth_date_not_future", "type": "date_not_future", "column": "birth_date"},
            {"name": "death_after_birth", "type": "compare_dates", "left": "death_date", "right": "birth_date"},
            {"name": "index_after_birth", "type": "compare_dates", "left": "index_date", "right": "birth_date"},
        ],
    ),
    "visits": DatasetSpec(
        "visits", primary_key="visit_id", required_columns=["visit_id", "patient_id", "visit_date", "essdai"],
        optional_columns=["esspri"],
        expected_dtypes={"visit_date": "date", "essdai": "numeric", "esspri": "numeric"},
        rules=[{"name": "essdai_valid_range", "type": "between", "column": "essdai", "min": 0, "max": 123}],
    ),
    "labs": DatasetSpec(
        "labs", primary_key="lab_id", required_columns=["lab_id", "patient_id", "visit_date", "ana_positive", "rf_value"],
        expected_dtypes={"visit_date": "date", "rf_value": "numeric"}, allowed_values={"ana_positive": ["Y", "N"]},
        rules=[{"name": "ana_listed", "type": "in_set", "column": "ana_positive", "values": ["Y", "N"]}],
    ),
    "outcomes": DatasetSpec(
        "outcomes", primary_key="patient_id", required_columns=["patient_id", "severe_disease", "last_followup_date"],
        optional_columns=["event_date"], expected_dtypes={"last_followup_date": "date", "event_date": "date"},
        rules=[
            {"name": "event_before_followup", "type": "compare_dates", "left": "last_followup_date",
             "right": "event_date", "allow_na": True},
        ],
    ),
}
CSV = {
    "demographics": "patient_id,sex,birth_date,race,ethnicity,death_date,index_date\n"
    "P1,F,1980-02-03,W,N,,2010-01-01\nP2,M,1975-05-06,B,,,2011-01-01\nP3,F,1990-07-08,A,N,,2012-01-01\n",
    "visits": "visit_id,patient_id,visit_date,essdai,esspri\nV1,P1,2020-01-01,5,3\nV2,P2,2020-02-01,150,NA\nV3,P3,bad,7,2\n",
    "labs": "lab_id,patient_id,visit_date,ana_positive,rf_value\nL1,P1,2020-01-01,Y,10.5\nL2,P2,2020-02-01,Q,x\n",
    "outcomes": "patient_id,severe_disease,last_followup_date,event_date\nP1,Y,2023-01-01,\nP3,N,2023-01-01,2023-06-01\n",
}
STEPS = [
    MergeStep("demographics_visits", "demographics", "visits", "left", ["patient_id"], "one_to_many"),
    MergeStep("patient_visits_labs", "demographics_visits", "labs", "left", ["patient_id", "visit_date"], "one_to_one_or_many"),
    MergeStep("patient_visits_labs_outcomes", "patient_visits_labs", "outcomes", "outer", ["patient_id"], "one_to_one"),
]


@pytest.fixture
def specs(tmp_path):
    import dataclasses

    result = []
    for name, text in CSV.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        result.append(dataclasses.replace(SPECS[name], path=str(path), file_type="csv"))
    return result


def test_tables_are_curated_judged_merged_and_reported(spark, specs, tmp_path, rows):
    run = plans.curate_and_merge(spark, specs, STEPS, out_dir=str(tmp_path / "out"), as_of=AS_OF, run_id="r1")
    assert rows(run.tables["visits"], "visit_id", "visit_date", "essdai", "esspri") == [
        ("V1", dt.date(2020, 1, 1), 5.0, 3.0), ("V2", dt.date(2020, 2, 1), 150.0, None), ("V3", None, 7.0, 2.0),
    ]
    found = {(r.dataset_id, r.check_name, r.column_name): r.row_count for r in run.issues.collect()}
    assert found == {
        ("visits", "date_cast", "visit_date"): 1, ("visits", "required_missing", "visit_date"): 1,
        ("visits", "essdai_valid_range", None): 1, ("labs", "numeric_cast", "rf_value"): 1,
        ("labs", "required_missing", "rf_value"): 1, ("labs", "invalid_domain_value", "ana_positive"): 1,
        ("labs", "ana_listed", None): 1, ("outcomes", "event_before_followup", None): 1,
        ("demographics_visits", "cardinality_mismatch", None): None,
        ("patient_visits_labs", "left_null_keys", None): 1,
    }
    merged = run.merges["patient_visits_labs_outcomes"]
    assert rows(merged.table, "patient_id", "lab_id", "severe_disease") == [("P1", "L1", "Y"), ("P2", "L2", None), ("P3", None, "N")]
    assert rows(merged.left_only, "patient_id") == [("P2",)] and merged.right_only.isEmpty()
    assert rows(run.exclusions()) == [(2, 0)]
    # four inputs, four suites of seven, three merges of two steps
    assert run.summary().first().asDict() == {
        "success": False, "validations_executed": 38, "error_count": 7, "warning_count": 3,
    }
    stages = {r.stage: (r.executed, r.failed) for r in run.counts_by_stage().collect()}
    assert stages["demographics"] == (8, 0) and stages["visits"] == (8, 2) and stages["demographics_visits"] == (2, 1)
    assert rows(run.invalid_values["labs"]) == [("ana_positive", "Q", 1)]
    assert ("labs", "ana_positive", "Q", 1) in rows(run.invalid_value_report())
    again = plans.curate_and_merge(spark, specs, STEPS, out_dir=str(tmp_path / "out"), as_of=AS_OF, run_id="r2")
    assert again.step_results.count() == 38


def test_reports_written_twice_have_their_rows_once(spark, rows, tmp_path):
    steps = local_table(spark, [("s", "d", True, 0, {}, {}, None, None, 0.0)], STEP_SCHEMA)
    none = local_table(spark, [], STEP_ISSUE_SCHEMA)
    metrics = local_table(spark, [], tables.MERGE_METRICS_SCHEMA)
    bad = local_table(spark, [("c", "x", 2)], "column_name string, value string, failing_rows long")
    for run_id in ("a/1", "b 2", "a/1"):
        run = tables.write_reports(plans.RunResult(run_id, {}, {}, steps, none, metrics, {"d": bad}), str(tmp_path))
    assert tables.write_reports(run, str(tmp_path)) is run
    assert run.step_results.count() == 1 and rows(run.invalid_value_report()) == [("d", "c", "x", 2)]
    written = spark.read.parquet(f"{tmp_path}/reports/invalid_values.parquet")
    assert rows(written, "run_id", "value") == [("a/1", "x"), ("b 2", "x")]


def test_unmatched_rows_are_read_from_their_own_partition(spark, specs, tmp_path, plan_of):
    run = plans.curate_and_merge(spark, specs, STEPS, out_dir=str(tmp_path / "out"), as_of=AS_OF)
    text = plan_of(run.merges["patient_visits_labs"].left_only)
    assert "PartitionFilters: [isnotnull(merge_origin" in text


def test_an_absent_file_is_an_error_and_its_merges_are_skipped(spark, specs, tmp_path):
    import dataclasses

    broken = [dataclasses.replace(s, path=s.path + ".gone") if s.dataset_id == "labs" else s for s in specs]
    run = plans.curate_and_merge(spark, broken, STEPS, out_dir=str(tmp_path / "out"), as_of=AS_OF)
    checks = {r.check_name for r in run.issues.filter("severity = 'ERROR'").collect()}
    assert {"file_exists", "missing_input_table"} <= checks
    assert list(run.merges) == ["demographics_visits"]
    with pytest.raises(FileNotFoundError, match="labs"):
        plans.curate_and_merge(spark, broken, STEPS, out_dir=str(tmp_path / "o2"), as_of=AS_OF, fail_fast=True)


def test_a_key_that_no_table_has_stops_the_merge(spark, specs, tmp_path):
    with pytest.raises(KeyError, match="nokey"):
        plans.curate_and_merge(
            spark, specs[:2], [MergeStep("m", "demographics", "visits", "left", ["nokey"])], out_dir=str(tmp_path / "out")
        )


def test_empty_table_and_empty_merge(spark, tmp_path):
    empty = spark.createDataFrame([], "id string, v string")
    specs = [DatasetSpec(n, primary_key="id", required_columns=["id"], allowed_values={"v": ["a"]}) for n in ("a", "b")]
    run = plans.curate_and_merge(
        spark, specs, [MergeStep("m", "a", "b", "inner", ["id"])], out_dir=str(tmp_path / "out"),
        tables={"a": empty, "b": empty},
    )
    assert run.merges["m"].table.isEmpty() and run.merges["m"].left_only.isEmpty()
    assert {r.check_name for r in run.issues.filter("severity = 'ERROR'").collect()} == {"empty_dataframe"}


def test_wide_export(spark, tmp_path, rows):
    export = spark.createDataFrame(
        [("p1", "v1", "2020-01-01", " f", "note\n1"), (None, None, None, None, None), ("p2", "v2", "bad", "m ", "x"), (None, "v3", None, None, None)],
        "`patient_id ` string, `Visit ID` string, `Visit Date` string, SEX string, `Extra` string",
    )
    mapping = {
        "raw_to_canonical": {"Visit ID": "visit_id"},
        "datasets": {
            "demographics": {"target_columns": ["patient_id", "sex", "race"], "required_columns": ["patient_id", "sex"]},
            "visits": {"target_columns": ["visit_id", "patient_id", "visit_date"], "required_columns": ["lab_id"]},
        },
        "text_normalization": {"uppercase_columns": ["sex"]},
    }
    views, mapped = plans.wide_export_domains(export, mapping, staging_path=str(tmp_path / "staging.parquet"))
    assert rows(views["demographics"]) == [("p1", "F", None), ("p2", "M", None)]
    assert not mapped.succeeded
    specs = [
        DatasetSpec("demographics", primary_key="patient_id", required_columns=["patient_id", "sex"], optional_columns=["race"]),
        DatasetSpec("visits", primary_key="visit_id", expected_dtypes={"visit_date": "date"}),
    ]
    run = plans.curate_and_merge(
        spark, specs, [MergeStep("m", "demographics", "visits", "left", ["patient_id"])],
        out_dir=str(tmp_path / "out"), tables=views,
    )
    assert rows(run.merges["m"].table, "patient_id", "sex", "visit_date") == [("p1", "F", dt.date(2020, 1, 1)), ("p2", "M", None)]
    judged = plans.curate_and_merge(spark, specs, out_dir=str(tmp_path / "out"), tables=views, normalization=mapped, run_id="n")
    step = judged.step_results.filter("step_name = 'single_workbook_normalization'").first()
    assert not step.success and step.metrics["unmapped_column_count"] == "1"
    assert spark.read.parquet(step.artifacts["header_mapping"]).count() == 5
    assert not judged.summary().first().success
    with pytest.raises(ValueError, match="lab_id"):
        plans.wide_export_domains(export, mapping, staging_path=str(tmp_path / "s2.parquet"), fail_fast=True)


def test_cohort(spark, tmp_path, rows):
    once = spark.createDataFrame([("P1", "A", 1, 0), ("P2", "C", 2, 0)], "` patient_id` string, q1 string, q2 int, junk int")
    quince = spark.createDataFrame([("P1", "B", 9), ("P3", None, 8)], "patient_id string, q1 string, q3 int")
    codebook = spark.createDataFrame(
        [(1, "q1", "x"), (2, "q2 ", ""), (3, "q3", None), (4, "q9", "yes"), (5, "q1", "")], "i int, QUESTION_NAME string, needs_review string"
    )
    result = plans.harmonize_cohort(once, quince, codebook, out_dir=str(tmp_path / "out"), order_by=["i"], hot_rows=1)
    assert rows(result.merged, "patient_id", "q1", "q1__source_conflict_flag", "q2", "q3", "q9") == [
        ("P1", "A", True, 1, 9, None), ("P2", "C", False, 2, None, None), ("P3", None, False, None, 8, None),
    ]
    assert rows(result.counts) == [(1, 1, 1, 2)]
    assert result.run.tables["once_raw_analysis"].columns == ["patient_id", "q1", "q2"]
    assert result.run.summary().first().asDict() == {
        "success": True, "validations_executed": 21, "error_count": 0, "warning_count": 0,
    }
    with pytest.raises(ValueError, match="patient_id"):
        plans.harmonize_cohort(once.drop(" patient_id"), quince, codebook, out_dir=str(tmp_path / "o2"))


def test_catalog(spark, tmp_path, rows):
    variables = spark.createDataFrame(
        [("b", "both_studies", 1, 1), ("a", "once_only", 1, 0)], "QUESTION_NAME string, MERGE_STATUS string, PRESENT_ONCE int, PRESENT_QUINCE int"
    )
    result = plans.run_catalog(variables, out_dir=str(tmp_path / "out"))
    assert rows(result.catalog, "canonical_variable_name", "source_studies") == [("a", "once"), ("b", "once,quince")]
    step = result.run.step_results.first()
    assert step.step_name == "variable_catalog_build" and step.success and step.metrics["selected_rows"] == "1"
    assert dict(result.summary.collect())["input_rows"] == 2


def test_merges_are_written_in_tasks_of_bounded_size(spark, tmp_path, rows, monkeypatch):
    """Partitions follow the rows that the audit counted, no rows are sorted to be written, and the session stays as it was."""
    names = ["shuffle.partitions", "maxConcurrentOutputFileWriters", "adaptive.advisoryPartitionSizeInBytes"]
    get = lambda: [spark.conf.get(f"spark.sql.{name}", None) for name in names]
    seen, write = [], tables.write_table

    def writing(*args, **options):
        seen.append(get())
        return write(*args, **options)

    monkeypatch.setattr(tables, "write_table", writing)
    monkeypatch.setattr(merge, "TASK_ROWS", 100)
    kept = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "0")
    try:
        before = get()
        left, right = spark.range(1000).selectExpr("id % 500 as k", "id as a"), spark.range(250, 850).selectExpr("id as k", "id as b")
        steps = [MergeStep("both", "left", "right", "outer", ["k"])]
        written, _ = tables.merge_and_write({"left": left, "right": right}, steps, str(tmp_path), tables.RunLog(spark))
        assert get() == before and seen == [["16", "8", str(merge.TASK_BYTES)]]
        got = written["both"].merged.groupBy("_merge").count()
        assert rows(got) == [("both", 500), ("left_only", 500), ("right_only", 350)]
    finally:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", kept)
    with pytest.raises(ZeroDivisionError), session.settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before[0]
