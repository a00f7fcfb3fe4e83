import pytest

from concordat.operators import harmonize

QUESTIONS = ["patient_id", "var_review", "var_once_only", "var_quince_only"]


def test_codebook_keeps_the_first_row_per_name(spark, rows):
    df = spark.createDataFrame(
        [(3, "var_a", "FALSE"), (1, " var_a ", "TRUE"), (2, "var_b", "FALSE"), (4, " ", "TRUE"), (5, None, "x"), (6, "c", None)],
        "i int, QUESTION_NAME string, needs_review string",
    )
    assert rows(harmonize.load_codebook(df, order_by=["i"])) == [(1, "var_a", True), (2, "var_b", False), (6, "c", False)]
    assert rows(harmonize.load_codebook(df.drop("i"))) == [("c", False), ("var_a", True), ("var_b", False)]
    with pytest.raises(ValueError, match="needs_review"):
        harmonize.load_codebook(df.drop("needs_review"))


def test_questions_come_in_codebook_order(spark):
    df = spark.createDataFrame([(2, "a", "no"), (1, "b", "y")], "i int, QUESTION_NAME string, needs_review string")
    loaded = harmonize.load_codebook(df, order_by=["i"])
    assert harmonize.codebook_questions(loaded, order_by=["i"]) == (["b", "a"], {"b"})


def test_review_variables_keep_both_versions_and_flags(spark):
    once = spark.createDataFrame([("P1", "A", 1)], "patient_id string, var_review string, var_once_only int")
    quince = spark.createDataFrame([("P1", "B", 2)], "patient_id string, var_review string, var_quince_only int")
    merged = harmonize.harmonized_merge(once, quince, "patient_id", QUESTIONS, {"var_review"})
    assert merged.first().asDict() == {
        "patient_id": "P1", "var_review__once": "A", "var_review__quince": "B", "var_review": "A",
        "var_review__needs_review_flag": True, "var_review__source_conflict_flag": True,
        # a variable of one source keeps that source's value
        "var_once_only": 1, "var_quince_only": 2,
    }


def test_values_fall_back_and_nulls_do_not_conflict(spark, rows):
    once = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), (None, 9)], "id string, v int")
    quince = spark.createDataFrame([("a", 1), ("b", 2), ("d", 4), (None, 8)], "id string, v int")
    merged = harmonize.harmonized_merge(once, quince, "id", ["v", "gone"], ["v", "gone"])
    assert rows(merged, "id", "v", "v__source_conflict_flag", "gone", "gone__source_conflict_flag") == [
        (None, 9, True, None, False), ("a", 1, False, None, False), ("b", 2, False, None, False),
        ("c", 3, False, None, False), ("d", 4, False, None, False),
    ]


def test_different_types_compare_as_text(spark, rows):
    once = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    quince = spark.createDataFrame([("a", "1"), ("b", "02")], "id string, v string")
    merged = harmonize.harmonized_merge(once, quince, "id", ["v"], ["v"])
    assert rows(merged, "id", "v", "v__source_conflict_flag") == [("a", "1", False), ("b", "2", True)]


def test_repeated_ids_fan_out(spark):
    once = spark.createDataFrame([("a", 1), ("a", 2)], "id string, v int")
    quince = spark.createDataFrame([("a", 3), ("a", 4), ("a", 5)], "id string, v int")
    assert harmonize.harmonized_merge(once, quince, "id", ["v"]).count() == 6


def test_source_names_are_a_parameter(spark):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    merged = harmonize.harmonized_merge(df, df, "id", ["v"], sources=("x", "y"))
    assert merged.columns == ["id", "v__x", "v__y", "v"]


def test_hundreds_of_variables_stay_one_join(spark, plan_of):
    names = [f"v{i}" for i in range(300)]
    df = spark.createDataFrame([tuple(range(301))], ", ".join(f"{c} int" for c in ["id", *names]))
    merged = harmonize.harmonized_merge(df, df, "id", names, names)
    assert len(merged.columns) == 1 + 300 * 5
    assert plan_of(merged).count("Join") == 1
    assert merged.first()["v7"] == 8


def test_coverage(spark, rows):
    codebook = harmonize.load_codebook(
        spark.createDataFrame(
            [("a", "y"), ("b", "n"), ("c", "n"), ("d", "y")], "QUESTION_NAME string, needs_review string"
        )
    )
    once = spark.createDataFrame([(1, 1, 1)], "id int, a int, b int")
    quince = spark.createDataFrame([(1, 1, 1)], "id int, a int, c int")
    coverage = harmonize.codebook_coverage(codebook, once, quince)
    assert rows(coverage, "question_name", "in_once", "in_quince", "shared_between_sources", "needs_review") == [
        ("a", True, True, True, True), ("b", True, False, False, False), ("c", False, True, False, False),
        ("d", False, False, False, True),
    ]
    assert rows(harmonize.coverage_counts(coverage)) == [(1, 1, 1, 2)]


def test_nan_gives_way_to_the_other_source(spark, rows):
    once = spark.createDataFrame([("a", float("nan")), ("b", 1.0)], "id string, v double")
    quince = spark.createDataFrame([("a", 2.0), ("b", float("nan"))], "id string, v double")
    merged = harmonize.harmonized_merge(once, quince, "id", ["v"], ["v"])
    assert rows(merged, "id", "v", "v__source_conflict_flag") == [("a", 2.0, False), ("b", 1.0, False)]
