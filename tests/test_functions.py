import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from concordat.functions import as_date, as_number, canonical_name, clean_text, is_missing, is_selected, is_truthy, strip
from concordat.functions.text import WHITESPACE

TEXT, DOUBLE = T.StringType(), T.DoubleType()


def evaluate(spark, values, expression, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_takes_every_kind_of_space(spark):
    values = ["  a b\t", " x　", "\x1c\n", "", None]
    assert evaluate(spark, values, strip) == ["a b", "x", "", "", None]


def test_missing_text_is_null_or_blank(spark):
    values = [None, "", " \t\n", " ", "x", " x "]
    assert evaluate(spark, values, lambda c: is_missing(c, TEXT)) == [True, True, True, True, False, False]


def test_missing_number_is_null_or_nan(spark):
    values = [None, float("nan"), 0.0, float("inf")]
    assert evaluate(spark, values, lambda c: is_missing(c, DOUBLE), "v double") == [True, True, False, False]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", 12.0), (" 7 ", 7.0), ("-1.5", -1.5), ("+3", 3.0), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0),
        ("1E-2", 0.01), ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("1d", None), ("1f", None), ("1_0", None), ("NaN", None), ("0x10", None), ("x12", None), ("", None),
        ("1 2", None), (".", None), ("1,5", None), (None, None),
    ],
)
def test_numbers_from_text(spark, text, number):
    assert evaluate(spark, [text], lambda c: as_number(c, TEXT)) == [number]


def test_numbers_from_numbers(spark):
    assert evaluate(spark, [1.5, float("nan"), None], lambda c: as_number(c, DOUBLE), "v double") == [1.5, None, None]
    assert evaluate(spark, [True, None], lambda c: as_number(c, T.BooleanType()), "v boolean") == [1.0, None]
    assert evaluate(spark, [dt.date(2020, 1, 1)], lambda c: as_number(c, T.DateType()), "v date") == [None]


def test_dates_follow_the_given_formats_whatever_the_row_order(spark):
    values = ["2020-01-05", " 2020-02-29 ", "2021-02-29", "05/01/2020", "2020", "bad", "", None]
    iso = evaluate(spark, values, lambda c: as_date(c, TEXT))
    assert iso == [dt.date(2020, 1, 5), dt.date(2020, 2, 29), *[None] * 6]
    both = evaluate(spark, values, lambda c: as_date(c, TEXT, ["yyyy-MM-dd", "dd/MM/yyyy"]))
    assert both == [dt.date(2020, 1, 5), dt.date(2020, 2, 29), None, dt.date(2020, 1, 5), *[None] * 4]


def test_truthy_and_selected_words(spark):
    values = [" YES ", "True", "1", "y", "X", "selected", "0", "no", "", None]
    assert evaluate(spark, values, is_truthy) == [True] * 5 + [False] * 5
    assert evaluate(spark, values, is_selected) == [True] * 6 + [False] * 4


def test_clean_text_options(spark):
    text = "  a\r\n\nb  \t c "
    assert evaluate(spark, [text], clean_text) == ["a b c"]
    assert evaluate(spark, [text], lambda c: clean_text(c, replace_newlines_with="$1|", uppercase=True)) == ["A$1|B C"]
    raw = evaluate(spark, [text], lambda c: clean_text(c, trim=False, replace_newlines=False, collapse_whitespace=False))
    assert raw == [text]
    assert evaluate(spark, [text], lambda c: clean_text(c, collapse_whitespace=False)) == ["a b  \t c"]
    assert evaluate(spark, [None], clean_text) == [None]


@pytest.mark.parametrize(
    "raw, name",
    [(" Visit Date\n", "visit_date"), ("A--B/ c", "a_b_c"), ("__x__", "x"), ("", ""), ("A\tB\rC", "a_b_c")],
)
def test_canonical_names(raw, name):
    assert canonical_name(raw) == name


def test_collapse_covers_every_kind_of_space(spark):
    text = "".join(f"{i}{c}" for i, c in enumerate(WHITESPACE)) + "éx‐y"
    expected = " ".join(str(i) for i in range(len(WHITESPACE))) + " éx‐y"
    assert evaluate(spark, [text], clean_text) == [expected]
    assert evaluate(spark, ["a\nb"], lambda c: clean_text(c, replace_newlines_with="")) == ["ab"]
    assert evaluate(spark, ["a\r\n\t b"], lambda c: clean_text(c, replace_newlines_with="\t")) == ["a b"]


def test_session_sizes():
    from concordat.session import sized_conf

    assert sized_conf(100 * 2**40, 4000)["spark.sql.shuffle.partitions"] == "819200"
    assert sized_conf(1, 8)["spark.sql.shuffle.partitions"] == "16"
