import pytest

from concordat.operators.contract import (
    ContractError,
    DatasetSchemaSpec,
    SchemaRegistry,
    build_schema_from_spec,
    coerce_to_contract,
    contract_failures,
)

SPEC = DatasetSchemaSpec(
    required_columns=["tank", "litres", "checked"],
    dtypes={"tank": "string", "litres": "numeric", "checked": "date"},
    nullable_columns=["litres", "checked"],
    allowed_values={"tank": ["north", "south"]},
    ranges={"litres": {"min": 0.5, "max": 2000}},
)


def test_registered_contracts_give_typed_tables(spark, rows):
    registry = SchemaRegistry()
    registry.register("tanks", SPEC)
    cells = [("north", "0.5", "2024-02-29", True), ("south", "2e3", None, None), ("south", None, "1999-12-31", False)]
    valid = registry.validate("tanks", spark.createDataFrame(cells, "tank string, litres string, checked string, open boolean"))
    assert valid.dtypes == [("tank", "string"), ("litres", "double"), ("checked", "date"), ("open", "boolean")]
    assert [str(r.checked) for r in valid.orderBy("checked").collect()] == ["None", "1999-12-31", "2024-02-29"]
    assert rows(valid, "tank", "litres") == [("north", 0.5), ("south", None), ("south", 2000.0)]


def test_all_failures_are_collected_before_raising(spark, rows):
    spec = DatasetSchemaSpec(
        ["id", "age", "sex", "gone"], {"age": "int64"}, ["age"], {"sex": ["M", "F"]}, {"age": {"min": 0, "max": 120}}
    )
    df = spark.createDataFrame(
        [(None, "x", "M"), ("A", "-1", "Q"), ("B", "121", "Q"), ("C", None, None), ("D", "5", "F")],
        "id string, age string, sex string",
    )
    registry = SchemaRegistry()
    registry.register("demo", spec)
    with pytest.raises(ContractError, match="demo breaks its contract") as raised:
        registry.validate("demo", df)
    assert rows(raised.value.failures) == [
        ("age", "coerce_dtype", "x", 1),
        ("age", "greater_than_or_equal_to", "-1", 1),
        ("age", "less_than_or_equal_to", "121", 1),
        ("gone", "column_in_dataframe", "gone", 1),
        ("id", "not_nullable", None, 1),
        ("sex", "isin", "Q", 2),
        ("sex", "not_nullable", None, 1),
    ]


def test_only_absent_columns(spark, rows):
    df = spark.createDataFrame([(1,)], "x int")
    assert rows(contract_failures(df, DatasetSchemaSpec(["y"]))) == [("y", "column_in_dataframe", "y", 1)]


def test_dates_numbers_and_booleans(spark):
    df = spark.createDataFrame([("2020-01-01", "1e1", "true")], "d string, n string, b string")
    spec = DatasetSchemaSpec(["d", "n", "b"], {"d": "date", "n": "numeric", "b": "bool"})
    assert coerce_to_contract(df, spec).dtypes == [("d", "date"), ("n", "double"), ("b", "boolean")]
    assert contract_failures(df, spec).isEmpty()


def test_registry_lookup():
    with pytest.raises(KeyError, match="not registered"):
        SchemaRegistry().get("nope")
    assert build_schema_from_spec(SPEC) is SPEC
