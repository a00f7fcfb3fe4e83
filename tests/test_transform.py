import pytest
from pyspark.sql import functions as F

from concordat.operators import transform


def test_recode_cast_and_derive(spark, rows):
    df = spark.createDataFrame([("Diesel", "40"), (" ELECTRIC\t", "7.5"), ("steam", "-"), (None, None)], "fuel string, tank string")
    norm = transform.normalize_categories(df, {"fuel": {"diesel": "D", "Electric ": "E"}, "absent": {"a": "b"}})
    assert norm.columns == df.columns and rows(norm, "fuel") == [(None,), ("D",), ("E",), ("steam",)]
    cast = transform.cast_columns(norm, {"tank": "numeric", "absent": "date"})
    assert rows(cast, "tank") == [(None,), (None,), (40.0,), (7.5,)]
    derived = transform.derive(cast, {"half": "tank / 2", "left": lambda d: d["tank"] - d["half"]})
    assert rows(derived, "half", "left") == [(None, None), (None, None), (20.0, 20.0), (3.75, 3.75)]
    with pytest.raises(TypeError, match="bad"):
        transform.derive(cast, {"bad": 7})


def test_a_long_list_is_looked_up_by_hash(spark, rows, plan_of):
    df = spark.range(0, 30000, 3).select(F.concat(F.lit(" K"), "id").alias("k"), F.col("id").alias("n"), (F.col("id") % 2).alias("m"))
    long_list = {f"k{i}": f"v{i}" for i in range(10000)}
    norm = transform.normalize_categories(df, {"k": long_list, "m": {"1": "odd"}, "n": {}})
    assert "BroadcastHashJoin" in plan_of(norm) and "map(" not in plan_of(norm)
    expected = {i: (long_list.get(f"k{i}", f" K{i}"), "odd" if i % 2 else "0") for i in range(0, 30000, 3)}
    assert {int(r.n): (r.k, r.m) for r in norm.collect()} == expected


def test_other_casts_raise_on_bad_values(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        transform.cast_columns(df, {"v": "int"}).collect()
    assert transform.cast_columns(df.filter("v = '1'"), {"v": "boolean"}).first() == (True,)
    assert transform.cast_columns(df, {"v": "string"}).count() == 2


MAP = {"variables": {"FUEL": {"harmonized": "fuel_type", "rule": "by_hand"}, "KM": "distance", "DOORS": {"notes": "seen"}}}


def test_harmonized_names_and_trace(spark, rows):
    names = ["KM", " FUEL\t", None, "COLOUR", "", "DOORS", " "]
    df = spark.createDataFrame([(9 - i, n) for i, n in enumerate(names)], "back int, QUESTION_NAME string").repartition(3)
    named, trace = transform.harmonize_variables(df, MAP, "fleet", order_by=["back"])
    # places count from the row of the least key
    assert rows(named, "back", "HARMONIZED_VARIABLE") == [
        (3, "row_0"), (4, "DOORS"), (5, "row_2"), (6, "COLOUR"), (7, "row_4"), (8, "fuel_type"), (9, "distance"),
    ]
    assert named.columns == ["back", "QUESTION_NAME", "HARMONIZED_VARIABLE"]
    kept = ("fleet", "fallback_identity", "No mapping found; original variable retained")
    expected = [
        ("KM", "distance", "fleet", "direct_mapping", ""), ("FUEL", "fuel_type", "fleet", "by_hand", ""),
        ("DOORS", "DOORS", "fleet", "question_name_exact", "seen"),
        *[(source, target, *kept) for source, target in (("COLOUR", "COLOUR"), ("", "row_0"), ("", "row_2"), ("", "row_4"))],
    ]
    assert rows(trace) == sorted(expected)


def test_unnamed_rows_are_numbered_by_keys_and_locators(spark, monkeypatch):
    numbering, sorted_columns = transform.with_row_index, []

    def seen(table, order_by, name):
        sorted_columns.extend(table.columns)
        return numbering(table, order_by, name)

    monkeypatch.setattr(transform, "with_row_index", seen)
    df = spark.range(50).selectExpr("id AS k", "IF(id % 5 = 0, '', 'AGE') AS QUESTION_NAME", "repeat('x', 20) AS wide")
    named, _ = transform.harmonize_variables(df, {"AGE": "age"}, "s", order_by=["k"])
    assert sorted_columns == ["__at", "__unnamed", "__by0"]
    assert {r.k: r.HARMONIZED_VARIABLE for r in named.collect()} == {i: "age" if i % 5 else f"row_{i}" for i in range(50)}
    with pytest.raises(TypeError, match="order_by"):
        transform.harmonize_variables(df, MAP, "s")


def test_map_may_be_top_level_and_the_name_column_absent(spark, rows):
    df = spark.createDataFrame([(7,)], "i int")
    named, trace = transform.harmonize_variables(df, {"AGE": "age"}, "s", order_by=["i"])
    assert rows(named) == [(7, "row_0")]
    assert trace.columns == ["source_variable", "harmonized_variable", "source_study", "rule_applied", "observations"]


def test_small_map_is_broadcast_by_its_known_size(spark, plan_of, tmp_path):
    spark.createDataFrame([("AGE",)], "QUESTION_NAME string").write.parquet(str(tmp_path / "q"))
    named, _ = transform.harmonize_variables(spark.read.parquet(str(tmp_path / "q")), MAP, "once", order_by=["QUESTION_NAME"])
    text = plan_of(named)
    assert "BroadcastHashJoin" in text and "Python" not in text


def test_row_index_is_consecutive_over_partitions(spark, rows):
    df = spark.range(0, 1000, numPartitions=7).select((F.lit(999) - F.col("id")).alias("k"))
    numbered = transform.with_row_index(df.repartition(5), ["k"], "i")
    assert numbered.filter("k != i").isEmpty() and numbered.count() == 1000


def test_row_index_with_ties(spark):
    df = spark.range(0, 500, numPartitions=4).select((F.col("id") % 2).alias("k"))
    numbered = transform.with_row_index(df, ["k"], "i")
    assert sorted(r.i for r in numbered.collect()) == list(range(500))
    assert numbered.filter("(k = 0) != (i < 250)").isEmpty()
