import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from concordat.model import MergeStep
from concordat.operators import merge

KINDS = ["left", "right", "inner", "outer"]


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "patient_id string")


def test_left_merge_metrics(spark):
    result = merge.perform_merge(keys(spark, "P1", "P2"), keys(spark, "P1"), "left", ["patient_id"], "demo")
    assert result.merged.count() == 2
    assert (result.metrics_row["both_count"], result.metrics_row["left_only_count"]) == (1, 1)
    assert result.metrics.first().asDict() == result.metrics_row
    assert result.issues.isEmpty()


def test_cardinality_mismatch(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    right = spark.createDataFrame([(1,), (2,)], "id int")
    result = merge.perform_merge(left, right, "left", ["id"], "demo", "one_to_one")
    assert result.metrics_row["observed_cardinality"] == "many_to_one"
    assert result.metrics_row["cardinality_matches_expectation"] is False
    assert rows(result.issues, "check_name", "severity") == [("cardinality_mismatch", "ERROR")]


@pytest.mark.parametrize(
    "left, right, observed, accepted",
    [([1, 2], [1, 2], "one_to_one", True), ([1, 2], [1, 1], "one_to_many", True), ([1, 1], [1, 2], "many_to_one", False),
     ([1, 1], [2, 2], "many_to_many", False)],
)
def test_one_to_one_or_many(spark, left, right, observed, accepted):
    l, r = (spark.createDataFrame([(v,) for v in side], "id int") for side in (left, right))
    row = merge.merge_metrics(merge.key_histogram(l, r, ["id"]), "left", "one_to_one_or_many").first()
    assert (row.observed_cardinality, row.cardinality_matches_expectation) == (observed, accepted)


def test_fan_out_and_match_rate_above_one(spark, rows):
    left = spark.createDataFrame([(1,), (1,)], "id int")
    right = spark.createDataFrame([(1,), (1,), (1,)], "id int")
    result = merge.perform_merge(left, right, "inner", ["id"], "demo")
    assert result.metrics_row["match_rate_against_left"] == 3.0
    assert result.metrics_row["unexpected_duplication"] == 3
    assert result.metrics_row["max_key_fanout"] == 6
    assert rows(result.issues, "check_name", "row_count") == [("unexpected_duplication", 3)]


def test_a_disjoint_outer_merge_counts_as_duplication(spark):
    result = merge.perform_merge(keys(spark, "a"), keys(spark, "b"), "outer", ["patient_id"], "demo")
    assert result.metrics_row["unexpected_duplication"] == 1


def test_shared_columns_keys_and_indicator(spark, rows):
    left = spark.createDataFrame([("k", 1, 10), (None, 2, 20), ("z", 3, 30)], "id string, v int, w int")
    right = spark.createDataFrame([(100, "k", 5), (200, None, 6), (300, "y", 7)], "u int, id string, v int")
    merged = merge.merge_rows(left, right, "outer", ["id"])
    assert merged.columns == ["id", "v", "w", "u", "v_right", "_merge"]
    assert rows(merged) == [
        (None, 2, 20, 200, 6, "both"), ("k", 1, 10, 100, 5, "both"), ("y", None, None, 300, 7, "right_only"),
        ("z", 3, 30, None, None, "left_only"),
    ]
    left_only, right_only = merge.extract_unmatched(merged)
    assert rows(left_only, "id") == [("z",)] and rows(right_only, "id") == [("y",)]


def test_self_merge(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(merge.merge_rows(df, df, "inner", ["id"])) == [(1, "a", "a", "both"), (2, "b", "b", "both")]


def test_columns_that_would_repeat_are_refused(spark):
    left = spark.createDataFrame([(1, 1, 1)], "id int, v int, v_right int")
    right = spark.createDataFrame([(1, 1)], "id int, v int")
    with pytest.raises(ValueError, match="v_right"):
        merge.merge_rows(left, right, "left", ["id"])


def test_cross(spark):
    left, right = keys(spark, "a", "b"), spark.createDataFrame([(1,), (2,), (3,)], "n int")
    result = merge.perform_merge(left, right, "cross", [], "demo")
    assert result.merged.count() == result.metrics_row["merged_rows"] == 6
    assert result.metrics_row["observed_cardinality"] == "many_to_many"
    with pytest.raises(ValueError):
        merge.merge_rows(left, right, "left", [])
    with pytest.raises(ValueError):
        merge.merge_rows(left, right, "sideways", ["n"])


def test_key_checks(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 1), ("b", None)], "p string, d int")
    right = spark.createDataFrame([("a", 1)], "p string, d int")
    result = merge.validate_merge_keys(left, right, ["p", "d"], "demo")
    assert result.succeeded()
    assert rows(result.metrics) == [("left", 2), ("right", 0)]
    assert rows(result.issues, "check_name", "row_count", "severity") == [("left_null_keys", 2, "WARNING")]
    assert merge.perform_merge(left, right, "left", ["p", "d"], "demo").key_findings() == [tuple(r) for r in result.issues.collect()]
    absent = merge.validate_merge_keys(left, right.drop("d"), ["p", "d", "q"], "demo")
    assert rows(absent.issues, "check_name", "column_name") == [
        ("missing_left_key", "q"), ("missing_right_key", "d"), ("missing_right_key", "q"),
    ]
    assert not absent.succeeded()


def pandas_merge(left, right, how):
    frames = [pd.DataFrame(side, columns=["a", "b", name]) for side, name in ((left, "x"), (right, "y"))]
    merged = frames[0].merge(frames[1], on=["a", "b"], how=how, indicator=True)
    clean = merged.astype(object).where(merged.notna(), None)
    return sorted(
        (tuple(str(v) if v is None or isinstance(v, str) else str(int(v)) for v in row) for row in clean.itertuples(index=False)),
    )


def random_side(seed, size):
    pick = random.Random(seed)
    return [(pick.choice(["p", "q", None, "r"]), pick.choice([1, 2, None]), i) for i in range(size)]


@pytest.mark.parametrize("how", KINDS)
@pytest.mark.parametrize("seed, sizes", [(1, (12, 9)), (3, (15, 0))])
@pytest.mark.parametrize("hot_rows", [2_000_000, 1])
def test_merge_matches_brute_force(spark, how, seed, sizes, hot_rows):
    """Rows, metrics and unmatched rows, with hot keys spread over tasks and without."""
    sides = random_side(seed, sizes[0]), random_side(seed + 100, sizes[1])
    left = spark.createDataFrame(sides[0], "a string, b int, x int").repartition(3)
    right = spark.createDataFrame(sides[1], "a string, b int, y int").repartition(2)
    result = merge.perform_merge(left, right, how, ["a", "b"], "demo", hot_rows=hot_rows)
    expected = pandas_merge(*sides, how)
    assert sorted(tuple(str(v) for v in row) for row in result.merged.collect()) == expected

    origins = [row[-1] for row in expected]
    metrics = result.metrics_row
    assert (metrics["left_rows"], metrics["right_rows"], metrics["merged_rows"]) == (*sizes, len(expected))
    assert metrics["both_count"] == origins.count("both")
    assert metrics["left_only_count"] == origins.count("left_only")
    assert metrics["right_only_count"] == origins.count("right_only")
    repeats = [len(side) - len({row[:2] for row in side}) > 0 for side in sides]
    assert metrics["observed_cardinality"] == "_to_".join("many" if r else "one" for r in repeats)
    if how == "left":
        unmatched = merge.unmatched_rows(left, right, ["a", "b"])
        assert unmatched.count() == origins.count("left_only")


@pytest.mark.parametrize("how", KINDS)
def test_hot_keys_on_one_side_only(spark, how):
    left = spark.range(0, 300, numPartitions=6).select(F.lit(None).cast("long").alias("k"), "id")
    right = spark.range(0, 200, numPartitions=5).select((F.col("id") % 2).alias("k"), F.col("id").alias("r"))
    plain = merge.merge_rows(left, right, how, ["k"])
    split = merge.perform_merge(left, right, how, ["k"], "demo", hot_rows=20).merged
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_hot_key_rows_spread_over_tasks(spark):
    left = spark.range(0, 4000, numPartitions=8).select(F.lit(7).alias("k"), F.col("id").alias("l"))
    right = spark.createDataFrame([(7, "a"), (8, "b")], "k int, r string")
    histogram = merge.key_histogram(left, right, ["k"])
    hot = merge.find_hot_keys(histogram, ["k"], 500)
    assert [(r.k, r.slices, r.split_left, r.on_both_sides) for r in hot.collect()] == [(7, 8, True, True)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = merge.merge_rows(left, right, "outer", ["k"], hot_keys=hot)
        sizes = split.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 4000 and len(sizes) > 1
    assert split.count() == 4001


def test_metrics_never_run_the_join(spark, plan_of, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan_of(merge.merge_metrics(merge.key_histogram(df, df, ["id"]), "outer"))
    assert "Join" not in text


def test_chain(spark, rows):
    tables = {
        "people": keys(spark, "P1", "P2"),
        "visits": spark.createDataFrame([("P1", "d1"), ("P1", "d2")], "patient_id string, day string"),
        "labs": spark.createDataFrame([("P1", "d2", 5), ("P2", None, 6)], "patient_id string, day string, v int"),
        "outcomes": spark.createDataFrame([("P2", "Y")], "patient_id string, o string"),
    }
    steps = [
        MergeStep("pv", "people", "visits", "left", ["patient_id"], "one_to_many"),
        MergeStep("pvl", "pv", "labs", "left", ["patient_id", "day"], "one_to_one_or_many"),
        MergeStep("all", "pvl", "outcomes", "left", ["patient_id"], "one_to_one"),
    ]
    results = merge.merge_chain(tables, steps)
    # P2 has no visit, so its day is null and meets the lab without a day
    assert rows(results["all"].table) == [("P1", "d1", None, None), ("P1", "d2", 5, None), ("P2", None, 6, "Y")]
    assert [r.check_name for r in results["all"].issues.collect()] == ["cardinality_mismatch"]
    assert results["pvl"].issues.isEmpty()


def test_keys_with_a_large_fan_out_are_spread_too(spark):
    left = spark.range(0, 60, numPartitions=4).select(F.lit("k").alias("k"), F.col("id").alias("l"))
    right = spark.range(0, 50, numPartitions=4).select(F.lit("k").alias("k"), F.col("id").alias("r"))
    hot = merge.hot_keys_of(left, right, ["k"], hot_rows=10)
    assert [(r.slices, r.split_left) for r in hot.collect()] == [(6, True)]
    # 3000 joined rows are more than a hundred times 25, and 60 rows more than twice as many
    assert [r.slices for r in merge.hot_keys_of(left, right, ["k"], hot_rows=25).collect()] == [3]
    assert merge.hot_keys_of(left.limit(20), right, ["k"], hot_rows=60) is None
    merged = merge.perform_merge(left, right, "outer", ["k"], "demo", hot_rows=10).merged
    assert merged.count() == merged.distinct().count() == 3000
    assert merge.hot_keys_of(left, right, ["k"]) is None


def test_metrics_of_counts_whose_product_is_no_long(spark):
    histogram = spark.createDataFrame([(1, 4_000_000_000, 4_000_000_000), (2, 1, 0)], "id int, left_n long, right_n long")
    row = merge.merge_metrics(histogram, "left").first().asDict()
    assert row["both_count"] == row["max_key_fanout"] == row["merged_rows"] == 2**63 - 1
    assert (row["left_rows"], row["left_only_count"]) == (4_000_000_001, 1)
    assert "merged_rows_overflow" in [found[2] for found in merge.merge_findings(row, "m")]
    histogram = spark.createDataFrame([(1, 2_000_000_000, 3_000_000_000)], "id int, left_n long, right_n long")
    assert merge.merge_metrics(histogram, "left").first()["both_count"] == 6 * 10**18


def test_two_hot_keys_keep_the_broadcast_join(spark, plan_of, tmp_path):
    spark.range(0, 4000).selectExpr("id % 2 as k", "id as l").write.parquet(str(tmp_path / "left"))
    left = spark.read.parquet(str(tmp_path / "left"))
    spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, r string").write.parquet(str(tmp_path / "right"))
    right = spark.read.parquet(str(tmp_path / "right"))
    result = merge.perform_merge(left, right, "left", ["k"], "demo", hot_rows=20)
    plan = plan_of(result.merged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert result.metrics_row["merged_rows"] == result.merged.count() == 4000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = merge.perform_merge(left, right, "left", ["k"], "demo", hot_rows=20)
        assert "SortMergeJoin" in plan_of(spread.merged) and "slices" in plan_of(spread.merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spread.metrics_row == result.metrics_row
    assert sorted(map(str, spread.merged.collect())) == sorted(map(str, result.merged.collect()))


def test_the_audit_comes_before_the_join(spark, monkeypatch, tmp_path):
    """A key of four thousand million rows on either side gives a finding, not an attempt."""
    from concordat.model import DatasetSpec
    from concordat.plans import curate_and_merge

    def histogram(left, right, on):
        return spark.createDataFrame([("P1", 4_000_000_000, 4_000_000_000)], f"{on[0]} string, left_n long, right_n long")

    monkeypatch.setattr(merge, "key_histogram", histogram)
    left, right = keys(spark, "P1"), keys(spark, "P1")
    for how in ("inner", "outer"):
        result = merge.perform_merge(left, right, how, ["patient_id"], "demo")
        assert result.refused and result.merged.count() == 0 and result.metrics_row["merged_rows"] == merge.MOST_ROWS
        assert "merged_rows_overflow" in [r[2] for r in result.findings()]
    budget = merge.perform_merge(left, right, "outer", ["patient_id"], "demo", row_budget=1)
    assert budget.refused
    with pytest.raises(ValueError, match="more rows than can be counted"):
        merge.merge_chain({"a": left, "b": right}, [MergeStep("ab", "a", "b", "outer", ["patient_id"])])
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("patient_id\nP1\n")
    specs = [DatasetSpec(name, str(tmp_path / f"{name}.csv")) for name in ("a", "b")]
    run = curate_and_merge(spark, specs, [MergeStep("ab", "a", "b", "outer", ["patient_id"])], out_dir=str(tmp_path / "out"))
    assert run.issues.where("check_name = 'merged_rows_overflow'").count() == 1 and run.merges == {}


def test_a_row_budget(spark):
    left, right = keys(spark, "P1", "P1", "P1"), keys(spark, "P1", "P1")
    few = merge.perform_merge(left, right, "inner", ["patient_id"], "demo", row_budget=6)
    assert few.refused and ("merge_refused", 6) in [(r[2], r[6]) for r in few.findings()]
    assert merge.perform_merge(left, right, "inner", ["patient_id"], "demo", row_budget=7).merged.count() == 6
