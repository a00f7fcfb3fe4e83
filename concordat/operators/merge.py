"""Audited joins.

Keys match null-safely: a null key equals a null key. The audit rests on the *key histogram*, the
number of rows per key on either side. It is one aggregation over the keys of both tables, and it
yields every metric without running the join, as well as the keys hot enough to need splitting.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.text import ref
from ..model import CheckResult, ERROR, MergeStep, WARNING, issue, issues_frame, local_table
from ..session import discard, settings, stored
from .probes import Probe, probe_findings, probe_issues, run_probes

INDICATOR = "_merge"
HOW = ("left", "right", "inner", "outer", "cross")

# A key is spread over several tasks when it has more than this many rows on a side, or joins to more
# than a hundred times as many rows. The same numbers bound a slice.
HOT_KEY_ROWS = 2_000_000
HOT_KEY_FANOUT = 100
# A task of a join sorts about as many rows of both sides, or as many shuffled bytes where that is more rows: its
# memory does not grow with the tables.
TASK_ROWS = 250_000
TASK_BYTES = 16 * 1024 * 1024
# The largest long: what a count beyond it is reported as.
MOST_ROWS = 2**63 - 1

# An expectation that several observed cardinalities satisfy.
EXPECTATIONS = {"one_to_one_or_many": ("one_to_one", "one_to_many")}


# --- key checks -------------------------------------------------------------------------------


def validate_merge_keys(left: DataFrame, right: DataFrame, on: Sequence[str], step_name: str) -> CheckResult:
    """Keys absent from a side are errors; rows with a null key part are warnings."""
    spark, name = left.sparkSession, f"{step_name}_merge_key_validation"
    absent = absent_keys(left, right, on, step_name)
    if absent or not on:
        empty = local_table(spark, [], "side string, null_key_rows long")
        return CheckResult(name, step_name, empty, issues_frame(spark, absent))
    lines = reduce(
        DataFrame.unionByName,
        [
            run_probes(df, [_null_key_probe(step_name, side, condition=_has_null(on))])
            for side, df in (("left", left), ("right", right))
        ],
    )
    metrics = lines.select(F.col("detail").alias("side"), F.col("failing_rows").alias("null_key_rows"))
    return CheckResult(name, step_name, metrics, probe_issues(lines, step_name))


def absent_keys(left: DataFrame, right: DataFrame, on: Sequence[str], step_name: str) -> list[tuple]:
    return [
        issue(step_name, "merge", f"missing_{side}_key", ERROR, f"Missing {side} key column: {key}", column_name=key)
        for key in on
        for side, df in (("left", left), ("right", right))
        if key not in df.columns
    ]


def _has_null(on: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [ref(k).isNull() for k in on])


def _null_key_probe(step_name: str, side: str, **count: Any) -> Probe:
    return Probe(
        f"{step_name}_merge_key_validation", "merge", f"{side}_null_keys", WARNING,
        f"{{n}} {side} rows contain null merge keys", detail=side, **count,
    )


# --- histogram and metrics --------------------------------------------------------------------


def key_histogram(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows per key on each side: columns of ``on``, then ``left_n`` and ``right_n``.

    A union under one aggregation, so only keys are shuffled, once, already counted per task.
    """
    keys = [ref(k) for k in on]
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return both.groupBy(*keys).agg(F.sum("l").alias("left_n"), F.sum("r").alias("right_n"))


def _wide(count: Column) -> Column:
    """A count whose products and sums are exact, where those of longs overflow."""
    return count.cast("decimal(19,0)")


def _histogram_sums(how: str, on: Sequence[str] = ()) -> list[Column]:
    """What ``merge_metrics`` needs of a key histogram, as aggregates."""
    left_n, right_n = F.col("left_n"), F.col("right_n")
    zero = F.lit(0).cast("long")
    pairs = _wide(left_n) * _wide(right_n)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    extras = []
    if on:
        extras = [
            total(F.when(_has_null(on), left_n)).alias("left_null_keys"),
            total(F.when(_has_null(on), right_n)).alias("right_null_keys"),
        ]
    return [
        total(left_n).alias("left_rows"),
        total(right_n).alias("right_rows"),
        total(pairs).alias("both_count"),
        (total(F.when(right_n == 0, left_n)) if how in ("left", "outer") else F.max(zero)).alias("left_only_count"),
        (total(F.when(left_n == 0, right_n)) if how in ("right", "outer") else F.max(zero)).alias("right_only_count"),
        total(F.when(left_n > 1, left_n - 1)).alias("left_repeats"),
        total(F.when(right_n > 1, right_n - 1)).alias("right_repeats"),
        F.coalesce(F.max(pairs), zero).alias("max_key_fanout"),
        *extras,
    ]


def merge_metrics(
    histogram: DataFrame, how: str, expected_cardinality: str | None = None, on: Sequence[str] = ()
) -> DataFrame:
    """The one-row audit of a join, computed from the key histogram; with ``on`` also rows per side with a null key part."""
    return _audit(histogram.agg(*_histogram_sums(how, on)), expected_cardinality)


def _audit(sums: DataFrame, expected_cardinality: str | None) -> DataFrame:
    one_side = F.coalesce("left_only_count", F.lit(0)), F.coalesce("right_only_count", F.lit(0))
    sums = sums.withColumns({"left_only_count": one_side[0].cast("long"), "right_only_count": one_side[1].cast("long")})
    merged = F.col("both_count") + F.col("left_only_count") + F.col("right_only_count")
    return _finish_metrics(sums.withColumn("merged_rows", merged), expected_cardinality)


def cross_metrics(left: DataFrame, right: DataFrame, expected_cardinality: str | None = None) -> DataFrame:
    """Audit of a cross join, from the two row counts."""
    rows, none = F.count(F.lit(1)), F.lit(0).cast("long")
    counted = left.agg(rows.alias("l"), none.alias("r")).unionByName(right.agg(none.alias("l"), rows.alias("r")))
    sides = counted.agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    product = _wide(F.col("left_rows")) * _wide(F.col("right_rows"))
    sums = sides.select(
        "left_rows", "right_rows", product.alias("both_count"), none.alias("left_only_count"),
        none.alias("right_only_count"), F.greatest(F.col("left_rows") - 1, none).alias("left_repeats"),
        F.greatest(F.col("right_rows") - 1, none).alias("right_repeats"), product.alias("max_key_fanout"),
        product.alias("merged_rows"),
    )
    return _finish_metrics(sums, expected_cardinality)


def _finish_metrics(sums: DataFrame, expected: str | None) -> DataFrame:
    repeats = (F.col("left_repeats") > 0, F.col("right_repeats") > 0)
    observed = F.concat(
        F.when(repeats[0], F.lit("many")).otherwise(F.lit("one")),
        F.lit("_to_"),
        F.when(repeats[1], F.lit("many")).otherwise(F.lit("one")),
    )
    larger = F.greatest("left_rows", "right_rows")

    def counted(value: Column) -> Column:
        """An exact count as a long; the largest long stands for all beyond it."""
        return F.least(value, F.lit(MOST_ROWS)).cast("long")

    accepted = EXPECTATIONS.get(expected, (expected,)) if expected else None
    meets = observed.isin(*accepted) if accepted else F.lit(None).cast("boolean")
    return sums.select(
        "left_rows",
        "right_rows",
        counted(F.col("merged_rows")).alias("merged_rows"),
        counted(F.col("both_count")).alias("both_count"),
        "left_only_count",
        "right_only_count",
        F.round(F.col("both_count").cast("double") / F.greatest(F.col("left_rows"), F.lit(1)), 4).alias("match_rate_against_left"),
        F.col("left_only_count").alias("unmatched_left"),
        F.col("right_only_count").alias("unmatched_right"),
        counted(F.greatest(F.col("merged_rows") - larger, F.lit(0))).alias("unexpected_duplication"),
        observed.alias("observed_cardinality"),
        F.lit(expected).cast("string").alias("expected_cardinality"),
        meets.alias("cardinality_matches_expectation"),
        counted(F.col("max_key_fanout")).alias("max_key_fanout"),
        *[c for c in ("left_null_keys", "right_null_keys") if c in sums.columns],
    )


def merge_findings(metrics: Mapping[str, Any], step_name: str, row_budget: int = MOST_ROWS) -> list[tuple]:
    """Issue rows of one metrics row; a merge of ``row_budget`` rows or more is one that is not run."""
    rows, extra = [], metrics["unexpected_duplication"]
    if row_budget <= metrics["merged_rows"] < MOST_ROWS:
        rows.append(
            issue(step_name, "merge", "merge_refused", ERROR,
                  f"Merged table would have {metrics['merged_rows']} rows, the budget is {row_budget}",
                  row_count=metrics["merged_rows"])
        )
    if metrics["merged_rows"] >= MOST_ROWS:
        rows.append(
            issue(step_name, "merge", "merged_rows_overflow", ERROR,
                  "Merged table would have more rows than can be counted", row_count=MOST_ROWS)
        )
    if extra > 0:
        rows.append(
            issue(step_name, "merge", "unexpected_duplication", WARNING,
                  f"Merged table contains {extra} unexpected duplicated rows compared to source tables",
                  row_count=extra)
        )
    if metrics["cardinality_matches_expectation"] is False:
        rows.append(
            issue(step_name, "merge", "cardinality_mismatch", ERROR,
                  f"Observed cardinality {metrics['observed_cardinality']} does not match expected "
                  f"{metrics['expected_cardinality']}")
        )
    return rows


def merge_issues(metrics: DataFrame, step_name: str) -> DataFrame:
    """Findings about a metrics table, which has one row."""
    return issues_frame(metrics.sparkSession, merge_findings(metrics.first().asDict(), step_name))


# --- the join ---------------------------------------------------------------------------------


def _key_load(hot_rows: int) -> Column:
    """How many slices' worth of work a key of the histogram is."""
    left_n, right_n = F.col("left_n").cast("double"), F.col("right_n").cast("double")
    return F.greatest(left_n, right_n, left_n * right_n / HOT_KEY_FANOUT) / hot_rows


def _hot_rows_of(histogram: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    load = _key_load(hot_rows)
    return histogram.filter(load > 1).select(
        *[ref(k) for k in on],
        F.ceil(load).cast("long").alias("slices"),
        (F.col("left_n") >= F.col("right_n")).alias("split_left"),
        (F.least("left_n", "right_n") > 0).alias("on_both_sides"),
    )


def find_hot_keys(histogram: DataFrame, on: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys worth more than one slice, as a stored table: no more than rows divided by ``hot_rows``, or pairs by its
    hundredfold. They never pass through the driver."""
    return stored(_hot_rows_of(histogram, on, hot_rows))


def audited_hot_keys(
    histogram: DataFrame, how: str, on: Sequence[str], hot_rows: int = HOT_KEY_ROWS
) -> tuple[dict[str, Any], DataFrame]:
    """The sums of a join's audit and its hot keys, stored, from one pass over the histogram."""
    seen = Observation()
    hot = find_hot_keys(histogram.observe(seen, *_histogram_sums(how, on)), on, hot_rows)
    return seen.get, hot


def will_broadcast(left: DataFrame, right: DataFrame, how: str) -> bool:
    """Whether the planner, by the sizes it knows, copies one side to every task: no row of a join then moves by its key."""
    sides = {"left": [right], "right": [left], "inner": [left, right]}.get(how, [])
    limit = left.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return any(int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit for side in sides)


def hot_keys_of(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot_rows: int = HOT_KEY_ROWS, how: str = "outer"
) -> DataFrame | None:
    """Hot keys of a join as a stored table, from one pass over the keys; None if there are none or a side is broadcast."""
    return None if will_broadcast(left, right, how) else _unless_empty(find_hot_keys(key_histogram(left, right, on), on, hot_rows))


def _unless_empty(hot: DataFrame) -> DataFrame | None:
    if hot.isEmpty():
        discard(hot)
        return None
    return hot


def _null_safe(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def _sliced(side: DataFrame, keys: Sequence[str], hot: DataFrame, splits: Column, slice_name: str) -> DataFrame:
    """Give every row its slice: 0 for ordinary keys; of a hot key, the larger side is dealt out by
    row hash and input partition, and the smaller side is copied to every slice.

    Neither the hash of a row nor its input partition changes when a task runs again, so its slice does not. The hash
    spreads a key whose rows lie in one partition; the partition spreads rows that are equal.
    """
    hashed = [f.name for f in side.schema if not re.search("map<|variant", f.dataType.simpleString())]
    tagged = (
        side.withColumn("__pid", F.xxhash64(*hashed, F.spark_partition_id()))
        .join(hot, _null_safe([(k, f"h{i}") for i, k in enumerate(keys)]), "left")
    )
    slices = F.col("slices")
    first = F.lit(0).cast("long")
    dealt = F.array(F.pmod(F.col("__pid"), slices))
    everywhere = F.sequence(first, slices - 1)
    chosen = F.when(slices.isNull(), F.array(first)).when(splits, dealt).otherwise(everywhere)
    return tagged.withColumn(slice_name, F.explode(chosen)).select(
        *side.columns, slice_name, F.coalesce("on_both_sides", F.lit(False)).alias(f"{slice_name}_pairs")
    )


def merge_rows(
    left: DataFrame,
    right: DataFrame,
    how: str,
    on: Sequence[str] = (),
    *,
    suffixes: tuple[str, str] = ("", "_right"),
    indicator: str | None = INDICATOR,
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """Join with each key emitted once, clashing columns suffixed and the origin of every row named.

    Broadcast or sort-merge is left to the planner, which knows the sizes. ``hot_keys`` (see
    ``hot_keys_of``) spreads the named keys over several tasks; the rows are the same without.
    ``perform_merge`` finds them by itself.
    """
    if how not in HOW:
        raise ValueError(f"Unsupported join type: {how}")
    if (how == "cross") != (not on):
        raise ValueError("A cross join takes no keys and every other join needs them")
    # positional names: no ambiguity, whatever the tables are called or share
    left_names, right_names = left.columns, right.columns
    l_cols, r_cols = [f"l{i}" for i in range(len(left_names))], [f"r{i}" for i in range(len(right_names))]
    marked_left = left.toDF(*l_cols).withColumn("in_left", F.lit(True))
    marked_right = right.toDF(*r_cols).withColumn("in_right", F.lit(True))
    l_keys = [l_cols[left_names.index(k)] for k in on]
    r_keys = [r_cols[right_names.index(k)] for k in on]

    if how == "cross":
        joined = marked_left.crossJoin(marked_right)
    elif hot_keys is None:
        joined = marked_left.join(marked_right, _null_safe(list(zip(l_keys, r_keys))), how)
    else:
        hot = hot_keys.toDF(*[f"h{i}" for i in range(len(on))], "slices", "split_left", "on_both_sides")
        sliced_left = _sliced(marked_left, l_keys, hot, F.col("split_left"), "s_left")
        sliced_right = _sliced(marked_right, r_keys, hot, ~F.col("split_left"), "s_right")
        pairs = [*zip(l_keys, r_keys), ("s_left", "s_right")]
        joined = sliced_left.join(sliced_right, _null_safe(pairs), how)
        # where both sides hold the hot key every row has a partner: an unmatched copy met an empty slice
        pairs_up = F.coalesce("s_left_pairs", "s_right_pairs")
        joined = joined.filter(~pairs_up | (F.col("in_left").isNotNull() & F.col("in_right").isNotNull()))

    key_of = dict(zip(on, zip(l_keys, r_keys)))
    shared = set(left_names) & set(right_names) - set(on)
    columns = []
    for name, column in zip(left_names, l_cols):
        if name in key_of:
            columns.append(F.coalesce(*key_of[name]).alias(name))
        else:
            columns.append(F.col(column).alias(name + suffixes[0] if name in shared else name))
    for name, column in zip(right_names, r_cols):
        if name not in key_of:
            columns.append(F.col(column).alias(name + suffixes[1] if name in shared else name))
    if indicator:
        origin = (
            F.when(F.col("in_right").isNull(), F.lit("left_only"))
            .when(F.col("in_left").isNull(), F.lit("right_only"))
            .otherwise(F.lit("both"))
        )
        columns.append(origin.alias(indicator))
    result = joined.select(*columns)
    repeated = sorted({c for c in result.columns if result.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"The join would produce these columns twice: {repeated}")
    return result


@dataclass(frozen=True)
class MergeResult:
    """Joined rows with their origin, and the audit as plain values of one row."""

    step_name: str
    merged: DataFrame
    metrics_row: dict[str, Any]
    null_keys: dict[str, int]
    schema: T.StructType
    row_budget: int = MOST_ROWS

    @property
    def refused(self) -> bool:
        """The audit counts too many rows: ``merged`` has the columns and no row."""
        return self.metrics_row["merged_rows"] >= self.row_budget

    @property
    def table(self) -> DataFrame:
        return self.merged.drop(INDICATOR)

    def write_settings(self) -> dict[str, str]:
        """Session settings to write ``merged`` with: partitions by the rows the audit counted, which adaptive execution
        merges to TASK_BYTES; one open file per origin of rows instead of a sort of all rows. What the session names
        beyond them stays."""
        conf = self.merged.sparkSession.conf
        sides = self.metrics_row["left_rows"] + self.metrics_row["right_rows"]
        partitions = max(int(conf.get("spark.sql.shuffle.partitions")), -(-sides // TASK_ROWS))
        found = {"spark.sql.shuffle.partitions": str(partitions)}
        if int(conf.get("spark.sql.maxConcurrentOutputFileWriters")) < 3:
            found["spark.sql.maxConcurrentOutputFileWriters"] = "8"
        if conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None:
            found["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(TASK_BYTES)
        return found

    @property
    def metrics(self) -> DataFrame:
        return local_table(self.merged.sparkSession, [tuple(self.metrics_row.values())], self.schema)

    def findings(self) -> list[tuple]:
        return merge_findings(self.metrics_row, self.step_name, self.row_budget)

    @property
    def issues(self) -> DataFrame:
        return issues_frame(self.merged.sparkSession, self.findings())

    def key_findings(self) -> list[tuple]:
        probes = [_null_key_probe(self.step_name, side, count_name=f"{side}_null_keys") for side in ("left", "right")]
        return [row for _, row in probe_findings(self.null_keys, probes, self.step_name)]

    def unmatched(self) -> tuple[DataFrame, DataFrame]:
        return extract_unmatched(self.merged)


def perform_merge(
    left: DataFrame,
    right: DataFrame,
    how: str,
    on: Sequence[str],
    step_name: str,
    expected_cardinality: str | None = None,
    hot_rows: int = HOT_KEY_ROWS,
    row_budget: int = MOST_ROWS,
) -> MergeResult:
    """Audited join. One pass over the key histogram gives the metrics and the hot keys; the join is spread accordingly.

    The audit comes first: a join of ``row_budget`` rows or more is refused with a finding, before anything is sliced.
    """
    null_keys = {"left_null_keys": 0, "right_null_keys": 0}
    hot = None
    if how == "cross":
        metrics = cross_metrics(left, right, expected_cardinality)
        row = metrics.first().asDict()
    else:
        histogram = key_histogram(left, right, on)
        if will_broadcast(left, right, how):
            metrics = merge_metrics(histogram, how, expected_cardinality, on)
        else:
            sums, hot = audited_hot_keys(histogram, how, on, hot_rows)
            schema = histogram.limit(0).agg(*_histogram_sums(how, on)).schema
            metrics = _audit(local_table(left.sparkSession, [tuple(sums[c] for c in schema.names)], schema), expected_cardinality)
        row = metrics.first().asDict()
        null_keys = {name: row.pop(name) for name in null_keys}
    schema = T.StructType([f for f in metrics.schema.fields if f.name in row])
    refused = row["merged_rows"] >= row_budget
    if refused:
        merged = merge_rows(left, right, how, on).limit(0)
    else:
        merged = merge_rows(left, right, how, on, hot_keys=hot if hot is None else _unless_empty(hot))
    return MergeResult(step_name, merged, row, null_keys, schema, row_budget)


def extract_unmatched(merged: DataFrame, indicator: str = INDICATOR) -> tuple[DataFrame, DataFrame]:
    origin = F.col(indicator)
    return merged.filter(origin == "left_only"), merged.filter(origin == "right_only")


def unmatched_rows(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``, without joining the two tables whole."""
    keys = other.select(*[ref(k).alias(f"__o{i}") for i, k in enumerate(on)]).distinct()
    condition = reduce(lambda a, b: a & b, [ref(k).eqNullSafe(F.col(f"__o{i}")) for i, k in enumerate(on)])
    return df.join(keys, condition, "left_anti")


def merge_chain(tables: Mapping[str, DataFrame], steps: Sequence[MergeStep]) -> dict[str, MergeResult]:
    """Run an ordered plan; every step may use the tables and the steps before it.

    A result that a later step uses is stored first, so that no step runs the ones before it again.
    """
    working, results = dict(tables), {}
    for position, step in enumerate(steps):
        result = perform_merge(
            working[step.left], working[step.right], step.how, list(step.on), step.name, step.expected_relationship
        )
        if result.refused:
            raise ValueError("; ".join(row[4] for row in result.findings()))
        if any(step.name in (later.left, later.right) for later in steps[position + 1 :]):
            with settings(result.merged.sparkSession, result.write_settings()):
                result = replace(result, merged=stored(result.merged))
        results[step.name] = result
        working[step.name] = result.table
    return results
