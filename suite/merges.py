"""Audited joins over the given tables. Null keys, which match each other, are planted on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.model import MergeStep
from concordat.operators import merge

from .checks import ISSUE_FIELDS
from .registry import query, table


def left_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.when(F.col("lang") != "de", F.col("lang")).alias("lang"), "source")


def right_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit("label").alias("source"))


def keyless_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order loses its key, and orders of one status have keys without line items."""
    orders = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderstatus") == "P", -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    first = F.when(F.col("o_orderkey") != 1, key)
    return orders.select(first.alias("orderkey"), "o_totalprice", F.col("o_orderstatus").alias("status"))


def keyless_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the line items lose their key: one hot null key."""
    key = F.when(F.col("l_returnflag") != "N", F.col("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select(
        key.alias("orderkey"), "l_linenumber", "l_quantity", F.col("l_linestatus").alias("status")
    )


def _merged(left: DataFrame, right: DataFrame, how: str, key: str) -> DataFrame:
    """Joined rows of an audited merge, which looks for hot keys first."""
    return merge.perform_merge(left, right, how, [key], "demo").merged


KEYED = """
o as (
  select case when o_orderkey = 1 then null when o_orderstatus = 'P' then -o_orderkey else o_orderkey end as k,
         o_totalprice, o_orderstatus, true as _l from orders
), l as (
  select case when l_returnflag <> 'N' then l_orderkey end as k, l_linenumber, l_quantity, l_linestatus, true as _r
  from lineitem
)"""
ORIGIN = "case when _r is null then 'left_only' when _l is null then 'right_only' else 'both' end"


def _joined(kind: str) -> str:
    return f"""with {KEYED}
    select coalesce(o.k, l.k) as orderkey, o_totalprice, o_orderstatus as status, l_linenumber, l_quantity,
           l_linestatus as status_right, {ORIGIN} as _merge
    from o {kind} join l on o.k is not distinct from l.k"""


@query(
    f"""with d as (select doc_id, nullif(lang, 'de') as lang, source, true as _l from documents),
    b as (select doc_id, quality, 'label' as source, true as _r from labels)
    select coalesce(d.doc_id, b.doc_id) as doc_id, lang, d.source as source, quality, b.source as source_right,
           {ORIGIN} as _merge
    from d left join b on d.doc_id is not distinct from b.doc_id"""
)
def merge_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(left_documents(spark, sf_dir), right_labels(spark, sf_dir), "left", "doc_id")


@query(_joined("right"))
def merge_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir), "right", "orderkey")


@query(_joined("inner"))
def merge_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir), "inner", "orderkey")


@query(_joined("full"))
def merge_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir), "outer", "orderkey")


@query(_joined("full"))
def merge_outer_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the hot null key found in the histogram and spread over tasks."""
    left, right = keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir)
    return merge.perform_merge(left, right, "outer", ["orderkey"], "orders_lines", hot_rows=1000).merged


@query(
    """select n_nationkey, n_name, n_regionkey, r_regionkey, r_name, 'both' as _merge from nation cross join region"""
)
def merge_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_rows(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), "cross")


@query(
    f"""with {KEYED}
    select 'left' as side, cast(count(*) filter (where k is null) as bigint) as null_key_rows from o
    union all select 'right', cast(count(*) filter (where k is null) as bigint) from l"""
)
def merge_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir)
    return merge.validate_merge_keys(left, right, ["orderkey"], "orders_lines").metrics


def _metrics_sql(kind: str, expected: str) -> str:
    """Metrics by running the join, which the Spark side never does."""
    return f"""with {KEYED}, m as (
      select {ORIGIN} as _merge from o {kind} join l on o.k is not distinct from l.k),
    c as (select (select count(*) from o) as ln, (select count(*) from l) as rn, count(*) as mn,
      count(*) filter (where _merge = 'both') as b, count(*) filter (where _merge = 'left_only') as lo,
      count(*) filter (where _merge = 'right_only') as ro from m),
    f as (select max(o.n * l.n) as f from (select k, count(*) as n from o group by k) o
          join (select k, count(*) as n from l group by k) l on o.k is not distinct from l.k)
    select cast(ln as bigint) as left_rows, cast(rn as bigint) as right_rows, cast(mn as bigint) as merged_rows,
      cast(b as bigint) as both_count, cast(lo as bigint) as left_only_count, cast(ro as bigint) as right_only_count,
      round(b / cast(greatest(ln, 1) as double), 4) as match_rate_against_left,
      cast(lo as bigint) as unmatched_left, cast(ro as bigint) as unmatched_right,
      cast(greatest(mn - greatest(ln, rn), 0) as bigint) as unexpected_duplication,
      'one_to_many' as observed_cardinality, '{expected}' as expected_cardinality,
      {"true" if "many" in expected and expected.startswith("one") else "false"} as cardinality_matches_expectation,
      cast(f as bigint) as max_key_fanout
    from c, f"""


def _metrics(spark: SparkSession, sf_dir: str, how: str, expected: str) -> DataFrame:
    histogram = merge.key_histogram(keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir), ["orderkey"])
    return merge.merge_metrics(histogram, how, expected)


@query(_metrics_sql("left", "one_to_one_or_many"))
def merge_metrics_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "left", "one_to_one_or_many")


@query(_metrics_sql("full", "one_to_one"))
def merge_metrics_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, "outer", "one_to_one")


@query(
    f"""with {KEYED}, m as (select count(*) as mn from o full join l on o.k is not distinct from l.k),
    d as (select mn - greatest((select count(*) from o), (select count(*) from l)) as n from m)
    select 'orders_lines' as dataset_id, 'merge' as stage, 'unexpected_duplication' as check_name,
           'WARNING' as severity,
           'Merged table contains ' || n || ' unexpected duplicated rows compared to source tables' as message,
           cast(null as varchar) as column_name, cast(n as bigint) as row_count from d where n > 0
    union all
    select 'orders_lines', 'merge', 'cardinality_mismatch', 'ERROR',
           'Observed cardinality one_to_many does not match expected one_to_one', null, null from m"""
)
def merge_expectation(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _metrics(spark, sf_dir, "outer", "one_to_one")
    return merge.merge_issues(metrics, "orders_lines").select(*ISSUE_FIELDS)


@query(
    """select o_orderkey, o_totalprice from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey)"""
)
def unmatched_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.unmatched_rows(orders, lines, ["o_orderkey"])


@query(
    f"""with {KEYED} select k as orderkey, l_linenumber, l_quantity from l
    where not exists (select 1 from o where o.k is not distinct from l.k)"""
)
def unmatched_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(keyless_orders(spark, sf_dir), keyless_lines(spark, sf_dir).drop("status"), "right", "orderkey")
    return merge.extract_unmatched(merged)[1].select("orderkey", "l_linenumber", "l_quantity")


CHAIN = [
    MergeStep("customer_orders", "customer", "orders", "left", ["custkey"], "one_to_many"),
    MergeStep("customer_orders_lines", "customer_orders", "lines", "left", ["orderkey"], "one_to_one_or_many"),
    MergeStep("with_nation", "customer_orders_lines", "nation", "left", ["nationkey"], "many_to_one"),
]


def chain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customer": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"), "c_mktsegment"
        ),
        "orders": table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), "o_totalprice"
        ),
        "lines": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity"
        ),
        "nation": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name"),
    }


CHAIN_SQL = """
select c_custkey as custkey, c_nationkey as nationkey, c_mktsegment, o_orderkey as orderkey, o_totalprice,
       l_linenumber, l_quantity, n_name
from customer left join orders on c_custkey = o_custkey left join lineitem on o_orderkey = l_orderkey
left join nation on c_nationkey = n_nationkey"""


@query(CHAIN_SQL)
def merge_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_chain(chain_tables(spark, sf_dir), CHAIN)["with_nation"].table


@query(
    """with one as (select count(*) as n, count(o_orderkey) as b from customer left join orders on c_custkey = o_custkey),
    two as (select count(*) as n, count(l_orderkey) as b, count(*) - count(l_orderkey) as lo
      from customer left join orders on c_custkey = o_custkey left join lineitem on o_orderkey = l_orderkey)
    select 'customer_orders' as step_name, cast(n as bigint) as merged_rows, cast(b as bigint) as both_count,
           cast(n - b as bigint) as left_only_count from one
    union all select 'customer_orders_lines', cast(n as bigint), cast(b as bigint), cast(lo as bigint) from two
    union all select 'with_nation', cast(n as bigint), cast(n as bigint), cast(0 as bigint) from two"""
)
def merge_chain_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = None
    for name, step in merge.merge_chain(chain_tables(spark, sf_dir), CHAIN).items():
        row = step.metrics.select(F.lit(name).alias("step_name"), "merged_rows", "both_count", "left_only_count")
        result = row if result is None else result.unionByName(row)
    return result
