"""Report tables over the findings and steps of checks on the given tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.model import DatasetSpec
from concordat.operators import checks, merge, reports

from .checks import CUSTOMER_SPEC, GAPPY_CUSTOMER, ISSUE_FIELDS, gappy_customer
from .merges import chain_tables
from .registry import query, scratch, table

ORDER_SPEC = DatasetSpec(
    "orders",
    primary_key="o_custkey",
    required_columns=["o_orderkey", "o_custkey"],
    optional_columns=["o_orderstatus", "o_totalprice", "o_orderdate"],
    rules=[
        {"name": "recent", "type": "date_not_future", "column": "o_orderdate"},
        {"name": "positive", "type": "between", "column": "o_totalprice", "min": 0, "max": 1e9},
    ],
)


def results(spark: SparkSession, sf_dir: str) -> list[checks.SuiteResult]:
    return [
        checks.validate(gappy_customer(spark, sf_dir), CUSTOMER_SPEC),
        checks.validate(table(spark, sf_dir, "orders"), ORDER_SPEC, as_of=dt.date(1998, 1, 1)),
    ]


ISSUES = f"""{GAPPY_CUSTOMER},
names as (select count(*) filter (where c_name is null or trim(c_name) = '') as a,
                 count(*) filter (where c_mktsegment is null) as b from gappy),
keys as (select count(*) - count(distinct o_custkey) as d, count(*) filter (where o_orderdate > date '1998-01-01') as f
         from orders),
issues as (
  select 'customer_missingness_profile' as step, 'customer' as dataset_id, 'missingness' as stage,
         'required_missing' as check_name, 'WARNING' as severity,
         'Required column c_name has ' || a || ' missing/blank values' as message, 'c_name' as column_name,
         cast(a as bigint) as row_count from names where a > 0
  union all select 'customer_missingness_profile', 'customer', 'missingness', 'required_missing', 'WARNING',
         'Required column c_mktsegment has ' || b || ' missing/blank values', 'c_mktsegment', b from names where b > 0
  union all select 'orders_column_validation', 'orders', 'structure', 'unexpected_columns', 'WARNING',
         'Unexpected columns: [''o_orderpriority'']', null, null from keys
  union all select 'orders_primary_key_validation', 'orders', 'uniqueness', 'duplicate_primary_key', 'ERROR',
         d || ' duplicated primary key rows', 'o_custkey', d from keys where d > 0
  union all select 'orders_business_rules', 'orders', 'business_rules', 'recent', 'ERROR',
         'Rule recent failed for ' || f || ' rows', null, f from keys where f > 0
)"""


@query(
    f"""with {ISSUES} select dataset_id, stage, check_name, severity, message, column_name, row_count from issues
    where severity = 'ERROR'"""
)
def issues_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reduce(DataFrame.unionByName, [r.issues for r in results(spark, sf_dir)])
    return reports.issues_of(found, "error").select(*ISSUE_FIELDS)


@query(
    f"""with {ISSUES}, steps as (select * from (values ('customer'), ('orders')) as t(stage))
    select stage, cast(7 as bigint) as executed,
      cast((select count(distinct step) from issues i where i.dataset_id = s.stage and severity = 'ERROR') as bigint)
        as failed,
      cast((select count(*) from issues i where i.dataset_id = s.stage) as bigint) as issues
    from steps s"""
)
def counts_by_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = reduce(DataFrame.unionByName, [r.step_results for r in results(spark, sf_dir)])
    return reports.counts_by_stage(steps)


@query(
    f"""with {ISSUES}
    select count(*) filter (where severity = 'ERROR') = 0 as success, cast(14 as bigint) as validations_executed,
           cast(count(*) filter (where severity = 'ERROR') as bigint) as error_count,
           cast(count(*) filter (where severity = 'WARNING') as bigint) as warning_count from issues"""
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = results(spark, sf_dir)
    steps = reduce(DataFrame.unionByName, [r.step_results for r in outcomes])
    return reports.run_summary(steps, reduce(DataFrame.unionByName, [r.issues for r in outcomes]))


@query(
    """with a as (select count(*) filter (where o_orderkey is null) as lo, count(*) filter (where c_custkey is null) as ro
      from customer full join orders on c_custkey = o_custkey and true),
    b as (select count(*) filter (where l_orderkey is null) as lo from orders left join lineitem on o_orderkey = l_orderkey)
    select cast(a.lo + b.lo as bigint) as left_only_total, cast(a.ro as bigint) as right_only_total from a, b"""
)
def exclusion_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = chain_tables(spark, sf_dir)
    joins = [("customer", "orders", "custkey", "outer"), ("orders", "lines", "orderkey", "left")]
    metrics = [
        merge.merge_metrics(merge.key_histogram(tables[left], tables[right], [key]), how)
        for left, right, key, how in joins
    ]
    return reports.exclusion_totals(reduce(DataFrame.unionByName, metrics))


@query(
    """select cast(n_nationkey as varchar) as n_nationkey, cast(strlen(n_name) + 1 as bigint) as size_bytes,
           sha256(n_name || chr(10)) as sha256 from nation"""
)
def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of every nation written as a text file of its own; the files are then listed and hashed."""
    from concordat.sources import collect_file_metadata

    folder = f"{scratch(spark, 'hashes')}/nations"
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    names.repartition("n_nationkey").write.partitionBy("n_nationkey").text(folder)
    listed = collect_file_metadata(spark, folder).filter("suffix = '.txt'")
    return listed.select(F.regexp_extract("path", "n_nationkey=([^/]+)/", 1).alias("n_nationkey"), "size_bytes", "sha256")


@query()
def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, time and SHA-256 of the given files. SQL cannot hash them, so it has no counterpart."""
    from concordat.sources import collect_file_metadata

    return collect_file_metadata(spark, sf_dir).select(
        "name", "size_bytes", "suffix", "sha256", F.col("modified_at").isNotNull().alias("dated")
    )
