"""Row-wise transforms over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.functions.text import is_selected, is_truthy
from concordat.operators import transform
from concordat.operators.headers import normalize_text

from .registry import query, table


@query(
    r"""select doc_id, upper(lang) as lang, source,
           trim(regexp_replace(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '[\r\n]+', ' | ', 'g'),
                '[ \t\r\n]+', ' ', 'g')) as text
    from documents"""
)
def text_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return normalize_text(documents, replace_newlines_with=" | ", uppercase_columns=["lang"])


@query(
    r"""select conv_id, turn, upper(role) as role,
           regexp_replace(trim(text, ' ' || chr(10)), '[\r\n]+', '/', 'g') as text
    from conversations"""
)
def text_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return normalize_text(
        turns, replace_newlines_with="/", collapse_whitespace=False, uppercase_columns=["role"]
    )


@query(
    """select c_custkey,
           case lower(trim(c_mktsegment)) when 'building' then 'B' when 'machinery' then 'M'
                when 'household' then 'H' else c_mktsegment end as c_mktsegment
    from (select c_custkey, case when c_nationkey = 3 then null when c_nationkey < 12 then ' ' || lower(c_mktsegment)
          else c_mktsegment end as c_mktsegment from customer)"""
)
def recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_nationkey") < 12, F.concat(F.lit(" "), F.lower("c_mktsegment"))).otherwise(
        F.col("c_mktsegment")
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") != 3, segment).alias("c_mktsegment")
    )
    mapping = {"Building": "B", " MACHINERY": "M", "household ": "H"}
    return transform.normalize_categories(customers, {"c_mktsegment": mapping})


FLAGS = (" Yes", "TRUE ", "0", "selected", "x", "no", "1")
_FLAG_SQL = "case p_size % 8 " + " ".join(f"when {i} then '{f}'" for i, f in enumerate(FLAGS)) + " end"


@query(
    f"""select p_partkey, coalesce(lower(trim(flag)) in ('1', 'true', 'yes', 'y', 'x'), false) as truthy,
           coalesce(lower(trim(flag)) in ('1', 'true', 'yes', 'y', 'x', 'selected'), false) as selected
    from (select p_partkey, {_FLAG_SQL} as flag from part)"""
)
def truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.array(*[F.lit(f) for f in (*FLAGS, None)])
    flag = F.element_at(flags, F.col("p_size") % 8 + 1)
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", is_truthy(flag).alias("truthy"), is_selected(flag).alias("selected"))


@query(
    """select event_id, value * 2 as doubled, floor(value * 2 / 3) as thirds, value * 2 > 100 as large,
           upper(event_type) as kind from events"""
)
def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "doubled": "value * 2",
        "thirds": "cast(floor(doubled / 3) as double)",
        "large": lambda df: df["doubled"] > 100,
        "kind": lambda df: F.upper("event_type"),
    }
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    return transform.derive(events, rules).drop("value", "event_type")


@query(
    """select event_id, value is not null as has_text, cast(trunc(value) as integer) as whole,
           user_id % 2 = 1 as flag, cast(ts as date) as day from events"""
)
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value").isNotNull()).cast("string").alias("has_text"),
        F.col("value").alias("whole"),
        (F.col("user_id") % 2).alias("flag"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    casts = {"has_text": "boolean", "whole": "int", "flag": "boolean", "day": "date", "absent": "numeric"}
    return transform.cast_columns(events, casts)


VARIABLE_MAP = {
    "variables": {
        "red widget": {"harmonized": "widget_red", "rule": "mapped", "notes": "colour last"},
        "blue bolt": {"harmonized": "bolt_blue"},
        "small ring": "ring_small",
    }
}
_NAMES = "case when p_size = 13 then '  ' when p_size < 25 then ' ' || p_name || ' ' else p_name end"
TRACED = f"""
traced as (
  select p_partkey, trim({_NAMES}) as q, row_number() over (order by p_partkey) - 1 as i from part
), named as (
  select p_partkey, q,
    case q when 'red widget' then 'widget_red' when 'blue bolt' then 'bolt_blue' when 'small ring' then 'ring_small'
           when '' then 'row_' || i else q end as h,
    case q when 'red widget' then 'mapped' when 'blue bolt' then 'question_name_exact'
           when 'small ring' then 'direct_mapping' else 'fallback_identity' end as r,
    case q when 'red widget' then 'colour last' when 'blue bolt' then '' when 'small ring' then ''
           else 'No mapping found; original variable retained' end as o
  from traced
)"""


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.when(F.col("p_size") < 25, F.concat(F.lit(" "), "p_name", F.lit(" "))).otherwise(F.col("p_name"))
    name = F.when(F.col("p_size") == 13, F.lit("  ")).otherwise(padded)
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("QUESTION_NAME"))


@query(
    f"""with {TRACED} select q as source_variable, h as harmonized_variable, 'once' as source_study, r as rule_applied,
    o as observations from named"""
)
def harmonize_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = part_names(spark, sf_dir)
    return transform.harmonize_variables(names, VARIABLE_MAP, "once", order_by=["p_partkey"])[1]


@query(f'with {TRACED} select p_partkey, h as "HARMONIZED_VARIABLE" from named')
def harmonize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = part_names(spark, sf_dir)
    return transform.harmonize_variables(names, VARIABLE_MAP, "once", order_by=["p_partkey"])[0].drop("QUESTION_NAME")


@query("select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) - 1 as place from orders")
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return transform.with_row_index(orders, ["o_orderdate", "o_orderkey"], "place")
