"""Quality checks over the given tables. The tables are clean, so each query first plants defects
(nulls, blanks, bad text) that the SQL plants in the same way."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.model import DatasetSpec
from concordat.operators import checks
from concordat.operators.contract import DatasetSchemaSpec, coerce_to_contract, contract_failures

from .registry import query, table

ISSUE_FIELDS = ("dataset_id", "stage", "check_name", "severity", "message", "column_name", "row_count")


def gappy_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with null segments, blank names and null balances."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") % 7 == 0, F.lit("  ")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= -500, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
    )


GAPPY_CUSTOMER = """
gappy as (
  select c_custkey,
         case when c_nationkey % 7 = 0 then '  ' else c_name end as c_name,
         nullif(c_nationkey, 3) as c_nationkey,
         case when c_acctbal >= -500 then c_acctbal end as c_acctbal,
         nullif(c_mktsegment, 'BUILDING') as c_mktsegment
  from customer
)"""

CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _missing_sql(columns, source="gappy"):
    return " union all ".join(
        f"""select '{c}' as column_name,
               cast(count(*) filter (where {c} is null or trim(cast({c} as varchar)) = '') as bigint) as missing_count,
               count(*) as n from {source}"""
        for c in columns
    )


CUSTOMER_SPEC = DatasetSpec(
    "customer",
    primary_key="c_custkey",
    required_columns=["c_custkey", "c_name", "c_mktsegment"],
    optional_columns=["c_nationkey", "c_acctbal"],
    expected_dtypes={"c_name": "string", "c_acctbal": "numeric"},
)


@query(
    f"""with {GAPPY_CUSTOMER}, m as ({_missing_sql(CUSTOMER_COLUMNS)})
    select column_name, missing_count, round(missing_count / cast(greatest(n, 1) as double), 4) as missing_pct from m"""
)
def missingness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.profile_missingness(gappy_customer(spark, sf_dir), CUSTOMER_SPEC).metrics


@query(
    f"""with {GAPPY_CUSTOMER}, m as ({_missing_sql(("c_custkey", "c_name", "c_mktsegment"))})
    select 'customer' as dataset_id, 'missingness' as stage, 'required_missing' as check_name, 'WARNING' as severity,
           'Required column ' || column_name || ' has ' || missing_count || ' missing/blank values' as message,
           column_name, missing_count as row_count
    from m where missing_count > 0"""
)
def required_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.profile_missingness(gappy_customer(spark, sf_dir), CUSTOMER_SPEC).issues.select(*ISSUE_FIELDS)


LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query(
    f"""with worn as (
      select case when l_quantity > 45 then null else l_quantity end as l_quantity, l_extendedprice, l_discount, l_tax,
             nullif(l_returnflag, 'N') as l_returnflag,
             case when l_linenumber = 7 then '  ' else l_linestatus end as l_linestatus
      from lineitem), m as ({_missing_sql(LINEITEM_MEASURES, "worn")})
    select column_name, missing_count, round(missing_count / cast(greatest(n, 1) as double), 4) as missing_pct from m"""
)
def lineitem_missingness(spark: SparkSession, sf_dir: str) -> DataFrame:
    worn = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") <= 45, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_linenumber") == 7, F.lit("  ")).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
    )
    return checks.profile_missingness(worn, DatasetSpec("lineitem")).metrics


# --- rules ------------------------------------------------------------------------------------


def _rules(df: DataFrame, dataset_id: str, rules: list, **options) -> DataFrame:
    return checks.run_business_rules(df, DatasetSpec(dataset_id, rules=rules), **options).metrics


@query(
    f"""with {GAPPY_CUSTOMER}
    select 'name_given' as rule_name, 'not_blank' as rule_type,
           cast(count(*) filter (where c_name is null or trim(c_name) = '') as bigint) as failing_rows from gappy
    union all
    select 'segment_given', 'not_blank',
           cast(count(*) filter (where c_mktsegment is null or trim(c_mktsegment) = '') as bigint) from gappy"""
)
def rule_not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"name": "name_given", "type": "not_blank", "column": "c_name"},
        {"name": "segment_given", "type": "not_blank", "column": "c_mktsegment"},
    ]
    return _rules(gappy_customer(spark, sf_dir), "customer", rules)


@query(
    f"""with {GAPPY_CUSTOMER}
    select 'balance_range' as rule_name, 'between' as rule_type,
           cast(count(*) filter (where c_acctbal < 0 or c_acctbal > 9000) as bigint) as failing_rows from gappy
    union all
    select 'balance_range_na', 'between', cast(count(*) filter (where c_acctbal < 0 or c_acctbal > 9000) as bigint)
    from gappy"""
)
def rule_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"name": "balance_range", "type": "between", "column": "c_acctbal", "min": 0, "max": 9000}
    return _rules(
        gappy_customer(spark, sf_dir), "customer", [rule, {**rule, "name": "balance_range_na", "allow_na": True}]
    )


NULL_STATUS_ORDERS = """
worn as (
  select case when o_orderpriority = '5-LOW' then null else o_orderstatus end as o_orderstatus, o_orderpriority,
         o_orderdate, o_orderkey, o_totalprice
  from orders
)"""


def null_status_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
        "o_orderdate",
        "o_orderkey",
        "o_totalprice",
    )


@query(
    f"""with {NULL_STATUS_ORDERS}
    select 'status_listed' as rule_name, 'in_set' as rule_type,
           cast(count(*) filter (where o_orderstatus is null or o_orderstatus not in ('F', 'O')) as bigint)
             as failing_rows from worn
    union all
    select 'status_listed_na', 'in_set', cast(count(*) filter (where o_orderstatus not in ('F', 'O')) as bigint)
    from worn"""
)
def rule_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"name": "status_listed", "type": "in_set", "column": "o_orderstatus", "values": ["F", "O"]}
    return _rules(
        null_status_orders(spark, sf_dir), "orders", [rule, {**rule, "name": "status_listed_na", "allow_na": True}]
    )


@query(
    """select 'ordered_by_then' as rule_name, 'date_not_future' as rule_type,
       cast(count(*) filter (where o_orderdate > date '1998-01-01') as bigint) as failing_rows from orders"""
)
def rule_date_not_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"name": "ordered_by_then", "type": "date_not_future", "column": "o_orderdate"}]
    return _rules(table(spark, sf_dir, "orders"), "orders", rules, as_of=dt.date(1998, 1, 1))


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items beside their order's date; urgent orders lose theirs."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderdate")).alias("o_orderdate")
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select("l_shipdate", "o_orderdate")


DATED_LINES = """
dated as (
  select l_shipdate, case when o_orderpriority <> '1-URGENT' then o_orderdate end as o_orderdate
  from lineitem join orders on l_orderkey = o_orderkey
)"""


@query(
    f"""with {DATED_LINES}
    select 'not_before' as rule_name, 'compare_dates' as rule_type,
           cast(count(*) filter (where l_shipdate < o_orderdate) as bigint) as failing_rows from dated
    union all
    select 'after', 'compare_dates', cast(count(*) filter (where l_shipdate <= o_orderdate) as bigint) from dated"""
)
def rule_compare_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"type": "compare_dates", "left": "l_shipdate", "right": "o_orderdate"}
    rules = [{**rule, "name": "not_before"}, {**rule, "name": "after", "operator": ">"}]
    return _rules(dated_lines(spark, sf_dir), "lines", rules)


@query(
    f"""with {DATED_LINES}
    select 'not_before' as rule_name, 'compare_dates' as rule_type,
           cast(count(*) filter (where l_shipdate < o_orderdate or o_orderdate is null) as bigint) as failing_rows
    from dated
    union all
    select 'not_before_na', 'compare_dates', cast(count(*) filter (where l_shipdate < o_orderdate) as bigint)
    from dated"""
)
def rule_compare_dates_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"type": "compare_dates", "left": "l_shipdate", "right": "o_orderdate"}
    rules = [{**rule, "name": "not_before"}, {**rule, "name": "not_before_na", "allow_na": True}]
    return _rules(dated_lines(spark, sf_dir), "lines", rules, strict_nulls=True)


LINE_RULES = [
    {"name": "flag_given", "type": "not_blank", "column": "l_returnflag"},
    {"name": "quantity_range", "type": "between", "column": "l_quantity", "min": 5, "max": 45},
    {"name": "status_listed", "type": "in_set", "column": "l_linestatus", "values": ["O"]},
    {"name": "shipped_by_then", "type": "date_not_future", "column": "l_shipdate"},
    {"name": "price_range", "type": "between", "column": "l_extendedprice", "min": 1000, "max": 50000},
    {"name": "odd_one", "type": "no_such_rule"},
]


@query(
    """with c as (select
      count(*) filter (where l_returnflag is null or trim(l_returnflag) = '') as a,
      count(*) filter (where l_quantity < 5 or l_quantity > 45) as b,
      count(*) filter (where l_linestatus not in ('O')) as c,
      count(*) filter (where l_shipdate > date '1999-12-31') as d,
      count(*) filter (where l_extendedprice < 1000 or l_extendedprice > 50000) as e
      from lineitem)
    select 'flag_given' as rule_name, 'not_blank' as rule_type, cast(a as bigint) as failing_rows from c
    union all select 'quantity_range', 'between', cast(b as bigint) from c
    union all select 'status_listed', 'in_set', cast(c as bigint) from c
    union all select 'shipped_by_then', 'date_not_future', cast(d as bigint) from c
    union all select 'price_range', 'between', cast(e as bigint) from c
    union all select 'odd_one', 'no_such_rule', cast(null as bigint) from c"""
)
def rules_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(table(spark, sf_dir, "lineitem"), "lineitem", LINE_RULES, as_of=dt.date(1999, 12, 31))


@query(
    """with c as (select
      count(*) filter (where l_quantity < 5 or l_quantity > 45) as b,
      count(*) filter (where l_linestatus not in ('O')) as c,
      count(*) filter (where l_shipdate > date '1999-12-31') as d,
      count(*) filter (where l_extendedprice < 1000 or l_extendedprice > 50000) as e
      from lineitem), f as (
      select 'quantity_range' as check_name, b as n from c union all select 'status_listed', c from c
      union all select 'shipped_by_then', d from c union all select 'price_range', e from c)
    select 'lineitem' as dataset_id, 'business_rules' as stage, check_name, 'ERROR' as severity,
           'Rule ' || check_name || ' failed for ' || n || ' rows' as message, cast(null as varchar) as column_name,
           cast(n as bigint) as row_count from f where n > 0
    union all
    select 'lineitem', 'business_rules', 'odd_one', 'WARNING', 'Unsupported rule type: no_such_rule', null, null
    from c"""
)
def rule_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DatasetSpec("lineitem", rules=LINE_RULES)
    result = checks.run_business_rules(table(spark, sf_dir, "lineitem"), spec, as_of=dt.date(1999, 12, 31))
    return result.issues.select(*ISSUE_FIELDS)


@query(
    """select 'l_quantity' as column_name,
              cast(count(*) filter (where l_quantity < 5 or l_quantity > 45) as bigint) as failing_rows from lineitem
    union all select 'l_discount', cast(count(*) filter (where l_discount > 0.05) as bigint) from lineitem
    union all select 'l_tax', cast(count(*) filter (where l_tax < 0.0) as bigint) from lineitem"""
)
def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = {"l_quantity": {"min": 5, "max": 45}, "l_discount": {"max": 0.05}, "l_tax": {"min": 0.0}}
    return checks.validate_ranges(table(spark, sf_dir, "lineitem"), ranges, "lineitem").metrics


@query(
    f"""with {GAPPY_CUSTOMER}, m as ({_missing_sql(("c_custkey", "c_name", "c_mktsegment"))})
    select 'customer' as dataset_id, 'structure' as stage, 'required_field_missing_values' as check_name,
           'WARNING' as severity,
           'Column ' || column_name || ' has ' || missing_count || ' missing/blank values' as message,
           column_name, missing_count as row_count
    from m where missing_count > 0"""
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["c_custkey", "c_name", "c_mktsegment"]
    found = checks.validate_required_fields(gappy_customer(spark, sf_dir), fields, "customer")
    return found.issues.select(*ISSUE_FIELDS)


# --- keys and duplicates ----------------------------------------------------------------------


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with one text key; blank for one status, null for one flag."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    blanked = F.when(F.col("l_quantity") == 1, F.lit("  ")).otherwise(key)
    return table(spark, sf_dir, "lineitem").select(F.when(F.col("l_quantity") != 50, blanked).alias("line_id"))


@query(
    """with k as (
      select case when l_quantity = 50 then null when l_quantity = 1 then '  '
             else l_orderkey || '-' || l_linenumber end as line_id from lineitem)
    select 'line_id' as primary_key,
           cast(count(*) filter (where line_id is null or trim(line_id) = '') as bigint) as blank_key_count,
           cast(count(*) - count(distinct line_id) - max(case when line_id is null then 1 else 0 end) as bigint)
             as duplicate_key_count,
           cast(count(distinct line_id) as bigint) as unique_key_count
    from k"""
)
def primary_key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DatasetSpec("lineitem", primary_key="line_id")
    return checks.validate_primary_key(keyed_lines(spark, sf_dir), spec).metrics


@query(
    """with k as (
      select case when l_quantity = 50 then null when l_quantity = 1 then '  '
             else l_orderkey || '-' || l_linenumber end as line_id from lineitem),
    m as (select count(*) filter (where line_id is null or trim(line_id) = '') as b,
      count(*) - count(distinct line_id) - max(case when line_id is null then 1 else 0 end) as d from k)
    select 'lineitem' as dataset_id, 'uniqueness' as stage, 'blank_primary_key' as check_name, 'ERROR' as severity,
           b || ' blank/null primary key values' as message, 'line_id' as column_name, cast(b as bigint) as row_count
    from m where b > 0
    union all
    select 'lineitem', 'uniqueness', 'duplicate_primary_key', 'ERROR', d || ' duplicated primary key rows', 'line_id',
           cast(d as bigint) from m where d > 0"""
)
def primary_key_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DatasetSpec("lineitem", primary_key="line_id")
    return checks.validate_primary_key(keyed_lines(spark, sf_dir), spec, with_info=True).issues.select(*ISSUE_FIELDS)


@query(
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem
    join (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)
    using (l_orderkey, l_linenumber)"""
)
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return checks.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query(
    """select doc_id, lang, source from documents
    where text in (select text from documents group by text having count(*) > 1)"""
)
def duplicate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return checks.duplicate_rows(documents, ["text"]).select("doc_id", "lang", "source")


@query(
    """with d as (select count(*) as n from documents
      where text in (select text from documents group by text having count(*) > 1))
    select 'documents' as dataset_id, 'uniqueness' as stage, 'duplicate_rows' as check_name, 'ERROR' as severity,
           'Detected ' || n || ' duplicated rows for subset=[''text'']' as message,
           cast(null as varchar) as column_name, cast(n as bigint) as row_count from d"""
)
def duplicate_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = checks.detect_duplicates(table(spark, sf_dir, "documents"), ["text"], "documents")
    return issues.select(*ISSUE_FIELDS)


# --- value lists ------------------------------------------------------------------------------

ALLOWED_PART = {"p_type": ["ECONOMY", "SMALL", "LARGE"], "p_brand": [f"Brand#{i}" for i in range(1, 21)], "p_size": [*range(1, 46)]}


def padded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_type", F.lit("\t ")).alias("p_type"),
        F.when(F.col("p_size") != 9, F.col("p_brand")).alias("p_brand"),
        "p_size",
    )


_BRANDS = ", ".join(f"'Brand#{i}'" for i in range(1, 21))
INVALID_PARTS = f"""
bad as (
  select 'p_type' as column_name, p_type as value, count(*) as n from part
  where p_type not in ('ECONOMY', 'SMALL', 'LARGE') group by p_type
  union all
  select 'p_brand', p_brand, count(*) from part where p_size <> 9 and p_brand not in ({_BRANDS}) group by p_brand
  union all
  select 'p_size', cast(p_size as varchar), count(*) from part where p_size not between 1 and 45 group by p_size
)"""


@query(f"with {INVALID_PARTS} select column_name, value, cast(n as bigint) as failing_rows from bad")
def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DatasetSpec("part", allowed_values=ALLOWED_PART)
    return checks.validate_allowed_values(padded_parts(spark, sf_dir), spec).metrics


@query(
    f"""with {INVALID_PARTS}
    select 'part' as dataset_id, 'domain' as stage, 'invalid_domain_value' as check_name, 'ERROR' as severity,
           count(*) || ' distinct invalid values in ' || column_name as message, column_name, cast(count(*) as bigint) as row_count
    from bad group by column_name"""
)
def allowed_value_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = DatasetSpec("part", allowed_values=ALLOWED_PART)
    return checks.validate_allowed_values(padded_parts(spark, sf_dir), spec).issues.select(*ISSUE_FIELDS)


@query(
    f"""with {INVALID_PARTS}, counted as (
      select column_name, count(*) as k from bad where column_name <> 'p_size' group by 1)
    select 'part' as dataset_id, 'domain' as stage, 'invalid_domain_value' as check_name, 'ERROR' as severity,
           k || ' distinct invalid domain values in ' || column_name as message, column_name,
           cast(k as bigint) as row_count from counted
    union all
    select 'part', 'domain', 'domain_validation', 'INFO', 'All values in p_size are within the expected domain.',
           'p_size', null
    from (select count(*) from part where p_size not between 1 and 50)
    union all
    select 'part', 'domain', 'domain_column_missing', 'WARNING', 'Domain validation skipped; column not found: p_color',
           'p_color', null"""
)
def domain_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "p_type": [" ECONOMY", "SMALL ", "LARGE"], "p_brand": ALLOWED_PART["p_brand"], "p_size": range(1, 51),
        "p_color": ["red"],
    }
    return checks.validate_domains(padded_parts(spark, sf_dir), rules, "part").issues.select(*ISSUE_FIELDS)


# --- types ------------------------------------------------------------------------------------


def typed_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates as text, good and bad, derived from whole documents and their ids."""
    doc, chars = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    number = (
        F.when(F.col("lang") == "fr", F.concat(F.lit("x"), chars))
        .when(F.col("lang") == "de", F.concat(F.lit(" "), chars, F.lit("e1 ")))
        .when(F.col("lang") == "es", F.concat(chars, F.lit("d")))
        .otherwise(chars)
    )
    day = F.lpad((F.col("doc_id") % 40 + 1).cast("string"), 2, "0")
    date = F.when(F.col("n_chars") < 200, F.lit(None)).otherwise(F.concat(F.lit("2021-03-"), day))
    return table(spark, sf_dir, "documents").select("doc_id", number.alias("score"), date.alias("seen"), "lang")


TYPED_AS_TEXT = """
typed as (
  select doc_id,
         case lang when 'fr' then 'x' || n_chars when 'de' then ' ' || n_chars || 'e1 ' when 'es' then n_chars || 'd'
                   else cast(n_chars as varchar) end as score,
         case when n_chars < 200 then null else '2021-03-' || lpad(cast(doc_id % 40 + 1 as varchar), 2, '0') end as seen,
         lang
  from documents
)"""
NUMBER_SQL = r"""case when regexp_full_match(trim(score), '[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)')
                 then try_cast(trim(score) as double) end"""
TYPED_SPEC = DatasetSpec(
    "documents",
    primary_key="doc_id",
    required_columns=["doc_id", "score"],
    optional_columns=["seen"],
    expected_dtypes={"score": "numeric", "seen": "date", "lang": "string"},
)


@query(
    f"""with {TYPED_AS_TEXT}
    select 'score' as column_name, 'numeric' as expected, 'string' as observed,
           cast(count(*) filter (where score is not null and {NUMBER_SQL} is null) as bigint) as invalid_count
    from typed
    union all select 'seen', 'date', 'string',
           cast(count(*) filter (where seen is not null and try_cast(seen as date) is null) as bigint) from typed
    union all select 'lang', 'string', 'string', cast(0 as bigint) from (select count(*) from typed)"""
)
def type_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validate_dtypes(typed_as_text(spark, sf_dir), TYPED_SPEC).metrics


@query(f"with {TYPED_AS_TEXT} select doc_id, {NUMBER_SQL} as score from typed")
def cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cast_expected_types(typed_as_text(spark, sf_dir), TYPED_SPEC).select("doc_id", "score")


@query(f"with {TYPED_AS_TEXT} select doc_id, try_cast(seen as date) as seen from typed")
def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cast_expected_types(typed_as_text(spark, sf_dir), TYPED_SPEC).select("doc_id", "seen")


@query(
    f"""with {TYPED_AS_TEXT}, n as (
      select count(*) filter (where seen is not null and try_cast(seen as date) is null) as n from typed)
    select 'documents' as dataset_id, 'dtype' as stage, 'date_parse' as check_name, 'WARNING' as severity,
           n || ' rows in seen could not be parsed as dates' as message, 'seen' as column_name,
           cast(n as bigint) as row_count from n"""
)
def date_parse_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, issues = checks.parse_dates_safely(typed_as_text(spark, sf_dir), "seen", "documents")
    return issues.select(*ISSUE_FIELDS)


# --- contract ---------------------------------------------------------------------------------

SUPPLIER_CONTRACT = DatasetSchemaSpec(
    required_columns=["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_phone"],
    dtypes={"s_suppkey": "int64", "s_nationkey": "int64", "s_acctbal": "float64"},
    nullable_columns=["s_acctbal"],
    allowed_values={"s_nationkey": [*range(0, 20)]},
    ranges={"s_acctbal": {"min": 0, "max": 9000}},
)


def worn_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys as text, some not numeric; one nation without names; one without balances."""
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(nation == 4, F.concat(F.lit("S"), key)).otherwise(key).alias("s_suppkey"),
        F.when(nation != 7, F.col("s_name")).alias("s_name"),
        "s_nationkey",
        F.when(nation != 9, F.round("s_acctbal", 0)).alias("s_acctbal"),
    )


@query(
    """with worn as (
      select case when s_nationkey = 4 then 'S' || s_suppkey else cast(s_suppkey as varchar) end as s_suppkey,
             case when s_nationkey <> 7 then s_name end as s_name, s_nationkey,
             case when s_nationkey <> 9 then round(s_acctbal, 0) end as s_acctbal from supplier)
    select 's_suppkey' as column_name, 'coerce_dtype' as check_name, s_suppkey as failure_value,
           cast(count(*) as bigint) as failing_rows
    from worn where try_cast(s_suppkey as bigint) is null group by s_suppkey
    union all
    select 's_name', 'not_nullable', null, cast(count(*) as bigint) from worn where s_name is null having count(*) > 0
    union all
    select 's_nationkey', 'isin', cast(s_nationkey as varchar), cast(count(*) as bigint) from worn
    where s_nationkey >= 20 group by s_nationkey
    union all
    select 's_acctbal', 'greater_than_or_equal_to', cast(s_acctbal as varchar), cast(count(*) as bigint)
    from worn where s_acctbal < 0 group by s_acctbal
    union all
    select 's_acctbal', 'less_than_or_equal_to', cast(s_acctbal as varchar), cast(count(*) as bigint)
    from worn where s_acctbal > 9000 group by s_acctbal
    union all select 's_phone', 'column_in_dataframe', 's_phone', cast(1 as bigint)"""
)
def contract_failures_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_failures(worn_supplier(spark, sf_dir), SUPPLIER_CONTRACT)


@query(
    """select try_cast(case when s_nationkey = 4 then 'S' || s_suppkey else cast(s_suppkey as varchar) end as bigint)
             as s_suppkey,
           case when s_nationkey <> 7 then s_name end as s_name, cast(s_nationkey as bigint) as s_nationkey,
           case when s_nationkey <> 9 then round(s_acctbal, 0) end as s_acctbal from supplier"""
)
def contract_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coerce_to_contract(worn_supplier(spark, sf_dir), SUPPLIER_CONTRACT)


# --- whole tables -----------------------------------------------------------------------------

TABLES = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}


@query(
    " union all ".join(
        f"""select '{name}' as dataset_id, cast(count(*) as bigint) as n_rows, cast({width} as bigint) as n_columns
        from {name}"""
        for name, width in TABLES.items()
    )
)
def sanity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = None
    for name in TABLES:
        counts = checks.run_sanity_checks(table(spark, sf_dir, name), DatasetSpec(name)).metrics
        labelled = counts.select(F.lit(name).alias("dataset_id"), "*")
        result = labelled if result is None else result.unionByName(labelled)
    return result


SUITE_SPEC = DatasetSpec(
    "documents",
    primary_key="doc_id",
    required_columns=["doc_id", "score", "seen", "author"],
    optional_columns=[],
    expected_dtypes={"score": "numeric", "seen": "date", "lang": "string"},
    allowed_values={"lang": ["en", "de"]},
    rules=[
        {"name": "score_range", "type": "between", "column": "score", "min": 0, "max": 5000},
        {"name": "seen_by_then", "type": "date_not_future", "column": "seen"},
        {"name": "score_given", "type": "not_blank", "column": "score"},
    ],
)


@query(
    f"""with {TYPED_AS_TEXT}, v as (select *, {NUMBER_SQL} as num, try_cast(seen as date) as day from typed),
    c as (select count(*) filter (where score is not null and num is null) as bad_num,
                 count(*) filter (where seen is not null and day is null) as bad_day,
                 count(*) filter (where num is null) as no_num, count(*) filter (where day is null) as no_day,
                 count(*) filter (where num < 0 or num > 5000) as out_num,
                 count(*) filter (where day > date '2021-03-20') as late,
                 count(distinct lang) filter (where lang not in ('en', 'de')) as bad_lang from v)
    select 'documents' as dataset_id, 'structure' as stage, 'missing_columns' as check_name, 'ERROR' as severity,
           'Missing required columns: [''author'']' as message, cast(null as varchar) as column_name,
           cast(null as bigint) as row_count
    union all select 'documents', 'structure', 'unexpected_columns', 'WARNING', 'Unexpected columns: [''lang'']', null, null
    union all select 'documents', 'dtype', 'numeric_cast', 'ERROR', bad_num || ' invalid numeric values in score',
      'score', bad_num from c where bad_num > 0
    union all select 'documents', 'dtype', 'date_cast', 'ERROR', bad_day || ' invalid date values in seen', 'seen',
      bad_day from c where bad_day > 0
    union all select 'documents', 'missingness', 'required_missing', 'WARNING',
      'Required column score has ' || no_num || ' missing/blank values', 'score', no_num from c where no_num > 0
    union all select 'documents', 'missingness', 'required_missing', 'WARNING',
      'Required column seen has ' || no_day || ' missing/blank values', 'seen', no_day from c where no_day > 0
    union all select 'documents', 'domain', 'invalid_domain_value', 'ERROR',
      bad_lang || ' distinct invalid values in lang', 'lang', bad_lang from c
      where bad_lang > 0
    union all select 'documents', 'business_rules', 'score_range', 'ERROR',
      'Rule score_range failed for ' || out_num || ' rows', null, out_num from c where out_num > 0
    union all select 'documents', 'business_rules', 'seen_by_then', 'ERROR',
      'Rule seen_by_then failed for ' || late || ' rows', null, late from c where late > 0
    union all select 'documents', 'business_rules', 'score_given', 'ERROR',
      'Rule score_given failed for ' || no_num || ' rows', null, no_num from c where no_num > 0"""
)
def suite_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checks.validate(typed_as_text(spark, sf_dir), SUITE_SPEC, as_of=dt.date(2021, 3, 20))
    return result.issues.select(*ISSUE_FIELDS)


@query(
    """select 'documents_' || s as step_name, 'documents' as dataset_id, ok as success, cast(n as bigint) as issue_count
    from (values ('column_validation', false, 2), ('dtype_validation', false, 2), ('missingness_profile', true, 2),
                 ('primary_key_validation', true, 0), ('allowed_values_validation', false, 1),
                 ('business_rules', false, 3), ('sanity_checks', true, 0)) as t(s, ok, n)"""
)
def suite_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = checks.validate(typed_as_text(spark, sf_dir), SUITE_SPEC, as_of=dt.date(2021, 3, 20))
    return result.step_results.select("step_name", "dataset_id", "success", "issue_count")
