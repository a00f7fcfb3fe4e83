"""Header mapping and clean-up over the given tables under raw-style names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.functions.text import ref
from concordat.operators import headers

from .registry import query, table

RAW_ORDERS = ["Order ID ", "DOB", "Order Status", " Total-Price", "Order Date", "Priority/Level", "Birth Date"]

MAPPING = {
    "raw_to_canonical": {"Order ID": "order_id", "DOB": "birth_date", "Birth Date": "birth_date"},
    "datasets": {
        "orders": {
            "target_columns": ["order_id", "order_status", "total_price", "order_clerk", "order_date"],
            "required_columns": ["order_id", "order_clerk"],
            "on_missing_required": "error",
            "rename": {"order_id": "id"},
        },
        "people": {
            "target_columns": ["order_id", "birth_date", "nickname"],
            "required_columns": ["nickname"],
            "on_missing_required": "ignore",
        },
    },
    "text_normalization": {"trim": True, "uppercase_columns": ["Priority/Level"]},
}


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a raw export: odd headers, padded text, null ids and wholly empty rows."""
    present = ~F.col("o_orderpriority").isin("5-LOW")
    key = F.when(present & (F.col("o_orderstatus") != "P"), F.col("o_orderkey"))
    columns = [
        key,
        F.when(present, F.col("o_custkey").cast("string")),
        F.when(present, F.concat(F.lit(" "), "o_orderstatus", F.lit("  "))),
        F.when(present, F.col("o_totalprice")),
        F.when(present, F.col("o_orderdate").cast("date")),
        F.when(present, F.concat(F.lower("o_orderpriority"), F.lit("\n"), "o_orderstatus")),
        F.when(present, F.lit("2000-01-01")),
    ]
    return table(spark, sf_dir, "orders").select(*[c.alias(n) for c, n in zip(columns, RAW_ORDERS)])


ROWS = """
rows as (
  select o_orderkey as order_id, cast(o_custkey as varchar) as birth_date, o_orderstatus as order_status,
         o_totalprice as total_price, cast(o_orderdate as date) as order_date,
         upper(o_orderpriority) || ' ' || o_orderstatus as priority
  from orders where o_orderpriority <> '5-LOW' and o_orderstatus <> 'P'
)"""


def mapped_orders(spark: SparkSession, sf_dir: str) -> headers.HeaderMapping:
    return headers.map_headers(headers.clean_base_table(raw_orders(spark, sf_dir), "Order ID"), MAPPING)


@query(f'with {ROWS} select order_id, birth_date, order_status, total_price, order_date, priority as "Priority/Level" from rows')
def header_mapped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped_orders(spark, sf_dir).table


AUDIT = """
audit as (select * from (values
  ('Order ID', 'order_id', 'manual', 'mapped via raw_to_canonical'),
  ('DOB', 'birth_date', 'manual', 'mapped via raw_to_canonical'),
  ('Order Status', 'order_status', 'automatic', 'mapped by canonicalized header fallback'),
  ('Total-Price', 'total_price', 'automatic', 'mapped by canonicalized header fallback'),
  ('Order Date', 'order_date', 'automatic', 'mapped by canonicalized header fallback'),
  ('Priority/Level', '', 'unmapped', 'no manual mapping and automatic mapping not applicable'),
  ('Birth Date', 'birth_date', 'manual', 'mapped via raw_to_canonical')
) as t(raw_column, mapped_column, mapping_type, details))"""


@query(
    f"""with {ROWS}, {AUDIT}, filled as (
      select 'order_id' as c, count(order_id) as n from rows union all select 'birth_date', count(birth_date) from rows
      union all select 'order_status', count(order_status) from rows
      union all select 'total_price', count(total_price) from rows
      union all select 'order_date', count(order_date) from rows
      union all select 'Priority/Level', count(priority) from rows)
    select raw_column, mapped_column, mapping_type, details, cast(n as bigint) as filled_rows
    from audit join filled on c = case when mapped_column = '' then raw_column else mapped_column end"""
)
def header_mapping_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit beside how many rows of the mapped table each header fills."""
    mapped = mapped_orders(spark, sf_dir)
    counts = mapped.table.agg(*[F.count(ref(c)).alias(c) for c in mapped.table.columns])
    filled = counts.unpivot([], [ref(c) for c in counts.columns], "column_name", "filled_rows")
    name = F.when(F.col("mapped_column") == "", F.col("raw_column")).otherwise(F.col("mapped_column"))
    return mapped.audit.join(filled, name == filled["column_name"]).drop("column_name")


@query(
    f"""with {ROWS} select order_id as id, order_status, total_price, cast(null as varchar) as order_clerk, order_date
    from rows"""
)
def domain_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = mapped_orders(spark, sf_dir)
    return headers.domain_views(mapped.table, mapped.domains)["orders"]


@query(
    """select o_orderkey as "Order ID", o_totalprice as "Total-Price" from orders
    where o_orderpriority <> '5-LOW' and o_orderstatus <> 'P'"""
)
def drop_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = headers.clean_base_table(raw_orders(spark, sf_dir), "Order ID")
    return headers.existing(cleaned, ["Order ID", "Order Key", "Total-Price"])


@query(
    """select case when o_orderpriority <> '5-LOW' and o_orderstatus <> 'P' then o_orderkey end as order_id_,
           case when o_orderpriority <> '5-LOW' then cast(o_custkey as varchar) end as dob,
           case when o_orderpriority <> '5-LOW' then o_totalprice end as _total_price
    from orders"""
)
def standard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    spaced = raw.toDF(*["Order ID/", "DOB", "s", "-Total Price", "d", "p", "b"])
    return headers.existing(headers.standardize_names(spaced), ["order_id_", "dob", "_total_price"])
