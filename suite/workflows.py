"""The composite workflows over the given tables. Outputs go to a new folder per run."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat import plans
from concordat.model import DatasetSpec, MergeStep
from concordat.sources import read_table, write_table

from .harmonisation import HARMONIZED, SUMMARY, once, quince, variables
from .headers import MAPPING, ROWS, raw_orders
from .merges import CHAIN, CHAIN_SQL, chain_tables
from .registry import query, scratch, table

DOCUMENT_STEPS = [MergeStep("documents_labels", "documents", "labels", "left", ["doc_id"], "one_to_one")]


def document_run(spark: SparkSession, sf_dir: str) -> plans.RunResult:
    specs = [
        DatasetSpec(
            "documents", f"{sf_dir}/documents.parquet", "parquet", "doc_id", ["doc_id", "text", "lang"],
            ["source", "n_chars"], {"n_chars": "numeric"}, {"lang": ["en", "de", "fr"]},
            [{"name": "length_range", "type": "between", "column": "n_chars", "min": 100, "max": 10000}],
        ),
        DatasetSpec("labels", f"{sf_dir}/labels.parquet", "parquet", "doc_id", ["doc_id", "quality", "toxic"]),
        DatasetSpec("notes", f"{sf_dir}/notes.parquet", "parquet", "doc_id", ["doc_id"]),
    ]
    return plans.curate_and_merge(spark, specs, DOCUMENT_STEPS, out_dir=scratch(spark, "documents"))


@query(
    """select d.doc_id, lang, source, cast(n_chars as double) as n_chars, quality, toxic,
           case when l.doc_id is null then 'left_only' else 'both' end as _merge
    from documents d left join labels l on d.doc_id = l.doc_id"""
)
def tables_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_run(spark, sf_dir).merges["documents_labels"].merged.drop("text")


@query(
    """with e as (select count(*) filter (where n_chars < 100 or n_chars > 10000) > 0 as r,
                         count(*) filter (where lang not in ('en', 'de', 'fr')) > 0 as d from documents)
    select false as success, cast(19 as bigint) as validations_executed,
           cast(1 + case when r then 1 else 0 end + case when d then 1 else 0 end as bigint) as error_count,
           cast(0 as bigint) as warning_count from e"""
)
def tables_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of seven checks and one input each, one absent input, two merge steps."""
    return document_run(spark, sf_dir).summary()


@query(
    """select cast(count(*) filter (where l.doc_id is null) as bigint) as left_only_total,
           cast(0 as bigint) as right_only_total from documents d left join labels l on d.doc_id = l.doc_id"""
)
def tables_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_run(spark, sf_dir).exclusions()


@query(
    """select 'documents' as dataset_id, 'lang' as column_name, lang as value, cast(count(*) as bigint) as failing_rows
    from documents where trim(lang) not in ('en', 'de', 'fr') group by lang"""
)
def tables_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written report of all values outside their lists."""
    return document_run(spark, sf_dir).invalid_value_report()


@query(CHAIN_SQL)
def tables_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = chain_tables(spark, sf_dir)
    specs = [DatasetSpec(name, required_columns=df.columns) for name, df in tables.items()]
    run = plans.curate_and_merge(spark, specs, CHAIN, tables=tables, out_dir=scratch(spark, "chain"))
    return run.merges["with_nation"].table


@query(
    f"""with {ROWS}
    select o.order_id as id, order_status, total_price, cast(null as varchar) as order_clerk, order_date,
           birth_date, cast(null as varchar) as nickname
    from rows o"""
)
def wide_export_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide export cut into two domain tables, which are then judged and merged again."""
    folder = scratch(spark, "export")
    views, _ = plans.wide_export_domains(
        raw_orders(spark, sf_dir), MAPPING, staging_path=f"{folder}/staging.parquet", id_column="Order ID"
    )
    views["people"] = views["people"].withColumnRenamed("order_id", "id")
    specs = [
        DatasetSpec("orders", primary_key="id", required_columns=["id"], expected_dtypes={"total_price": "numeric"}),
        DatasetSpec("people", primary_key="id", required_columns=["id"]),
    ]
    steps = [MergeStep("orders_people", "orders", "people", "left", ["id"], "one_to_one")]
    run = plans.curate_and_merge(
        spark, specs, steps, tables=views, out_dir=folder, as_of=dt.date(2002, 1, 1)
    )
    return run.merges["orders_people"].table


@query(
    """select 'single_workbook_normalization' as step_name, 'orders' as dataset_id, 'normalization' as stage,
           'required_columns_present' as check_name, 'ERROR' as severity, 'order_clerk' as column_name,
           cast(1 as bigint) as row_count, false as step_success
    from (select count(*) as n from orders) where n > 0"""
)
def wide_export_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide export lacks a column that a domain requires: the run says so and is no success."""
    folder = scratch(spark, "export")
    views, mapped = plans.wide_export_domains(
        raw_orders(spark, sf_dir), MAPPING, staging_path=f"{folder}/staging.parquet", id_column="Order ID"
    )
    run = plans.curate_and_merge(spark, [DatasetSpec("people")], tables=views, normalization=mapped, out_dir=folder)
    steps = run.step_results.select("step_name", F.col("success").alias("step_success"))
    found = run.step_issues.filter("stage = 'normalization' and check_name = 'required_columns_present'").join(steps, "step_name")
    return found.select(
        "step_name", "dataset_id", "stage", "check_name", "severity", "column_name", "row_count", "step_success"
    )


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A codebook read off the parts: every part type asks for one variable."""
    name = F.create_map(
        *[
            F.lit(part)
            for pair in {
                "ECONOMY": "brand", "SMALL": "price", "LARGE": "code", "PROMO": "only_once", "STANDARD": "only_quince",
                "MEDIUM": "nowhere",
            }.items()
            for part in pair
        ]
    )
    question = F.try_element_at(name, F.col("p_type"))
    review = F.when(question.isin("brand", "code", "only_once", "nowhere"), F.lit("TRUE")).otherwise(F.lit("no"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", question.alias("QUESTION_NAME"), review.alias("needs_review")
    )


@query(HARMONIZED)
def cohort_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = plans.harmonize_cohort(
        once(spark, sf_dir), quince(spark, sf_dir), asked(spark, sf_dir),
        out_dir=scratch(spark, "cohort"), order_by=["p_partkey"],
    )
    return result.merged


@query(SUMMARY)
def catalog_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.run_catalog(variables(spark, sf_dir), out_dir=scratch(spark, "catalog")).summary


@query("select c_custkey, c_name, c_mktsegment, round(c_acctbal, 2) as c_acctbal from customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as CSV, read back as text and cast."""
    from concordat.operators.transform import cast_columns

    path = f"{scratch(spark, 'csv')}/customer.csv"
    write_table(table(spark, sf_dir, "customer"), path)
    casts = {"c_custkey": "bigint", "c_acctbal": "numeric"}
    return cast_columns(read_table(spark, path), casts).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("select o_orderkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice, o_orderpriority from orders")
def tsv_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tab-separated files, read back and cast."""
    from concordat.operators.transform import cast_columns

    path = f"{scratch(spark, 'tsv')}/orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    orders.write.option("header", True).option("sep", "\t").csv(path)
    casts = {"o_orderkey": "bigint", "o_totalprice": "numeric"}
    return cast_columns(read_table(spark, path, "tsv"), casts)


@query(
    """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
           l_returnflag as flag, l_linestatus as flag_2 from lineitem"""
)
def two_row_header_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an export of many files, each with its header row, two columns of one name."""
    from concordat.sources import read_two_row_header

    path = f"{scratch(spark, 'export')}/lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    lines.toDF("l_orderkey", "l_linenumber", "flag", " flag").write.option("header", True).csv(path)
    return read_two_row_header(
        spark, path, demographics_column_end="B", demographics_header_row=1, clinical_header_row=1
    )


@query(
    """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as line,
           l_returnflag as flag, l_linestatus as flag_2 from lineitem"""
)
def two_row_header_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as an export named in rows 3 (to column B) and 2 (beyond), one row of units below, in many files."""
    from concordat.sources import read_two_row_header

    path = f"{scratch(spark, 'export')}/lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    above = ["Export,,,", "ids,,flag, flag", "l_orderkey,line,x,y", "no,no,text,text"]
    # a line per row, a file for each 50,000 orders' numbers; the rows above the data come first in every file
    files = spark.range(0, 1 + lines.agg(F.max("l_orderkey")).first()[0] // 50_000).select(F.col("id").cast("int").alias("file"))
    above = F.posexplode(F.array(*[F.lit(row) for row in above])).alias("at", "value")
    heads = files.select("file", F.lit(0).alias("kind"), above).select("file", "kind", F.col("at").cast("long").alias("at"), "value")
    rows = lines.select(
        F.floor(F.col("l_orderkey") / 50_000).cast("int").alias("file"), F.lit(1).alias("kind"), F.col("l_orderkey").cast("long").alias("at"),
        F.concat_ws(",", *lines.columns).alias("value"),
    )
    ordered = heads.union(rows).repartition("file").sortWithinPartitions("file", "kind", "at")
    ordered.select("file", "value").write.partitionBy("file").text(path)
    return read_two_row_header(
        spark, f"{path}/*", demographics_column_end="B", demographics_header_row=3, clinical_header_row=2, skip_rows_after_header=1
    )


@query(
    """select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus,
           case when o_orderkey % 3 < 2 then cast(o_custkey as varchar) end as o_custkey,
           case when o_orderkey % 3 = 1 then o_orderpriority end as o_orderpriority
       from orders"""
)
def text_folder_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in one folder of files with three headers: other orders of columns, one column absent, one more."""
    path = f"{scratch(spark, 'tsv')}/orders"
    orders = table(spark, sf_dir, "orders")
    layouts = ["o_orderkey o_orderstatus o_custkey", "o_custkey o_orderpriority o_orderkey o_orderstatus", "o_orderstatus o_orderkey"]
    for n, columns in enumerate(layouts):
        some = orders.where(F.col("o_orderkey") % 3 == n).select(*columns.split())
        some.write.mode("append").option("header", True).option("sep", "\t").csv(path)
    return read_table(spark, path, "tsv").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")


@query(
    """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as line,
           case when l_orderkey % 2 = 0 then l_returnflag end as flag, l_linestatus as status from lineitem"""
)
def two_row_header_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as exports named in two ways in one folder: each file by its own header row."""
    from concordat.sources import read_two_row_header

    path = f"{scratch(spark, 'export')}/lines"
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    for n, columns in enumerate((["l_orderkey", "line", "flag", "status"], ["status", "line", "l_orderkey"])):
        lines.where(F.col("l_orderkey") % 2 == n).select(*columns).write.mode("append").option("header", True).csv(path)
    return read_two_row_header(spark, path, demographics_column_end="B", demographics_header_row=1, clinical_header_row=1)
