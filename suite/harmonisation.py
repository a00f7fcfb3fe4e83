"""Two sources of the same variables, codebooks and the variable catalog, all made from ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from concordat.operators import catalog, harmonize

from .registry import query, table

QUESTIONS = ["patient_id", "brand", "price", "code", "only_once", "only_quince", "nowhere"]
REVIEW = {"brand", "code", "only_once", "nowhere"}


def once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts, those of the largest sizes under keys of their own."""
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 40, -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("patient_id"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_size") != 20, F.col("p_retailprice")).alias("price"),
        F.col("p_size").alias("code"),
        F.col("p_type").alias("only_once"),
        F.lit(1).alias("unasked"),
    )


def quince(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts, those of the smallest sizes under keys of their own, some values missing, some different, codes as text."""
    kind = F.col("p_type")
    brand = F.when(kind == "PROMO", F.concat("p_brand", F.lit("x"))).otherwise(F.col("p_brand"))
    code = F.col("p_size").cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") < 11, -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("patient_id"),
        F.when(kind != "SMALL", brand).alias("brand"),
        F.when(kind == "LARGE", F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(kind == "ECONOMY", F.concat(F.lit("0"), code)).otherwise(code).alias("code"),
        F.col("p_name").alias("only_quince"),
    )


SOURCES_SQL = """
a as (select case when p_size > 40 then -p_partkey else p_partkey end as k, p_brand as brand, case when p_size <> 20 then p_retailprice end as price,
             p_size as code, p_type as oo from part),
b as (select case when p_size < 11 then -p_partkey else p_partkey end as k,
             case when p_type = 'SMALL' then null when p_type = 'PROMO' then p_brand || 'x' else p_brand end as brand,
             case when p_type = 'LARGE' then p_retailprice + 1 else p_retailprice end as price,
             case when p_type = 'ECONOMY' then '0' || p_size else cast(p_size as varchar) end as code,
             p_name as oq from part)"""

HARMONIZED = f"""with {SOURCES_SQL}
select coalesce(a.k, b.k) as patient_id,
  a.brand as brand__once, b.brand as brand__quince, coalesce(a.brand, b.brand) as brand,
  true as brand__needs_review_flag, coalesce(a.brand <> b.brand, false) as brand__source_conflict_flag,
  a.price as price__once, b.price as price__quince, coalesce(a.price, b.price) as price,
  a.code as code__once, b.code as code__quince, coalesce(cast(a.code as varchar), b.code) as code,
  true as code__needs_review_flag, coalesce(cast(a.code as varchar) <> b.code, false) as code__source_conflict_flag,
  a.oo as only_once, true as only_once__needs_review_flag, false as only_once__source_conflict_flag,
  b.oq as only_quince,
  cast(null as varchar) as nowhere, true as nowhere__needs_review_flag, false as nowhere__source_conflict_flag
from a full join b on a.k = b.k"""


@query(HARMONIZED)
def harmonized_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize.harmonized_merge(once(spark, sf_dir), quince(spark, sf_dir), "patient_id", QUESTIONS, REVIEW)


# --- codebook ---------------------------------------------------------------------------------


def raw_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as questions: padded, repeated, some blank or null."""
    size = F.col("p_size")
    padded = F.when(size < 25, F.concat(F.lit(" "), "p_name", F.lit("\t"))).otherwise(F.col("p_name"))
    name = F.when(size == 13, F.lit("  ")).when(size != 14, padded)
    flag = F.when(F.col("p_type") == "PROMO", F.lit(" TRUE")).when(F.col("p_type") != "SMALL", F.lit("no"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("QUESTION_NAME"), flag.alias("needs_review"))


@query(
    """with c as (select p_partkey, p_name, p_type, row_number() over (partition by p_name order by p_partkey) as i
      from part where p_size not in (13, 14))
    select p_partkey, p_name as "QUESTION_NAME", p_type = 'PROMO' as needs_review from c where i = 1"""
)
def codebook_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize.load_codebook(raw_codebook(spark, sf_dir), order_by=["p_partkey"])


def type_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as questions; the first part of a type says whether to review it."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit(" q_"), F.lower("p_type")).alias("QUESTION_NAME"),
        F.when(F.col("p_size") > 25, F.lit("y")).otherwise(F.lit("n")).alias("needs_review"),
    )


TYPE_CODEBOOK = """
c as (select 'q_' || lower(p_type) as q, p_size > 25 as review,
             row_number() over (partition by p_type order by p_partkey) as i from part),
coverage as (select q as question_name, q in ('q_economy', 'q_small', 'q_large') as in_once,
  q in ('q_large', 'q_promo') as in_quince, q in ('q_large') as shared_between_sources, review as needs_review
  from c where i = 1)"""


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    a = part.select(*[F.col("p_size").alias(n) for n in ("patient_id", "q_economy", "q_small", "q_large")])
    b = part.select(*[F.col("p_size").alias(n) for n in ("patient_id", "q_large", "q_promo", "q_other")])
    loaded = harmonize.load_codebook(type_codebook(spark, sf_dir), order_by=["p_partkey"])
    return harmonize.codebook_coverage(loaded, a, b)


@query(f"with {TYPE_CODEBOOK} select * from coverage")
def codebook_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)


@query(
    f"""with {TYPE_CODEBOOK}
    select cast(count(*) filter (where in_once and in_quince) as bigint) as shared_variables_count,
           cast(count(*) filter (where in_once and not in_quince) as bigint) as once_only_variables_count,
           cast(count(*) filter (where not in_once and in_quince) as bigint) as quince_only_variables_count,
           cast(count(*) filter (where needs_review) as bigint) as needs_review_variables_count
    from coverage"""
)
def codebook_coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize.coverage_counts(_coverage(spark, sf_dir))


# --- catalog ----------------------------------------------------------------------------------


def variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a variable dictionary."""
    size, kind = F.col("p_size"), F.col("p_type")
    status = F.when(kind.isin("LARGE", "PROMO"), F.lit("once_only")).when(kind == "SMALL", F.lit("quince_only"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), "p_name", F.lit(" "), "p_partkey").alias("QUESTION_NAME"),
        status.otherwise(F.lit("both_studies")).alias("MERGE_STATUS"),
        (kind != "SMALL").alias("PRESENT_ONCE"),
        F.when(kind.isin("LARGE", "PROMO"), F.lit("0")).otherwise(F.lit("1")).alias("PRESENT_QUINCE"),
        F.when(kind == "PROMO", F.lit("X ")).alias("SELECT_FOR_PIPELINE"),
        F.when(size > 10, F.when(size > 45, F.lit(0)).otherwise(F.lit(1))).alias("QUESTION_TEXTS_MATCH"),
        (kind != "LARGE").alias("FORM_NAMES_MATCH"),
        F.col("p_brand").alias("once_form_names"),
        F.col("p_brand").alias("quince_answer_ranges"),
        "p_retailprice",
    )


CATALOG = """
catalog as (
  select p_type not in ('LARGE', 'SMALL') as selected_for_pipeline,
         p_name || ' ' || p_partkey as canonical_variable_name, ' ' || p_name || ' ' || p_partkey as "QUESTION_NAME",
         case when p_type in ('LARGE', 'PROMO') then 'once_only' when p_type = 'SMALL' then 'quince_only'
              else 'both_studies' end as "MERGE_STATUS",
         case when p_type = 'SMALL' then 'quince' when p_type in ('LARGE', 'PROMO') then 'once' else 'once,quince' end
           as source_studies,
         p_size > 45 or p_type = 'LARGE' as needs_harmonization_review,
         p_brand as once_form_names, p_brand as quince_answer_ranges
  from part)"""


@query(f"with {CATALOG} select * from catalog")
def variable_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.build_catalog(variables(spark, sf_dir))


SUMMARY = f"""with {CATALOG}
select 'input_rows' as metric, cast(count(*) as bigint) as value from catalog
union all select 'selected_rows', cast(count(*) filter (where selected_for_pipeline) as bigint) from catalog
union all select 'both_studies', cast(count(*) filter (where "MERGE_STATUS" = 'both_studies') as bigint) from catalog
union all select 'once_only', cast(count(*) filter (where "MERGE_STATUS" = 'once_only') as bigint) from catalog
union all select 'quince_only', cast(count(*) filter (where "MERGE_STATUS" = 'quince_only') as bigint) from catalog
union all select 'harmonization_review_needed', cast(count(*) filter (where needs_harmonization_review) as bigint)
from catalog"""


@query(SUMMARY)
def variable_catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.catalog_summary(catalog.build_catalog(variables(spark, sf_dir), ordered=False))
