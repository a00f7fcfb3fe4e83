"""Variable catalog: which variables are selected, where they occur, which need review."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casting import as_number
from ..functions.text import is_missing, is_selected, is_truthy, ref, strip

SOURCES = ("once", "quince")

# Columns that tell whether the sources agree (1 = they do).
MATCH_COLUMNS = (
    "QUESTION_TEXTS_MATCH",
    "ANSWER_FORMATS_MATCH",
    "ANSWER_RANGES_MATCH",
    "DISPLAY_OPTIONS_MATCH",
    "FORM_NAMES_MATCH",
)
# Descriptive columns kept per source, where they exist.
DETAIL_COLUMNS = ("form_names", "question_texts", "answer_formats", "answer_ranges")


def _present(source: str) -> str:
    return f"PRESENT_{source.upper()}"


def is_present(df: DataFrame, source: str) -> Column:
    """Any number but zero, or a truthy word."""
    name = _present(source)
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.NumericType):
        return F.coalesce(as_number(ref(name), data_type) != 0, F.lit(False))
    return is_truthy(ref(name))


def source_studies(df: DataFrame, sources: Sequence[str] = SOURCES) -> Column:
    return F.concat_ws(",", *[F.when(is_present(df, s), F.lit(s)) for s in sources])


def needs_review(df: DataFrame) -> Column:
    """True when any match column says otherwise; an absent or null one counts as matching."""
    differs = []
    for name in MATCH_COLUMNS:
        if name in df.columns:
            data_type = df.schema[name].dataType
            agrees = F.coalesce(as_number(ref(name), data_type) == 1.0, F.lit(False))
            differs.append(~is_missing(ref(name), data_type) & ~agrees)
    return reduce(lambda a, b: a | b, differs, F.lit(False))


def selection(df: DataFrame, select_column: str, mode: str) -> Column:
    explicit = is_selected(ref(select_column)) if select_column in df.columns else F.lit(False)
    if mode != "both_studies":
        return F.lit(True)
    return explicit | F.coalesce(ref("MERGE_STATUS") == "both_studies", F.lit(False))


def _require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Catalog sheet is missing columns: {missing}")


def build_catalog(
    variables: DataFrame,
    *,
    question_name_column: str = "QUESTION_NAME",
    select_column: str = "SELECT_FOR_PIPELINE",
    mode: str = "both_studies",
    sources: Sequence[str] = SOURCES,
    ordered: bool = True,
) -> DataFrame:
    """Selected variables first, then by name. ``ordered=False`` leaves the sort (a range shuffle) out."""
    _require(variables, [question_name_column, "MERGE_STATUS", *[_present(s) for s in sources]])
    details = [f"{s}_{d}" for d in DETAIL_COLUMNS for s in sources if f"{s}_{d}" in variables.columns]
    catalog = variables.select(
        selection(variables, select_column, mode).alias("selected_for_pipeline"),
        F.coalesce(strip(ref(question_name_column).cast("string")), F.lit("")).alias("canonical_variable_name"),
        ref(question_name_column),
        ref("MERGE_STATUS"),
        source_studies(variables, sources).alias("source_studies"),
        needs_review(variables).alias("needs_harmonization_review"),
        *[ref(c) for c in details],
    )
    if not ordered:
        return catalog
    # the partition id breaks ties, so rows of one name need not all sort in one task
    return catalog.orderBy(
        F.desc("selected_for_pipeline"), F.asc("canonical_variable_name"), F.spark_partition_id()
    )


def catalog_summary(catalog: DataFrame, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Totals in long form, from one pass over the catalog."""
    statuses = ("both_studies", *[f"{s}_only" for s in sources])
    totals = catalog.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("selected_for_pipeline")).alias("selected_rows"),
        *[F.count_if(F.col("MERGE_STATUS") == s).alias(s) for s in statuses],
        F.count_if(F.col("needs_harmonization_review")).alias("harmonization_review_needed"),
    )
    return totals.unpivot([], totals.columns, "metric", "value")
