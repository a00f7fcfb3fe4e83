"""Row-wise transforms and the harmonisation of variable names."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.casting import cast_to
from ..functions.text import recode_key, ref, strip
from ..model import DEFAULT_DATE_FORMATS, local_table
from ..session import stored


def normalize_categories(df: DataFrame, mappings: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Recode the listed columns; unmapped values and nulls pass.

    Each mapping is a table joined by hash: a lookup costs the same however long the list is, and the
    planner, which knows its size, broadcasts it while it is small.
    """
    columns = df.columns
    for name, mapping in mappings.items():
        if name not in columns:
            continue
        text = ref(name).cast("string")
        recoded = text
        if mapping:
            rows = list({recode_key(key): str(value) for key, value in mapping.items()}.items())
            lookup = local_table(df.sparkSession, rows, "__recode_from string, __recode_to string")
            df = df.join(lookup, F.lower(strip(text)) == F.col("__recode_from"), "left")
            recoded = F.coalesce("__recode_to", text)
        df = df.withColumn(name, recoded).select(*[ref(c) for c in columns])
    return df


def cast_columns(
    df: DataFrame, casts: Mapping[str, str], date_formats: Sequence[str] = DEFAULT_DATE_FORMATS
) -> DataFrame:
    """``numeric`` and ``date`` give null for bad values; any other type name is a raising cast."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {c: cast_to(ref(c), types[c], target, date_formats) for c, target in casts.items() if c in types}
    )


def derive(df: DataFrame, derivations: Mapping[str, str | Callable[[DataFrame], Column]]) -> DataFrame:
    """Add columns in order; later ones see earlier ones.

    Text is a Spark SQL expression (``floor(a / b)``, ``pmod(a, b)``, ``pow(a, b)``, ``a = b``).
    """
    for name, rule in derivations.items():
        if isinstance(rule, str):
            df = df.withColumn(name, F.expr(rule))
        elif callable(rule):
            df = df.withColumn(name, rule(df))
        else:
            raise TypeError(f"Unsupported derivation rule type for {name}: {type(rule)}")
    return df


def with_row_index(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Consecutive row numbers from 0 in the given order, without gathering the rows anywhere.

    The sorted table is cut once so that both uses see the same partitions; what is added up
    serially is one count per partition.
    """
    position = F.monotonically_increasing_id()
    # the partition id lets the sort split rows that tie on everything else
    order = [*[ref(c) for c in order_by], F.spark_partition_id()]
    ordered = stored(df.orderBy(*order).withColumn("__pos", position))
    part, offset = F.shiftright("__pos", 33), F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    # one row per sort partition
    numbered = ordered.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.withColumn(name, F.col("__start") + offset).drop("__part", "__pos", "__start")


def _with_numbers_of_unnamed(named: DataFrame, order_by: Sequence[str]) -> DataFrame:
    # written with its locators, so that they are the same for the sort and for the join, whatever is run again
    located = stored(named.withColumn("__at", F.monotonically_increasing_id()))
    keys = [ref(c).alias(f"__by{i}") for i, c in enumerate(order_by)]
    numbered = with_row_index(
        located.select("__at", (F.col("__q") == "").alias("__unnamed"), *keys),
        [*[f"__by{i}" for i in range(len(keys))], "__at"],
        "__row",
    )
    unnamed = numbered.filter("__unnamed").select("__at", "__row")
    return located.join(unnamed, "__at", "left").drop("__at")


def harmonize_variables(
    df: DataFrame,
    mappings: Mapping[str, Any],
    source_study: str,
    question_name_col: str = "QUESTION_NAME",
    *,
    order_by: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Add ``HARMONIZED_VARIABLE`` and return the trace, one row per input row.

    Rows without a name are called ``row_<i>`` by their place in ``order_by``. Only the sorting keys and a locator of
    each row are sorted for that, and only the numbers of unnamed rows are joined back, where there are any.
    """
    spark = df.sparkSession
    entries = mappings.get("variables", mappings)
    rows = []
    for name, entry in entries.items():
        if isinstance(entry, Mapping):
            rows.append(
                (name, entry.get("harmonized", name), entry.get("rule", "question_name_exact"), entry.get("notes", ""))
            )
        elif isinstance(entry, str):
            rows.append((name, entry, "direct_mapping", ""))
    # no hint: the table's size is known to the planner, which broadcasts it when small
    lookup = local_table(spark, rows, "__name string, __harmonized string, __rule string, __notes string")

    raw = ref(question_name_col).cast("string") if question_name_col in df.columns else F.lit("")
    named = df.withColumn("__q", F.coalesce(strip(raw), F.lit("")))
    if named.filter(F.col("__q") == "").isEmpty():
        named = named.withColumn("__row", F.lit(None).cast("long"))
    else:
        named = _with_numbers_of_unnamed(named, order_by)
    joined = named.join(lookup, F.col("__q") == F.col("__name"), "left")
    fallback = F.when(F.col("__q") != "", F.col("__q")).otherwise(F.concat(F.lit("row_"), F.col("__row").cast("string")))
    joined = joined.withColumn("HARMONIZED_VARIABLE", F.coalesce("__harmonized", fallback))
    trace = joined.select(
        F.col("__q").alias("source_variable"),
        F.col("HARMONIZED_VARIABLE").alias("harmonized_variable"),
        F.lit(source_study).alias("source_study"),
        F.coalesce("__rule", F.lit("fallback_identity")).alias("rule_applied"),
        F.when(F.col("__rule").isNull(), F.lit("No mapping found; original variable retained"))
        .otherwise(F.col("__notes"))
        .alias("observations"),
    )
    return joined.drop("__q", "__name", "__harmonized", "__rule", "__notes", "__row"), trace
