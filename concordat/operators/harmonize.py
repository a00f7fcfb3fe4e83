"""Two sources of the same variables brought into one table, steered by a codebook."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.text import is_truthy, quoted, ref, strip
from ..model import local_table
from .merge import HOT_KEY_ROWS, hot_keys_of, merge_rows

SOURCES = ("once", "quince")


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, as a map-side combined minimum."""
    row = F.struct(*[ref(c) for c in df.columns])
    order = F.struct(*[ref(c) for c in order_by])
    first = df.groupBy(ref(key).alias("__key")).agg(F.min_by(row, order).alias("__row"))
    return first.select("__row.*")


def load_codebook(
    codebook: DataFrame,
    question_name_column: str = "QUESTION_NAME",
    review_column: str = "needs_review",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Trimmed names, no blank ones, first row per name, review flag as boolean.

    ``order_by`` says which row is first; without it, the review flag decides (flagged first).
    """
    missing = [c for c in (question_name_column, review_column) if c not in codebook.columns]
    if missing:
        raise ValueError(f"Final codebook is missing required columns: {missing}")
    cleaned = codebook.withColumn(question_name_column, strip(ref(question_name_column).cast("string")))
    cleaned = cleaned.filter(F.length(ref(question_name_column)) > 0)
    if order_by is None:
        cleaned = cleaned.withColumn("__first", ~is_truthy(ref(review_column)))
        kept = first_per_key(cleaned, question_name_column, ["__first", *codebook.columns]).drop("__first")
    else:
        kept = first_per_key(cleaned, question_name_column, order_by)
    return kept.withColumn(review_column, is_truthy(ref(review_column)))


def codebook_coverage(
    codebook: DataFrame,
    once: DataFrame,
    quince: DataFrame,
    question_name_column: str = "QUESTION_NAME",
    review_column: str = "needs_review",
    sources: tuple[str, str] = SOURCES,
) -> DataFrame:
    """Which source holds each question of a loaded codebook."""
    spark = codebook.sparkSession
    names = local_table(
        spark,
        [(c, c in once.columns, c in quince.columns) for c in dict.fromkeys([*once.columns, *quince.columns])],
        "question_name string, in_a boolean, in_b boolean",
    )
    asked = codebook.select(ref(question_name_column).alias("question_name"), ref(review_column).alias("needs_review"))
    in_a, in_b = F.coalesce("in_a", F.lit(False)), F.coalesce("in_b", F.lit(False))
    return asked.join(names, "question_name", "left").select(
        "question_name",
        in_a.alias(f"in_{sources[0]}"),
        in_b.alias(f"in_{sources[1]}"),
        (in_a & in_b).alias("shared_between_sources"),
        "needs_review",
    )


def coverage_counts(coverage: DataFrame, sources: tuple[str, str] = SOURCES) -> DataFrame:
    a, b = F.col(f"in_{sources[0]}"), F.col(f"in_{sources[1]}")
    return coverage.agg(
        F.count_if(a & b).alias("shared_variables_count"),
        F.count_if(a & ~b).alias(f"{sources[0]}_only_variables_count"),
        F.count_if(~a & b).alias(f"{sources[1]}_only_variables_count"),
        F.count_if(F.col("needs_review")).alias("needs_review_variables_count"),
    )


def codebook_questions(
    codebook: DataFrame,
    question_name_column: str = "QUESTION_NAME",
    review_column: str = "needs_review",
    order_by: Sequence[str] | None = None,
) -> tuple[list[str], set[str]]:
    """Names that become columns, so they must be known here: they are the schema of the result."""
    ordered = codebook.orderBy(*[ref(c) for c in order_by or [question_name_column]])
    rows = ordered.select(ref(question_name_column), ref(review_column)).collect()
    return [r[0] for r in rows], {r[0] for r in rows if r[1]}


def harmonized_merge(
    once: DataFrame,
    quince: DataFrame,
    id_column: str,
    questions: Sequence[str],
    needs_review: Iterable[str] = (),
    *,
    sources: tuple[str, str] = SOURCES,
    hot_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Full outer join on the id with, per variable, the first source's value or else the second's.

    A variable of both sources also keeps both versions; one to be reviewed gets its flags. A
    variable of one source keeps that source's value. All columns come from one projection.
    """
    review = set(needs_review)
    variables = [q for q in dict.fromkeys(questions) if q != id_column]
    a_vars = [q for q in variables if q in once.columns]
    b_vars = [q for q in variables if q in quince.columns]
    suffix_a, suffix_b = (f"__{s}" for s in sources)

    # as SQL text: one call for a whole projection, where a wide table would take several for each column
    def side(df: DataFrame, names: Sequence[str], suffix: str) -> DataFrame:
        def cell(name: str) -> str:
            column, real = quoted(name), isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
            return f"{f'CASE WHEN NOT isnan({column}) THEN {column} END' if real else column} AS {quoted(name + suffix)}"

        return df.selectExpr(quoted(id_column), *map(cell, names))

    joined = merge_rows(
        side(once, a_vars, suffix_a),
        side(quince, b_vars, suffix_b),
        "outer",
        [id_column],
        indicator=None,
        hot_keys=hot_keys_of(once, quince, [id_column], hot_rows),
    )
    a_types, b_types = dict(once.dtypes), dict(quince.dtypes)

    def versions(question: str) -> tuple[str, str]:
        a, b = quoted(question + suffix_a), quoted(question + suffix_b)
        if a_types[question] != b_types[question]:
            return f"CAST({a} AS STRING)", f"CAST({b} AS STRING)"
        return a, b

    shared = set(a_vars) & set(b_vars)
    in_a, in_b = set(a_vars), set(b_vars)
    columns = [quoted(id_column)]
    for q in variables:
        if q in shared:
            a, b = versions(q)
            value = f"coalesce({a}, {b})"
            columns += [quoted(q + suffix_a), quoted(q + suffix_b)]
        elif q in in_a or q in in_b:
            value = quoted(q + (suffix_a if q in in_a else suffix_b))
        else:
            value = "CAST(NULL AS STRING)"
        columns.append(f"{value} AS {quoted(q)}")
        if q in review:
            flag = f"coalesce({a} <> {b}, false)" if q in shared else "false"
            columns += [f"true AS {quoted(q + '__needs_review_flag')}", f"{flag} AS {quoted(q + '__source_conflict_flag')}"]
    return joined.selectExpr(*columns)
