"""Readers. Delimited text is read as text only: no inference pass, no types that depend on the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import ref
from ..model import DatasetSpec, local_table
from ..operators.headers import clean_header, unique_headers
from ..session import stored
from .layouts import by_layout, head_rows, literal_path

DELIMITERS = {"csv": ",", "tsv": "\t"}
TWO_ROW_HEADER = "two_row_header"

# Cell texts read as missing.
NA_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _format_of(path: str, file_type: str | None) -> str:
    return (file_type or PurePosixPath(str(path)).suffix.lstrip(".")).lower()


def _na_to_null(df: DataFrame, na_texts: Sequence[str]) -> DataFrame:
    if not na_texts:
        return df
    return df.select(*[F.when(~ref(c).isin(*na_texts), ref(c)).alias(c) for c in df.columns])


def _text_reader(spark: SparkSession, sep: str, header: bool, multi_line: bool):
    options = {"header": header, "sep": sep, "escape": '"', "multiLine": multi_line}
    return spark.read.options(**options)


def _by_name(spark: SparkSession, path: str, sep: str, multi_line: bool) -> DataFrame:
    layouts = by_layout([(file, tuple(rows[0])) for file, rows in head_rows(spark, path, sep)])
    reader = _text_reader(spark, sep, True, multi_line)
    if len(layouts) < 2:
        return reader.csv(path)
    scans = [reader.csv([literal_path(f) for f in files]) for _, files in layouts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def read_table(
    spark: SparkSession,
    path: str,
    file_type: str | None = None,
    *,
    columns: Sequence[str] | None = None,
    na_texts: Sequence[str] = NA_TEXTS,
    multi_line: bool = False,
) -> DataFrame:
    """Read CSV, TSV or Parquet; an explicit type wins over the suffix.

    Text files are read by name: the files of a folder may have their columns in any order, and a column that a file
    lacks is null there. Files of one header share a scan. ``columns`` selects columns by name (null where no file has
    one). ``layout_findings`` tells which files lack what. Set ``multi_line`` for files with quoted line breaks; such files
    cannot be split among tasks.
    """
    kind = _format_of(path, file_type)
    if kind == "parquet":
        return spark.read.parquet(str(path))
    if kind == TWO_ROW_HEADER:
        return read_two_row_header(spark, path, na_texts=na_texts, multi_line=multi_line)
    if kind in DELIMITERS:
        df = _by_name(spark, str(path), DELIMITERS[kind], multi_line)
        if columns:
            df = df.select(*[ref(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
        return _na_to_null(df, na_texts)
    raise ValueError(f"Unsupported file type: {kind}")


def read_table_from_spec(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    if (spec.header_strategy or "").lower() == TWO_ROW_HEADER:
        return read_two_row_header(
            spark,
            spec.path,
            sep=DELIMITERS.get(_format_of(spec.path, spec.file_type), ","),
            demographics_column_end=spec.demographics_column_end,
            demographics_header_row=spec.demographics_header_row,
            clinical_header_row=spec.clinical_header_row,
            skip_rows_after_header=spec.skip_rows_after_header,
            multi_line=spec.multi_line,
        )
    return read_table(spark, spec.path, spec.file_type, multi_line=spec.multi_line)


def column_index(letters: str) -> int:
    """Zero-based position of a spreadsheet column letter: A is 0, AA is 26."""
    text = letters.strip().upper()
    if not text.isascii() or not text.isalpha():
        raise ValueError(f"Invalid Excel column name: {letters!r}")
    return reduce(lambda total, letter: total * 26 + ord(letter) - ord("A") + 1, text, 0) - 1


def read_two_row_header(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    demographics_column_end: str = "N",
    demographics_header_row: int = 3,
    clinical_header_row: int = 2,
    skip_rows_after_header: int = 0,
    na_texts: Sequence[str] = NA_TEXTS,
    multi_line: bool = False,
) -> DataFrame:
    """Export whose columns up to a boundary letter are named in one row and the rest in another.

    Every file is named by its own rows; files of one layout share a scan, and layouts are joined by name, null where a
    file lacks a column. The rows above the data are dropped from every file. The text is parsed once, into a stored
    table that numbers its rows in the order of the files, so a file's first rows are those next to its least number.
    """
    named_rows = max(demographics_header_row, clinical_header_row)
    skipped = named_rows + max(skip_rows_after_header, 0)
    heads = head_rows(spark, path, sep, named_rows)
    if not heads:
        raise ValueError(f"The export '{path}' does not contain any columns.")
    boundary = column_index(demographics_column_end)

    def names_of(file: str, rows: list[list[str]]) -> tuple[str, ...]:
        label = path if len(heads) == 1 else file
        if len(rows) < named_rows:
            raise ValueError(f"The export '{label}' must include at least {named_rows} rows; got {len(rows)} rows.")
        width = max(map(len, rows))
        last = min(boundary, width - 1)
        groups = (
            ("demographic", demographics_header_row, range(0, last + 1)),
            ("variable", clinical_header_row, range(last + 1, width)),
        )
        names: list[str] = []
        for group, row, positions in groups:
            texts = rows[row - 1]
            cleaned = [clean_header(texts[i] if i < len(texts) else None, "") for i in positions]
            empty = [str(i + 1) for i, name in zip(positions, cleaned) if not name]
            if empty:
                raise ValueError(
                    f"The export '{label}' has empty {group} headers in row {row} for columns: {', '.join(empty)}."
                )
            names += cleaned
        return tuple(unique_headers(names))

    parts = []
    for names, files in by_layout([(file, names_of(file, rows)) for file, rows in heads]):
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        # a row without any cell still has its separators; wholly empty lines are not rows
        raw = _text_reader(spark, sep, False, multi_line).schema(schema).csv([literal_path(f) for f in files])
        file, block = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")
        placed = stored(raw.select(*schema.names, file, block, F.monotonically_increasing_id().alias("__id")))
        first = placed.filter("__block = 0").groupBy("__file").agg(F.min("__id").alias("__first")).collect()
        firsts = local_table(spark, [tuple(r) for r in first], "__file string, __first long")
        below = placed.join(firsts, "__file", "left").filter(f"__block > 0 or __id >= __first + {skipped}")
        parts.append(below.select(*schema.names).toDF(*names))
    return _na_to_null(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), na_texts)
