"""Casts that give null, never an error, for text that does not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from ..model import DEFAULT_DATE_FORMATS
from .text import strip

# Plain decimal notation. Keeps out what only some engines read as numbers: 1d, 1f, 1_0, 0x10, NaN.
NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


ISO_DATE_FORMAT = "yyyy-MM-dd"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.VarcharType, T.CharType))


def without_nan(value: Column, data_type: T.DataType) -> Column:
    """NaN is a missing value, so it becomes null."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def as_number(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return without_nan(value, data_type).cast("double")
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if _is_text(data_type):
        text = strip(value)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.lit(None).cast("double")


def as_date(value: Column, data_type: T.DataType, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """First of the formats that parses. Dates and timestamps stay as they are."""
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value
    if _is_text(data_type):
        text = strip(value)
        return F.coalesce(*[_parse_date(text, fmt) for fmt in formats])
    return F.lit(None).cast("date")


def _parse_date(text: Column, fmt: str) -> Column:
    if fmt == ISO_DATE_FORMAT:
        # the cast reads this layout several times faster than a formatter, most of all when it fails
        return F.when(text.rlike(ISO_DATE_PATTERN), text.try_cast("date"))
    return F.try_to_date(text, fmt)


def cast_to(
    value: Column,
    data_type: T.DataType,
    target: str,
    formats: Sequence[str] = DEFAULT_DATE_FORMATS,
) -> Column:
    """``numeric``, ``date``, ``string``, ``boolean`` or any Spark type name (which raises on bad values)."""
    if target == "numeric":
        return as_number(value, data_type)
    if target == "date":
        return as_date(value, data_type, formats)
    return value.cast(target)
