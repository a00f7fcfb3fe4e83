"""Text expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# The characters counted as white space, by code point (ranges inclusive).
WHITESPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(c) for low, high in WHITESPACE_RANGES for c in range(low, high + 1))
# The same as a pattern. Single Latin-1 characters become one table lookup in the regex engine, and
# the rest is only tried beyond them.
_BEYOND_LATIN = "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in WHITESPACE_RANGES if low > 0xFF)
WHITESPACE_CLASS = (
    "[" + "".join(f"\\x{ord(c):02x}" for c in WHITESPACE if ord(c) <= 0xFF) + f"[\\x{{100}}-\\x{{ffff}}&&[{_BEYOND_LATIN}]]]"
)

# Texts read as true.
TRUTHY = ("1", "true", "yes", "y", "x")
SELECTED = (*TRUTHY, "selected")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col(quoted(name))


def strip(text: Column) -> Column:
    # trim with a character list: no regex engine per row
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == F.lit("")


def is_missing(value: Column, data_type: T.DataType) -> Column:
    """Null, NaN or blank text; never null itself."""
    if isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        return value.isNull() | F.coalesce(is_blank(value), F.lit(False))
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _reads_as(value: Column, words: tuple[str, ...]) -> Column:
    return F.coalesce(F.lower(strip(value.cast("string"))).isin(*words), F.lit(False))


def is_truthy(value: Column) -> Column:
    return _reads_as(value, TRUTHY)


def is_selected(value: Column) -> Column:
    return _reads_as(value, SELECTED)


def clean_text(
    text: Column,
    *,
    trim: bool = True,
    replace_newlines: bool = True,
    replace_newlines_with: str = " ",
    collapse_whitespace: bool = True,
    uppercase: bool = False,
) -> Column:
    """Trim, replace runs of line breaks, collapse white space, upper-case: in this order."""
    steps = []
    if trim:
        steps.append(strip)
    # a line break replaced by space would be collapsed with its neighbours anyway
    redundant = collapse_whitespace and replace_newlines_with != "" and replace_newlines_with.isspace()
    if replace_newlines and not redundant:
        literal = re.sub(r"([\\$])", r"\\\1", replace_newlines_with)
        steps.append(lambda c: F.regexp_replace(c, r"[\r\n]+", literal))
    if collapse_whitespace:
        steps.append(lambda c: strip(F.regexp_replace(c, WHITESPACE_CLASS + "+", " ")))
    if uppercase:
        steps.append(F.upper)
    return reduce(lambda column, step: step(column), steps, text)


def recode_key(value: object) -> str:
    return str(value).strip().lower()


def recode(text: Column, mapping: Mapping[str, str]) -> Column:
    """Replace values found in ``mapping`` ignoring case and outer spaces; keep all others.

    For short lists, whose entries are tried one by one; ``normalize_categories`` takes lists of any length.
    """
    if not mapping:
        return text
    entries = {recode_key(key): str(value) for key, value in mapping.items()}
    lookup = F.create_map(*[F.lit(part) for pair in entries.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, F.lower(strip(text))), text)


def canonical_name(name: str) -> str:
    """Header to snake case: separators become single underscores, none at the ends."""
    return re.sub(r"[\n\r\t/\- _]+", "_", name.strip().lower()).strip("_")
