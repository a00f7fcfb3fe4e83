from .casting import as_date, as_number, cast_to, without_nan
from .text import (
    canonical_name,
    clean_text,
    is_blank,
    is_missing,
    is_selected,
    is_truthy,
    recode,
    ref,
    strip,
)

__all__ = [
    "as_date",
    "as_number",
    "cast_to",
    "canonical_name",
    "clean_text",
    "is_blank",
    "is_missing",
    "is_selected",
    "is_truthy",
    "recode",
    "ref",
    "strip",
    "without_nan",
]
