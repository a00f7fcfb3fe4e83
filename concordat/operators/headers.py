"""Operators on column names and column sets. None of them starts a job on the data."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import canonical_name, clean_text, ref
from ..model import ERROR, issue, issues_frame, local_table

AUDIT_SCHEMA = "raw_column string, mapped_column string, mapping_type string, details string"


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def canonical_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[canonical_name(c) for c in df.columns])


def standard_name(name: str) -> str:
    return re.sub(r"[ /\-]", "_", name.strip().lower())


def standardize_names(df: DataFrame) -> DataFrame:
    """Lower snake-case names; unlike canonical names, runs of underscores stay."""
    return df.toDF(*[standard_name(c) for c in df.columns])


def clean_header(value: str | None, fallback: str) -> str:
    """Header text in compatibility form, control characters as spaces, single spaces."""
    text = unicodedata.normalize("NFKC", value or "")
    return " ".join(re.sub(r"[\x00-\x1f\x7f]", " ", text).split()) or fallback


def unique_headers(names: Sequence[str]) -> list[str]:
    """Repeated names get _2, _3 and so on; a number already taken by another name is passed over."""
    seen: Counter[str] = Counter()
    taken = set(names)
    result = []
    for name in names:
        seen[name] += 1
        candidate = name
        while seen[name] > 1:
            candidate = f"{name}_{seen[name]}"
            if candidate not in taken:
                break
            seen[name] += 1
        taken.add(candidate)
        result.append(candidate)
    return result


def existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that exist, in the given order."""
    return df.select(*[ref(c) for c in columns if c in df.columns])


def select_variables(df: DataFrame, id_column: str, questions: Sequence[str]) -> DataFrame:
    return existing(df, [id_column, *[q for q in questions if q != id_column]])


def normalize_text(
    df: DataFrame,
    *,
    uppercase_all: bool = False,
    uppercase_columns: Sequence[str] = (),
    **rules: Any,
) -> DataFrame:
    """Clean every text column in one projection; other columns are untouched."""

    def cleaned(field: T.StructField) -> Column:
        if not isinstance(field.dataType, T.StringType):
            return ref(field.name)
        return clean_text(ref(field.name), uppercase=uppercase_all or field.name in uppercase_columns, **rules)

    return df.select(*[cleaned(f).alias(f.name) for f in df.schema.fields])


@dataclass(frozen=True)
class HeaderMapping:
    """A mapped table with the audit of its headers."""

    table: DataFrame
    audit: DataFrame
    metrics: DataFrame
    issues: DataFrame
    domains: dict[str, dict[str, Any]]
    succeeded: bool


def plan_headers(
    raw_columns: Sequence[str], raw_to_canonical: Mapping[str, str], target_pool: set[str]
) -> list[tuple[str, str, str, str]]:
    """One audit row per raw column: by hand, else by canonical form, else unmapped."""
    targets: set[str] = set()
    rows = []
    for raw in raw_columns:
        automatic = canonical_name(raw)
        if raw in raw_to_canonical:
            target, kind, note = raw_to_canonical[raw], "manual", "mapped via raw_to_canonical"
        elif automatic and automatic not in targets and automatic in (target_pool or {automatic}):
            target, kind, note = automatic, "automatic", "mapped by canonicalized header fallback"
        else:
            target, kind, note = "", "unmapped", "no manual mapping and automatic mapping not applicable"
        if target:
            targets.add(target)
        rows.append((raw, target, kind, note))
    return rows


def map_headers(df: DataFrame, mapping: Mapping[str, Any], dataset_id: str = "single_workbook_input") -> HeaderMapping:
    """Rename raw headers to canonical ones, clean the text and check each domain's required columns.

    Two raw headers with one target give a ``duplicate_target`` error; the first keeps the name and
    the later one is left out of the table.
    """
    spark = df.sparkSession
    by_hand = mapping.get("raw_to_canonical", {})
    domains = mapping.get("datasets", {})
    if not isinstance(by_hand, Mapping):
        raise ValueError("The header mapping requires a 'raw_to_canonical' dictionary")
    if not isinstance(domains, Mapping):
        raise ValueError("The header mapping requires a 'datasets' dictionary")

    pool = {column for domain in domains.values() for column in domain.get("target_columns", [])}
    stripped = [c.strip() for c in df.columns]
    audit = plan_headers(stripped, by_hand, pool)

    found: list[tuple] = []
    kept: dict[str, int] = {}
    for position, (raw, target, _, _) in enumerate(audit):
        name = target or raw
        if name in kept:
            found.append(
                issue(dataset_id, "normalization", "duplicate_target", ERROR,
                      f"Header {raw!r} maps to {name!r}, already taken by {stripped[kept[name]]!r}", column_name=raw)
            )
        else:
            kept[name] = position
    # by position: raw headers may differ only in case or surrounding space
    by_position = df.toDF(*[f"__c{i}" for i in range(len(stripped))])
    renamed = by_position.select(*[F.col(f"__c{i}").alias(name) for name, i in kept.items()])
    table = normalize_text(renamed, **_text_rules(mapping.get("text_normalization", {})))

    for name, domain in domains.items():
        missing = [c for c in domain.get("required_columns", []) if c not in kept]
        if missing and str(domain.get("on_missing_required", "error")).lower() == "error":
            found.append(
                issue(name, "normalization", "required_columns_present", ERROR,
                      f"Missing required mapped columns: {missing}", ",".join(missing), len(missing))
            )
    kinds = Counter(kind for _, _, kind, _ in audit)
    counts = (len(audit), len({raw for raw, target, _, _ in audit if target}), kinds["automatic"], kinds["unmapped"])
    metrics = local_table(
        spark,
        [counts],
        "raw_column_count long, mapped_column_count long, automatic_mapped_count long, unmapped_column_count long",
    )
    views = {
        name: {"columns": list(domain.get("target_columns", [])), "rename": dict(domain.get("rename", {}))}
        for name, domain in domains.items()
    }
    return HeaderMapping(
        table, local_table(spark, audit, AUDIT_SCHEMA), metrics, issues_frame(spark, found), views, not found
    )


def _text_rules(rules: Mapping[str, Any]) -> dict[str, Any]:
    known = (
        "trim", "replace_newlines", "replace_newlines_with", "collapse_whitespace", "uppercase_all", "uppercase_columns",
    )
    return {key: rules[key] for key in known if key in rules}


def domain_view(
    df: DataFrame,
    columns: Sequence[str],
    rename: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The asked-for columns in order, absent ones as nulls, then renamed."""
    rename, types = rename or {}, types or {}
    return df.select(
        *[
            (ref(c) if c in df.columns else F.lit(None).cast(types.get(c, "string"))).alias(rename.get(c, c))
            for c in columns
        ]
    )


def domain_views(df: DataFrame, domains: Mapping[str, Mapping[str, Any]]) -> dict[str, DataFrame]:
    return {name: domain_view(df, d.get("columns", []), d.get("rename", {})) for name, d in domains.items()}


# --- rows of a wide export --------------------------------------------------------------------


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def clean_base_table(df: DataFrame, id_column: str | None = "patient_id") -> DataFrame:
    """Stripped names, no all-null rows, no rows without an id."""
    cleaned = drop_empty_rows(strip_names(df))
    if id_column and id_column in cleaned.columns:
        return cleaned.dropna(subset=[id_column])
    return cleaned
