from .catalog import build_catalog, catalog_summary
from .checks import (
    cast_expected_types,
    detect_duplicates,
    duplicate_rows,
    parse_dates_safely,
    profile_missingness,
    run_business_rules,
    run_sanity_checks,
    validate,
    validate_allowed_values,
    validate_columns,
    validate_domains,
    validate_dtypes,
    validate_primary_key,
    validate_ranges,
    validate_required_fields,
)
from .contract import ContractError, DatasetSchemaSpec, SchemaRegistry, build_schema_from_spec, contract_failures
from .harmonize import codebook_coverage, harmonized_merge, load_codebook
from .headers import clean_base_table, domain_view, domain_views, map_headers, normalize_text, standardize_names
from .merge import (
    extract_unmatched,
    key_histogram,
    merge_chain,
    merge_metrics,
    merge_rows,
    perform_merge,
    unmatched_rows,
    validate_merge_keys,
)
from .reports import counts_by_stage, exclusion_totals, issues_of, run_summary
from .transform import cast_columns, derive, harmonize_variables, normalize_categories, with_row_index

__all__ = [
    "ContractError",
    "DatasetSchemaSpec",
    "SchemaRegistry",
    "build_catalog",
    "build_schema_from_spec",
    "cast_columns",
    "cast_expected_types",
    "catalog_summary",
    "clean_base_table",
    "codebook_coverage",
    "contract_failures",
    "counts_by_stage",
    "derive",
    "detect_duplicates",
    "domain_view",
    "domain_views",
    "duplicate_rows",
    "exclusion_totals",
    "extract_unmatched",
    "harmonize_variables",
    "harmonized_merge",
    "issues_of",
    "key_histogram",
    "load_codebook",
    "map_headers",
    "merge_chain",
    "merge_metrics",
    "merge_rows",
    "normalize_categories",
    "normalize_text",
    "parse_dates_safely",
    "perform_merge",
    "profile_missingness",
    "run_business_rules",
    "run_sanity_checks",
    "run_summary",
    "standardize_names",
    "unmatched_rows",
    "validate",
    "validate_allowed_values",
    "validate_columns",
    "validate_domains",
    "validate_dtypes",
    "validate_merge_keys",
    "validate_primary_key",
    "validate_ranges",
    "validate_required_fields",
    "with_row_index",
]
