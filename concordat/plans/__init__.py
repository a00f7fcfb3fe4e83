from .cohort import CohortResult, harmonize_cohort
from .tables import RunResult, curate_and_merge, merge_and_write, wide_export_domains
from .catalog import CatalogResult, run_catalog

__all__ = [
    "CatalogResult",
    "CohortResult",
    "RunResult",
    "curate_and_merge",
    "harmonize_cohort",
    "merge_and_write",
    "run_catalog",
    "wide_export_domains",
]
