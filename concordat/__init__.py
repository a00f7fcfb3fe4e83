"""Table quality checks, audited merges and two-source harmonisation on Spark."""

from .model import DatasetSpec, MergeStep
from .session import build_session

__all__ = ["DatasetSpec", "MergeStep", "build_session"]
