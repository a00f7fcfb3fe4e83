from . import checks, harmonisation, headers, merges, reports, transforms, workflows  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
