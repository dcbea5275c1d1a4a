"""Imports every query module, so that the registry is complete."""

from locuspark.suite import (  # noqa: F401
    assessment,
    checks,
    comparison,
    completeness,
    detection,
    files,
    lookups,
    panels,
    scalars,
    worklogs,
)
from locuspark.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
