"""Registered queries: every operator on the given tables, each with its SQL twin."""

from . import column_checks, io_checks, mart_checks, report_checks, study_checks  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
