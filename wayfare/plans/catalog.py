"""Imports every module that registers queries."""

from wayfare.plans import q_eval, q_explore, q_quality, q_rank, q_stream, q_tables  # noqa: F401
from wayfare.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
