"""Corpus preparation for model training: thirteen operators and their registered queries."""

from ledgerlake.llm import q_audit, q_exact, q_models  # noqa: F401 - importing registers the queries
from ledgerlake.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
