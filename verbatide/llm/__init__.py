"""Operators for training-data pipelines, and their queries by name."""

from verbatide.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
