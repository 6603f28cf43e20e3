"""The registered queries: each operator bound to the given tables, with its SQL."""

from catalog import cleaning, corpus, extraction, learning, scoring, tables, wordvectors
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
