"""All registered queries: importing the query modules fills the registry."""

from . import eval_queries, reward_queries, shaping_queries, source_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
