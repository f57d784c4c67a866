"""The query catalogue: every query by name, and the SQL beside it."""

from lipika.plans import checks, corpus, records  # noqa: F401
from lipika.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
