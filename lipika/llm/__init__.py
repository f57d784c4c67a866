"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from lipika.llm import decontaminate, epsilon_join, line_blocks, mixing, near_dup, pii, quality_rules, toxicity_crf, training_order, url_filter

_MODULES = (url_filter, quality_rules, epsilon_join, line_blocks, training_order, toxicity_crf, decontaminate, pii, near_dup, mixing)


def queries() -> dict:
    """All queries of the subpackage by name."""
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those queries that SQL can express."""
    return {k: s for m in _MODULES for k, s in m.ORACLES.items()}
