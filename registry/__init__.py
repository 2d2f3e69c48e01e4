"""The registered queries and the SQL each is checked against."""

from registry.core import ORACLES, QUERIES

from registry import sources, profile, select, clean, score, rank, variants, study, results, models, jobs  # noqa: F401, E402, I001

__all__ = ["ORACLES", "QUERIES"]
