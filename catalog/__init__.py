"""One runnable query per operator, with the SQL that gives the same rows where SQL can."""

from catalog import bivariate, cleaning, evaluation, exploring, loading, modelling, preparing, streaming  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
