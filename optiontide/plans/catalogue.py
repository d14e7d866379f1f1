"""All registered queries."""

from optiontide.plans import queries_chain, queries_market, queries_records, queries_reference  # noqa: F401
from optiontide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
