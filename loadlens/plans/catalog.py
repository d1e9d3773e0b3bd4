"""All registered queries."""

from loadlens.plans import keyed_queries, log_queries, report_queries, stream_queries  # noqa: F401
from loadlens.plans.registry import ORACLES, QUERIES  # noqa: F401
