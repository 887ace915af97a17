"""All registered queries of the platform's own operators."""

from . import export_queries, report_queries, scalar_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
