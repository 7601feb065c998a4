"""All registered queries."""

from quorumlens.catalog import (  # noqa: F401
    address_queries,
    ingest_queries,
    run_queries,
    safety_queries,
    scoring_queries,
    sink_queries,
    statistics_queries,
)
from quorumlens.catalog.registry import ORACLE, QUERIES  # noqa: F401
