"""The registered queries, each next to the SQL that checks it."""

from tidemark.plans import (  # noqa: F401
    archive_queries,
    audit_queries,
    event_queries,
    message_queries,
    page_queries,
    sales_queries,
)
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
