"""All queries but those of the training-data subpackage."""

from .plans import act_queries, cascade_queries, consensus_queries, page_queries, recovery_queries, relational_queries, report_queries, sequence_queries, source_queries, stream_queries, temporal_queries, token_queries, verify_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
