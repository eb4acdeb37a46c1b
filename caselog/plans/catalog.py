"""All registered queries."""

from caselog.plans import answer_queries, case_queries, flow_queries, metric_queries, table_queries
from caselog.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
