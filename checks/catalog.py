"""All registered queries."""

from checks import q_feeds, q_look_backs, q_relational, q_serving, q_streams, q_tables  # noqa: F401
from checks.registry import QUERIES, oracles

__all__ = ["QUERIES", "oracles"]
