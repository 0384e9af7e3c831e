"""Change-log analytics on Spark: decode database change events, keep them as a
typed change log, and query that log."""

from rowtide.specs import ORDERS, USERS, Field, TableSpec

__all__ = ["ORDERS", "USERS", "Field", "TableSpec"]
