from rowtide.plans import (  # noqa: F401
    captures,
    inferred,
    ingest,
    logs,
    maintained,
    states,
    streams,
    summaries,
    tables,
)
from rowtide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
