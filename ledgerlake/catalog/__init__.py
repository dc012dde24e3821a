"""All registered queries and the SQL each has to agree with."""

from ledgerlake.catalog import (  # noqa: F401 - importing a module registers its queries
    q_cdc,
    q_changes,
    q_functions,
    q_gold,
    q_io,
    q_kept,
    q_merge,
    q_quality,
    q_silver,
    q_stream,
)
from ledgerlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
