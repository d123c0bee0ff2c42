"""The query catalog: importing this package registers every query."""

from rowtide.plans import q_envelope, q_io, q_merge, q_quality, q_scd2  # noqa: F401
from rowtide.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
