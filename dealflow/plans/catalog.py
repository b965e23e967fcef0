"""Import every query module so that the registry is complete."""

from __future__ import annotations

from dealflow.plans import q_filings, q_landed, q_outcomes, q_stream, q_text, q_time  # noqa: F401
from dealflow.plans.registry import ORACLES, QUERIES, oracle_sql  # noqa: F401


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return {k: oracle_sql(k) for k in ORACLES}
