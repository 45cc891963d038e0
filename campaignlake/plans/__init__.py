"""Registered queries, their SQL oracles, and the materialized layer tables."""

from campaignlake.plans.catalog import QUERIES
from campaignlake.plans.lake import Lake
from campaignlake.plans.oracle import ORACLE_SQL

__all__ = ["Lake", "ORACLE_SQL", "QUERIES"]
