"""Registered queries, each with the SQL that must give the same rows."""

from ledgerline.plans import alerts, audits, deadletters, follow, orders, stats, streams
from ledgerline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "alerts", "audits", "deadletters", "follow", "orders", "stats", "streams"]
