"""Registered queries over the test tables, each with the SQL that must give the same rows."""

from phonolake.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
