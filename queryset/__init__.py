"""The queries that exercise every operator, with the SQL they are checked against."""

from queryset import predicates, ranges, reads, reconcile, stored, writes
from queryset.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "predicates", "ranges", "reads", "reconcile", "stored", "writes"]
