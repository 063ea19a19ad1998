"""Claims analytics star schema as composable PySpark DataFrame functions."""

from claimstar.plans.star import TABLES, Star

__all__ = ["TABLES", "Star"]
