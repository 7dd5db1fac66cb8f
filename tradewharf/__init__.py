"""Brokerage analytics lakehouse built on the public PySpark API."""

from tradewharf.registry import Lake, table

__all__ = ["Lake", "table"]
