"""Shared physical strategies: row order, hot keys, lineage, sizes."""
