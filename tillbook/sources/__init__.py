"""Readers and writers."""

from tillbook.sources.tables import TABLES, load, table_path

__all__ = ["TABLES", "load", "table_path"]
