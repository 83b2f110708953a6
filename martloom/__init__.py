"""Spark-native building blocks for a retail star schema."""

from martloom.specs import SOURCE_TABLES, STAR_TABLES, Reference, TableSpec

__all__ = ["SOURCE_TABLES", "STAR_TABLES", "Reference", "TableSpec"]
