"""Incremental, cohort-limited extracts of period-partitioned parquet families, as Spark DataFrame operators."""

from deltaextract.config import ColumnSpec, Dimension, EntitySpec, FamilySpec, FeedSpec

__all__ = ["ColumnSpec", "Dimension", "EntitySpec", "FamilySpec", "FeedSpec"]
