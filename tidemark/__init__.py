"""Metadata-driven change-data merging on Spark."""
