"""Panels from tables, dated Parquet datasets, matrices and settings."""
