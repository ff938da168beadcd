"""Null-safe column expressions."""
