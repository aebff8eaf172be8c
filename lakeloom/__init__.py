"""Lakehouse jobs for retail data, written as PySpark DataFrame operators."""

__version__ = "0.1.0"
