"""Registered queries: each one reads the given tables and has, where possible, an SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cleaning, coverage, features, history, learning, modelling, quality, serving, signals, streams
from .sql import with_ctes

FAMILIES = (serving, modelling, cleaning, features, quality, history, streams, coverage, signals, learning)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for family in FAMILIES for name, (run, _) in family.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {
        name: with_ctes(text)
        for family in FAMILIES
        for name, (_, text) in family.QUERIES.items()
        if text is not None
    }
