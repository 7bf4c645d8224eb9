"""Queries by name, each with the SQL that a second engine can check it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.sources.binding import Bank

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Register a function Bank -> DataFrame under its name."""

    def register(function: Callable[[Bank], DataFrame]):
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Bank(spark, folder))
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register
