"""Every registered query. Importing the modules fills the registry."""

from ledgerwatch.plans.registry import ORACLES, QUERIES
from ledgerwatch.queries import bank, models, quality, storage, tables  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
