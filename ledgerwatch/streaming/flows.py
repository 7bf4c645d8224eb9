"""The bank tables kept up to date from raw files, and scoring of a stream of requests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.operators.quality import (
    AMOUNT_DECENT,
    CORRECT_CUSTOMER,
    CORRECT_DATA,
    CORRECT_SCHEMA,
    READABLE_LABEL,
    enforce,
    report,
)
from ledgerwatch.plans import layers
from ledgerwatch.sources.readers import with_coordinates
from ledgerwatch.sources.tables import VersionedTable, matching_paths
from ledgerwatch.streaming.ingest import (
    StreamTable,
    follow,
    ingest_files,
    read_table,
    run_to_end,
)


@dataclass
class Lake:
    """Bronze and silver streaming tables and the gold table, fed from a folder of raw files.

    A lake that exists is opened at its newest generation.
    """

    spark: SparkSession
    raw: str
    folder: str
    generation: int | None = None
    max_files: int | None = 1

    def __post_init__(self):
        if self.generation is None:
            lives = matching_paths(self.spark, f"{self.folder}/bronze_transactions/g=*")
            self.generation = max((int(p.getName()[2:]) for p in lives), default=1)

    def stream_table(self, name: str) -> StreamTable:
        return StreamTable(f"{self.folder}/{name}", self.generation)

    @property
    def gold(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.folder}/gold_transactions")

    @property
    def gold_quality(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.folder}/gold_quality")

    def ingest(self) -> None:
        """Raw files to bronze tables; columns grow with the files, and what does not fit them is rescued."""

        def start(name: str, fmt: str, table: str, checks=(), **options):
            return ingest_files(self.spark, f"{self.raw}/{name}", fmt, self.stream_table(table), checks, **options)

        # Four independent queries; they run side by side.
        for query in [
            start("transactions", "json", "bronze_transactions", max_files=self.max_files),
            start("customers", "csv", "banking_customers", [CORRECT_SCHEMA], multi_line=True),
            start("country_code", "csv", "country_coordinates", prepare=with_coordinates, typed=False),
            start("fraud_report", "csv", "fraud_reports", typed=False),
        ]:
            run_to_end(query)

    def clean(self) -> None:
        """New bronze transactions to silver, labelled with the reports known by now."""
        reports = read_table(self.spark, self.stream_table("fraud_reports"))
        checks = [CORRECT_DATA, CORRECT_CUSTOMER, READABLE_LABEL]
        bronze, silver = self.stream_table("bronze_transactions"), self.stream_table("silver_transactions")
        run_to_end(follow(self.spark, bronze, silver, lambda rows: layers.silver(rows, reports), checks))

    def enrich(self) -> int:
        """Silver to gold, recomputed as a whole and replaced; sorted by step for readers that filter on it."""
        gold = layers.gold(
            read_table(self.spark, self.stream_table("silver_transactions")),
            read_table(self.spark, self.stream_table("country_coordinates")),
            read_table(self.spark, self.stream_table("banking_customers")),
        )
        version = self.gold.replace(enforce(gold, [AMOUNT_DECENT]), sort_by=["step"])
        self.gold_quality.replace(report(self.gold.read(version), [AMOUNT_DECENT]))
        return version

    def refresh(self, full: bool = False) -> Lake:
        """Take in what is new; `full` starts over from all raw files in a new generation."""
        lake = replace(self, generation=self.generation + 1) if full else self
        lake.ingest()
        lake.clean()
        lake.enrich()
        return lake


def score_requests(
    requests: DataFrame, snapshot: DataFrame, score: Callable[[DataFrame], DataFrame], key: str = "transaction_id"
) -> DataFrame:
    """Stream of ids joined to the feature snapshot and scored; an unknown id keeps null features."""
    return score(requests.join(snapshot, key, "left"))
