"""Command line: python tests/check_queries.py [sf] [name ...] prints time and differences per query."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.oracle import differences


def main(sf: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder, sql, bad = f"/root/testdata/sf{sf}", oracle_sql(), 0
    for name, function in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = function(spark, folder)
            problems = differences(df, sql[name], folder) if name in sql else [f"(no oracle) rows {len(df.collect())}"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems) and name in sql
        print(f"{name:28s} {time.time() - started:6.1f}s  {'ok' if not problems else problems}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "0.001", sys.argv[2:]))
