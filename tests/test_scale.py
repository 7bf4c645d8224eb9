"""What must hold at any size: no unbounded collects, pruned and pushed-down scans, shared work.

That no query needs a cross join is checked in `test_queries.py`.
"""

import ast
import re
from collections import Counter
from pathlib import Path

from __spark_entry__ import queries
from ledgerwatch.plans import analytics
from ledgerwatch.sources.binding import Bank

ROOT = Path(__file__).resolve().parents[1] / "ledgerwatch"

# Every place where rows reach the driver, how often, and why their number is bounded.
BOUNDED = {
    ("operators/asof.py", "asof_join", "first"): (1, "one sum"),
    ("operators/metrics.py", "curve_areas", "count"): (1, "a number"),
    ("operators/monitor.py", "fix_bins", "collect"): (1, "at most MAX_VALUES per column"),
    ("operators/monitor.py", "fix_bins", "first"): (1, "one row of edges"),
    ("operators/monitor.py", "stored_bins", "collect"): (1, "one row per column"),
    ("operators/quality.py", "enforce", "collect"): (1, "one row per expectation"),
    ("plans/learning.py", "check_categories", "first"): (1, "one row of counts"),
    ("plans/learning.py", "fit", "count"): (1, "a number"),
    ("plans/learning.py", "numeric_stage", "first"): (1, "one row of column statistics"),
    ("plans/learning.py", "search", "count"): (1, "a number"),
    ("plans/learning.py", "search", "first"): (1, "one F1"),
    ("plans/lifecycle.py", "train_and_judge", "first"): (1, "the best trial"),
    ("plans/trees.py", "covered", "collect"): (1, "one row per leaf of a model that lies on the driver"),
    ("plans/trees.py", "fitted_forest", "collect"): (1, "the nodes of a model"),
    ("queries/storage.py", "one_customer", "first"): (1, "one id"),
    ("queries/storage.py", "one_customer_sql", "first"): (1, "one id"),
    ("sources/tables.py", "_manifest", "collect"): (1, "one row per partition, whose folders are listed anyway"),
    ("streaming/ingest.py", "follow", "collect"): (1, "marks of a batch"),
    ("streaming/ingest.py", "ingest_files", "collect"): (1, "names of the files of a batch"),
    ("sources/readers.py", "_by_header", "collect"): (1, "at most one row per file of a batch"),
    ("sources/rescue.py", "found_columns", "first"): (1, "one text with the columns"),
    ("streaming/ingest.py", "remembered", "first"): (1, "the note of a table's columns"),
}
WATCHED = {"collect", "toPandas", "first", "head", "take", "count", "toLocalIterator"}
FORBIDDEN = {"localCheckpoint", "crossJoin", "toPandas", "mapPartitions"}


def calls():
    """(file, function, method, node) of every method call; the function is the outermost one."""
    for path in (p for p in ROOT.rglob("*.py") if "llm" not in p.parts):
        for part in ast.parse(path.read_text()).body:
            for inner in part.body if isinstance(part, ast.ClassDef) else [part]:
                for node in ast.walk(inner):
                    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
                        base = node.func.value
                        if not (isinstance(base, ast.Name) and base.id == "F"):
                            yield str(path.relative_to(ROOT)), getattr(inner, "name", ""), node.func.attr, node


def test_only_bounded_results_reach_the_driver():
    """Each call is listed by its function, as often as it occurs there."""
    found = Counter((file, function, name) for file, function, name, node in calls() if name in WATCHED and (not node.args or name in ("take", "head")))
    assert found == {place: times for place, (times, _) in BOUNDED.items()}


def test_nothing_forbidden_is_used():
    assert not {(file, name) for file, _, name, _ in calls() if name in FORBIDDEN}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_it_needs(spark, small, folder):
    Bank(spark, small).gold.write.parquet(folder)
    gold = spark.read.parquet(folder)
    text = gold_plan = analytics.fraud_amount_by_route(gold)._jdf.queryExecution().toString()
    assert "GreaterThan(amount,350000.0)" in text and "EqualTo(is_fraud,true)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", gold_plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["amount", "countryDest", "countryOrig", "is_fraud", "type"]


def test_countries_are_broadcast_by_their_size(spark, small):
    assert plan(Bank(spark, small).gold).count("BroadcastHashJoin") >= 2


def test_all_dimensions_in_one_pass(spark, small):
    text = plan(queries()["subgroup_metrics"](spark, small))
    assert text.count("Expand") == 1
