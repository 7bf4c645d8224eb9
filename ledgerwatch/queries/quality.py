"""Expectations, metrics, fairness, monitoring and gates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import PROTECTED_COLUMNS, protected_columns
from ledgerwatch.operators import fairness, gates, metrics, monitor
from ledgerwatch.operators.monitor_tables import MonitorTables
from ledgerwatch.operators.quality import AMOUNT_DECENT, CORRECT_CUSTOMER, CORRECT_DATA, Expectation, report
from ledgerwatch.operators.sampling import split_name
from ledgerwatch.plans import features, validation
from ledgerwatch.plans.oracles import over
from ledgerwatch.plans.registry import query
from ledgerwatch.sources.binding import Bank
from ledgerwatch.sources.tables import VersionedTable, scratch, staged

DECIDED_AT = "2024-01-01 12:00:00"

KNOWN_DESTINATION = Expectation("known_destination", "nameDest IS NOT NULL")
OVERDRAWN = Expectation("balance_left", "newBalanceOrig > 0", "drop")


@query(
    over(
        "silver_transactions",
        select="""
SELECT 'correct_data' AS expectation, 'warn' AS policy, count(*) FILTER (WHERE id IS NOT NULL) AS passed,
       count(*) FILTER (WHERE id IS NULL) AS failed FROM silver_transactions
UNION ALL SELECT 'correct_customer_id', 'warn', count(*) FILTER (WHERE customer_id IS NOT NULL),
       count(*) FILTER (WHERE customer_id IS NULL) FROM silver_transactions
UNION ALL SELECT 'amount_decent', 'warn', count(*) FILTER (WHERE amount > 10),
       count(*) FILTER (WHERE (amount > 10) IS NOT TRUE) FROM silver_transactions
UNION ALL SELECT 'known_destination', 'warn', count(nameDest), count(*) - count(nameDest) FROM silver_transactions
UNION ALL SELECT 'balance_left', 'drop', count(*) FILTER (WHERE newBalanceOrig > 0),
       count(*) FILTER (WHERE (newBalanceOrig > 0) IS NOT TRUE) FROM silver_transactions""",
    )
)
def expectation_report(bank: Bank) -> DataFrame:
    return report(bank.silver, [CORRECT_DATA, CORRECT_CUSTOMER, AMOUNT_DECENT, KNOWN_DESTINATION, OVERDRAWN])


_COUNTS = """count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp"""


@query(over("fraud_scored", select=f"SELECT model_version, {_COUNTS} FROM fraud_scored GROUP BY 1"))
def confusion(bank: Bank) -> DataFrame:
    return metrics.confusion(bank.scored, ["model_version"])


@query(
    f"""SELECT {_COUNTS} FROM (SELECT quality AS label, 1 - toxic AS prediction FROM labels)""", name="confusion_labels"
)
def confusion_labels(bank: Bank) -> DataFrame:
    pairs = bank.table("labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    return metrics.confusion(pairs)


@query(
    over(
        "fraud_scored",
        ctes=f"counts AS (SELECT model_version, {_COUNTS} FROM fraud_scored GROUP BY 1)",
        select="""SELECT *, -500 * fp - 200000 * fn + 199500 * tp AS value,
                  -500 * fp + 200000 * fn + 199500 * tp AS value_as_written FROM counts""",
    )
)
def model_value(bank: Bank) -> DataFrame:
    counts = metrics.confusion(bank.scored, ["model_version"])
    return metrics.model_value(metrics.model_value(counts), metrics.AS_WRITTEN, "value_as_written")


@query(
    over(
        "fraud_scored",
        select="""SELECT model_version, CAST(-200000 * count(*) FILTER (WHERE prediction <> label AND label = 1)
                  AS DOUBLE) / count(*) AS expected_fraud_loss, count(label) AS labelled
                  FROM fraud_scored GROUP BY 1""",
    )
)
def expected_loss(bank: Bank) -> DataFrame:
    return bank.scored.groupBy("model_version").agg(
        metrics.expected_loss().alias("expected_fraud_loss"), F.count("label").alias("labelled")
    )


_REPORT = f"""
rows_ AS (SELECT s.label, s.prediction, CAST(s.risk_score AS DOUBLE) AS score, l.split
          FROM fraud_scored s JOIN fraud_labels l USING (transaction_id)),
counts AS (SELECT split, {_COUNTS}, round(avg(CASE WHEN label = 1 THEN -ln(least(greatest(score, 1e-15), 1 - 1e-15))
           ELSE -ln(1.0 - least(greatest(score, 1e-15), 1 - 1e-15)) END), 6) AS log_loss FROM rows_ GROUP BY split),
points AS (SELECT split, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
           FROM rows_ GROUP BY ALL),
walked AS (SELECT *, CAST(coalesce(sum(pos) OVER w, 0) AS DOUBLE) AS tp0,
           CAST(coalesce(sum(neg) OVER w, 0) AS DOUBLE) AS fp0 FROM points
           WINDOW w AS (PARTITION BY split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
areas AS (SELECT split,
  CAST(sum(neg * (2 * tp0 + pos)) AS DOUBLE) / (2 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc_auc,
  round(sum(pos * (CASE WHEN tp0 + fp0 = 0 THEN 1 ELSE tp0 / (tp0 + fp0) END
        + (tp0 + pos) / (tp0 + pos + fp0 + neg))) / (2 * CAST(sum(pos) AS DOUBLE)), 9) AS pr_auc
  FROM walked GROUP BY split)"""


@query(
    over(
        "fraud_scored",
        "fraud_labels",
        ctes=_REPORT,
        select="""SELECT split, tn, fp, fn, tp, log_loss, CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
  CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision, CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
  CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS false_positive_rate,
  CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1,
  (CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) + CAST(2 * tn AS DOUBLE) / (2 * tn + fp + fn)) / 2 AS f1_macro,
  round(roc_auc, 9) AS roc_auc, pr_auc FROM counts JOIN areas USING (split)""",
    )
)
def classification_report(bank: Bank) -> DataFrame:
    scored = bank.scored.withColumn("split", split_name(F.col("transaction_id")))
    result = metrics.classification_report(scored, "risk_score", ["split"])
    return result.withColumns(
        {c: F.round(c, digits) for c, digits in (("log_loss", 6), ("roc_auc", 9), ("pr_auc", 9))}
    )


def _slice_sql(dimension: str) -> str:
    return f"""SELECT '{dimension}' AS slice_dimension, CAST({dimension} AS STRING) AS slice_value, {_COUNTS}
               FROM fraud_scored WHERE {dimension} IS NOT NULL GROUP BY 2"""


SLICES_SQL = f"""
slice_counts AS ({" UNION ALL ".join(_slice_sql(d) for d in ("country", "age_group", "is_cross_border"))}),
slices AS (SELECT slice_dimension, slice_value, tn + fp + fn + tp AS n,
  CAST(tp + fn AS DOUBLE) / (tn + fp + fn + tp) AS positive_rate, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
  CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
  CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS false_positive_rate,
  CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp) AS selection_rate FROM slice_counts)"""


def _slices(bank: Bank) -> DataFrame:
    return fairness.subgroup_metrics(bank.scored, protected_columns(bank.scored.columns))


@query(over("fraud_scored", ctes=SLICES_SQL, select="SELECT * FROM slices"))
def subgroup_metrics(bank: Bank) -> DataFrame:
    return _slices(bank)


def _ratio_ctes(measure: str, extra: str) -> str:
    return f"""{SLICES_SQL},
measured AS (SELECT *, {measure} AS m FROM slices WHERE n >= 30 {extra}),
highs AS (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY slice_dimension ORDER BY m DESC, slice_value) = 1),
lows AS (SELECT * FROM measured QUALIFY row_number() OVER (PARTITION BY slice_dimension ORDER BY m, slice_value) = 1),
sizes AS (SELECT slice_dimension, count(*) AS k FROM measured GROUP BY 1),
pairs AS (SELECT h.slice_dimension AS dimension, h.slice_value AS max_slice, h.m AS max_calibration,
  h.selection_rate AS max_selection_rate, h.positive_rate AS max_positive_rate, h.n AS max_n,
  l.slice_value AS min_slice, l.m AS min_calibration, l.selection_rate AS min_selection_rate,
  l.positive_rate AS min_positive_rate, l.n AS min_n, h.m / l.m AS ratio
  FROM highs h JOIN lows l USING (slice_dimension) JOIN sizes USING (slice_dimension) WHERE k >= 2 AND l.m <> 0),
worst AS (SELECT * FROM pairs ORDER BY ratio DESC, dimension LIMIT 1)"""


_IMPACT = _ratio_ctes("selection_rate", "")
_CALIBRATION = _ratio_ctes("selection_rate / positive_rate", "AND positive_rate > 0")


@query(
    over(
        "fraud_scored",
        ctes=_IMPACT,
        select="""SELECT dimension, max_slice, max_selection_rate, max_n, min_slice, min_selection_rate, min_n, ratio
                  FROM worst""",
    )
)
def disparate_impact(bank: Bank) -> DataFrame:
    return fairness.worst_ratio(_slices(bank), fairness.DISPARATE_IMPACT)


@query(over("fraud_scored", ctes=_CALIBRATION, select="SELECT * FROM worst"))
def calibration_ratio(bank: Bank) -> DataFrame:
    return fairness.worst_ratio(_slices(bank), fairness.CALIBRATION)


@query(
    over(
        "fraud_scored",
        ctes=_CALIBRATION,
        select="""SELECT coalesce(max(ratio) <= 5.0, true) AS passes, max(ratio) AS worst_ratio,
                  max(dimension) AS dimension, max(max_slice) AS max_slice, max(min_slice) AS min_slice FROM worst""",
    )
)
def fairness_gate(bank: Bank) -> DataFrame:
    return fairness.fairness_gate(_slices(bank)).select(
        "passes", "worst_ratio", "detail.dimension", "detail.max_slice", "detail.min_slice"
    )


@query(
    over(
        "fraud_scored",
        ctes=SLICES_SQL,
        select="""SELECT slice_dimension AS dimension, count(*) AS slices,
  max(selection_rate / positive_rate) / nullif(min(selection_rate / positive_rate), 0) AS calibration_ratio,
  max(selection_rate) / nullif(min(selection_rate), 0) AS disparate_impact_ratio
  FROM slices WHERE n >= 30 AND positive_rate > 0 GROUP BY 1 HAVING count(*) >= 2""",
    )
)
def fairness_by_dimension(bank: Bank) -> DataFrame:
    return fairness.ratios_by_dimension(_slices(bank))


PROFILED = ["amount", "balance_orig_ratio", "risk_score"]

_PROFILE = f"""
expanded AS (SELECT date_trunc('day', event_ts) AS window_start, model_version, CAST(NULL AS STRING) AS slice_key,
    CAST(NULL AS STRING) AS slice_value, label, prediction, amount, balance_orig_ratio, risk_score FROM fraud_scored
  UNION ALL SELECT date_trunc('day', event_ts), model_version, 'is_cross_border = 1.0',
    CASE WHEN is_cross_border = 1.0 THEN 'true' ELSE 'false' END, label, prediction, amount, balance_orig_ratio,
    risk_score FROM fraud_scored),
grouped AS (SELECT window_start, model_version, slice_key, slice_value, count(*) AS n, count(label) AS labelled,
  {_COUNTS}, CAST(-200000 * count(*) FILTER (WHERE prediction <> label AND label = 1) AS DOUBLE) / count(*) AS loss,
  {", ".join(f"count({c}) AS c_{c}, avg({c}) AS avg_{c}, CAST(min({c}) AS DOUBLE) AS min_{c}, CAST(max({c}) AS DOUBLE) AS max_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS sd_{c}" for c in PROFILED)}
  FROM expanded GROUP BY 1, 2, 3, 4),
quality AS (SELECT *, CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f_pos,
  CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fp + fn, 0) AS f_neg FROM grouped),
profile AS (
  SELECT window_start, model_version, slice_key, slice_value, n, labelled, ':table' AS column_name, n AS count,
    CAST(0 AS BIGINT) AS num_nulls,
    (coalesce(f_pos, 0) + coalesce(f_neg, 0)) / nullif(CAST(f_pos IS NOT NULL AS INT) + CAST(f_neg IS NOT NULL AS INT), 0)
      AS f1_macro,
    CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS fraud_catch_rate, CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS false_alarm_rate,
    loss AS expected_fraud_loss, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
    CAST(NULL AS DOUBLE) AS stddev FROM quality
  {" ".join(f"UNION ALL SELECT window_start, model_version, slice_key, slice_value, n, labelled, '{c}', c_{c}, n - c_{c}, NULL, NULL, NULL, NULL, round(avg_{c}, 5), min_{c}, max_{c}, round(sd_{c}, 4) FROM quality" for c in PROFILED)})"""


def _profile(log: DataFrame) -> DataFrame:
    return monitor.profile_metrics(log, PROFILED, ts="event_ts")


def _reference(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_ts") < F.lit(REFERENCE_UNTIL).cast("timestamp_ntz"))


def _log(bank: Bank) -> DataFrame:
    """The inference log as a table: the bins come from its reference period, the histograms from all of it."""
    columns = {*PROFILED, *monitor.DRIFT_COLUMNS, "event_ts", "model_version"}
    return staged(bank.scored.select(*sorted(columns)), "log")


@query(over("fraud_scored", ctes=_PROFILE, select="SELECT * FROM profile"))
def profile_metrics(bank: Bank) -> DataFrame:
    return _profile_rows(_profile(bank.scored))


def _profile_rows(profile: DataFrame) -> DataFrame:
    return profile.select(
        F.col("window.start").alias("window_start"),
        "model_version", "slice_key", "slice_value", "n", "labelled", "column_name", "count", "num_nulls",
        F.col("f1_score.macro").alias("f1_macro"),
        "fraud_catch_rate", "false_alarm_rate", "expected_fraud_loss",
        F.round("mean", 5).alias("mean"), "min", "max", F.round("stddev", 4).alias("stddev"),
    )


def _kept_tables(bank: Bank) -> MonitorTables:
    """Three runs over the log; the second knows no labels yet, and the third takes its days again."""
    log = _log(bank)
    tables = MonitorTables(bank.spark, scratch(bank.spark, "monitor"), PROFILED, ts="event_ts")
    tables.fix_baseline(_reference(log))
    tables.refresh(log, dt.date(1994, 1, 1))
    tables.refresh(log.withColumn("label", F.lit(None).cast("int")), dt.date(1996, 7, 1))
    tables.refresh(log, dt.date(2100, 1, 1), since=dt.date(1994, 1, 1))
    return tables


@query(over("fraud_scored", ctes=_PROFILE, select="SELECT * FROM profile"))
def profile_incremental(bank: Bank) -> DataFrame:
    """The profile from tables that runs keep up to date, each reading new days only."""
    return _profile_rows(_kept_tables(bank).profile())


_RECENT_PROFILE = """recent_profile AS (
  SELECT window_start AS time_window, f1_macro, fraud_catch_rate, false_alarm_rate, expected_fraud_loss, model_version
  FROM profile WHERE column_name = ':table' AND slice_key IS NULL ORDER BY window_start DESC, model_version LIMIT 30)"""


@query(over("fraud_scored", ctes=f"{_PROFILE}, {_RECENT_PROFILE}", select="SELECT * FROM recent_profile"))
def recent_profile(bank: Bank) -> DataFrame:
    return monitor.recent_profile(_profile(bank.scored))


# The reference period of the drift queries: the first year of the log.
REFERENCE_UNTIL = "1996-01-01"
_RANGED = [c for c in monitor.DRIFT_COLUMNS if c not in monitor.VALUE_COLUMNS]

_CELLS = f"""
cells AS ({" UNION ALL ".join(f"SELECT event_ts, date_trunc('day', event_ts) AS window_start, model_version, '{c}' AS column_name, CAST({c} AS DOUBLE) AS v FROM fraud_scored" for c in monitor.DRIFT_COLUMNS)}),
reference AS (SELECT column_name, v FROM cells WHERE event_ts < TIMESTAMP '{REFERENCE_UNTIL}' AND isfinite(v)),
cuts AS (SELECT column_name, list_distinct(quantile_disc(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges
  FROM reference WHERE column_name IN ({", ".join(f"'{c}'" for c in _RANGED)}) GROUP BY 1),
known AS (SELECT DISTINCT column_name, v FROM reference),
binned AS (SELECT window_start, c.model_version, c.column_name,
  CASE WHEN c.v IS NULL THEN 'null' WHEN isnan(c.v) THEN 'NaN'
       WHEN e.edges IS NOT NULL THEN CAST(len(list_filter(e.edges, lambda x: x <= c.v)) AS STRING)
       WHEN k.v IS NULL THEN 'other' ELSE CAST(c.v AS STRING) END AS bin, event_ts < TIMESTAMP '{REFERENCE_UNTIL}' AS in_reference
  FROM cells c LEFT JOIN cuts e ON c.column_name = e.column_name LEFT JOIN known k ON c.column_name = k.column_name AND c.v = k.v),
hist AS (SELECT window_start, model_version, column_name, bin, count(*) AS rows_ FROM binned GROUP BY ALL),
sums AS (SELECT window_start, model_version, column_name, CAST(sum(rows_) AS DOUBLE) AS total
  FROM hist GROUP BY ALL),
totals AS (SELECT *, lag(window_start) OVER (PARTITION BY model_version, column_name ORDER BY window_start) AS previous
  FROM sums)"""

_CONSECUTIVE = """
now_ AS (SELECT t.window_start, t.model_version, t.column_name, h.bin, h.rows_ / t.total AS p, 0.0::DOUBLE AS q
  FROM totals t JOIN hist h USING (window_start, model_version, column_name) WHERE t.previous IS NOT NULL),
before_ AS (SELECT t.window_start, t.model_version, t.column_name, h.bin, 0.0::DOUBLE AS p, h.rows_ / o.total AS q
  FROM totals t JOIN totals o ON o.window_start = t.previous AND o.model_version = t.model_version
       AND o.column_name = t.column_name
  JOIN hist h ON h.window_start = t.previous AND h.model_version = t.model_version AND h.column_name = t.column_name),
aligned AS (SELECT window_start, model_version, column_name, bin, sum(p) AS p, sum(q) AS q
  FROM (SELECT * FROM now_ UNION ALL SELECT * FROM before_) GROUP BY ALL)"""

_DISTANCE = """
drift AS (SELECT window_start, model_version, column_name, sqrt(greatest(sum(
    0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
  + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END), 0)) AS js
  FROM aligned GROUP BY ALL)"""

_DRIFT = f"{_CELLS}, {_CONSECUTIVE}, {_DISTANCE}"


def _drift_rows(drift: DataFrame) -> DataFrame:
    return drift.select(
        F.col("window.start").alias("window_start"),
        "model_version",
        "column_name",
        "drift_type",
        F.round("js_distance", 7).alias("js_distance"),
    )


@query(
    over(
        "fraud_scored",
        ctes=_DRIFT,
        select="""SELECT window_start, model_version, column_name, 'CONSECUTIVE' AS drift_type,
                  round(js, 7) AS js_distance FROM drift""",
    )
)
def drift_consecutive(bank: Bank) -> DataFrame:
    log = _log(bank)
    return _drift_rows(monitor.drift_consecutive(log, monitor.fix_bins(_reference(log)), ts="event_ts"))


@query(over("fraud_scored", ctes=_DRIFT, select="""SELECT window_start, model_version, column_name, 'CONSECUTIVE' AS drift_type, round(js, 7) AS js_distance FROM drift"""))
def drift_incremental(bank: Bank) -> DataFrame:
    """Consecutive drift from the same tables."""
    return _drift_rows(_kept_tables(bank).drift_consecutive())


@query(
    over(
        "fraud_scored",
        ctes=f"""{_CELLS},
base AS (SELECT column_name, bin, count(*) AS rows_ FROM binned WHERE in_reference GROUP BY ALL),
base_total AS (SELECT column_name, CAST(sum(rows_) AS DOUBLE) AS total FROM base GROUP BY 1),
now_ AS (SELECT window_start, model_version, column_name, bin, rows_ / total AS p, 0.0::DOUBLE AS q
  FROM hist JOIN totals USING (window_start, model_version, column_name)),
before_ AS (SELECT t.window_start, t.model_version, column_name, b.bin, 0.0::DOUBLE AS p, b.rows_ / s.total AS q
  FROM totals t JOIN base b USING (column_name) JOIN base_total s USING (column_name)),
aligned AS (SELECT window_start, model_version, column_name, bin, sum(p) AS p, sum(q) AS q
  FROM (SELECT * FROM now_ UNION ALL SELECT * FROM before_) GROUP BY ALL), {_DISTANCE}""",
        select="""SELECT window_start, model_version, column_name, 'BASELINE' AS drift_type,
                  round(js, 7) AS js_distance FROM drift""",
    )
)
def drift_baseline(bank: Bank) -> DataFrame:
    log = _log(bank)
    reference = _reference(log)
    return _drift_rows(monitor.drift_baseline(log, reference, monitor.fix_bins(reference), ts="event_ts"))


_RECENT_DRIFT = """recent_drift AS (
  SELECT window_start AS time_window, column_name, round(js, 7) AS drift_metric, model_version FROM drift
  ORDER BY window_start DESC, model_version, column_name LIMIT 50)"""


def _recent_drift(log: DataFrame) -> DataFrame:
    return monitor.recent_drift(monitor.drift_consecutive(log, monitor.fix_bins(_reference(log)), ts="event_ts"))


@query(over("fraud_scored", ctes=f"{_DRIFT}, {_RECENT_DRIFT}", select="SELECT * FROM recent_drift"))
def recent_drift(bank: Bank) -> DataFrame:
    return _recent_drift(_log(bank)).withColumn("drift_metric", F.round("drift_metric", 7))


def _judged(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    drift = monitor.drift_consecutive(log, monitor.fix_bins(_reference(log)), ts="event_ts")
    return monitor.judged_profile(_profile(log)), monitor.judged_drift(drift)


_VIOLATIONS = f"""{_PROFILE}, {_DRIFT},
judged_profile AS (SELECT * FROM profile WHERE column_name = ':table' AND slice_key IS NULL AND window_start >=
  (SELECT min(w) FROM (SELECT DISTINCT window_start AS w FROM profile ORDER BY 1 DESC LIMIT {monitor.JUDGED_WINDOWS}))),
judged_drift AS (SELECT js AS drift_metric FROM drift WHERE window_start >=
  (SELECT min(w) FROM (SELECT DISTINCT window_start AS w FROM drift ORDER BY 1 DESC LIMIT {monitor.JUDGED_WINDOWS}))),
counted AS (SELECT
  (SELECT count(*) FROM judged_profile WHERE f1_macro < 0.5 OR fraud_catch_rate < 0.4 OR expected_fraud_loss < -50000)
    AS performance_violations,
  (SELECT count(*) FROM judged_drift WHERE drift_metric > 0.2) AS drift_violations)"""


@query(
    over(
        "fraud_scored",
        ctes=_VIOLATIONS,
        select="SELECT *, performance_violations + drift_violations AS total_violations FROM counted",
    )
)
def violations(bank: Bank) -> DataFrame:
    return monitor.violations(*_judged(_log(bank)))


@query(
    over(
        "fraud_scored",
        ctes=_VIOLATIONS,
        select="""SELECT *, performance_violations + drift_violations AS total_violations,
                  performance_violations + drift_violations > 0 AS retrain FROM counted""",
    )
)
def retrain_decision(bank: Bank) -> DataFrame:
    return monitor.retrain_decision(*_judged(_log(bank)))


@query(
    over(
        "fraud_scored",
        ctes=f"""{_CALIBRATION},
gate AS (SELECT coalesce(max(ratio) <= 5.0, true) AS passes FROM worst),
counts AS (SELECT model_version, {_COUNTS}, count(*) FILTER (WHERE prediction IS NULL) AS unscored
           FROM fraud_scored GROUP BY 1),
judged AS (SELECT *, CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1,
           -500 * fp - 200000 * fn + 199500 * tp AS value FROM counts),
flags AS (SELECT c.model_version, p.model_version AS champion_version, true AS has_description,
           c.unscored = 0 AS predicts, c.f1 >= p.f1 * 0.95::DOUBLE AS metric_f1_passed,
           c.value >= p.value AS business_metric_passed, passes AS fairness_passed
           FROM judged c, judged p, gate WHERE c.model_version = '2' AND p.model_version = '1')""",
        select=f"""SELECT 'rule' AS model_name, *, has_description AND predicts AND metric_f1_passed
  AND business_metric_passed AND fairness_passed AS promoted,
  CASE WHEN has_description AND predicts AND metric_f1_passed AND business_metric_passed AND fairness_passed
       THEN 'Approved' ELSE 'Failed' END AS approval_check, TIMESTAMP '{DECIDED_AT}' AS decided_at FROM flags""",
    )
)
def promotion_gate(bank: Bank) -> DataFrame:
    """Version 1 of the rule as champion, version 2 as challenger."""
    log = staged(bank.scored.select("model_version", "label", "prediction", *PROTECTED_COLUMNS), "log")
    keys = ["model_name", "model_version"]
    counts = [c.alias(n) for n, c in metrics.confusion_counts().items()]
    unscored = F.count_if(F.col("prediction").isNull()).alias("unscored")
    per_version = (
        log.groupBy("model_version")
        .agg(*counts, F.count("prediction").alias("scored"), unscored)
        .withColumn("model_name", F.lit("rule"))
    )
    # The model versions are a table of their own, one row each.
    measured = staged(metrics.model_value(metrics.rates(per_version)), "versions")
    gate = fairness.fairness_gate(fairness.subgroup_metrics(log, PROTECTED_COLUMNS))
    passed = gate.select(F.when(F.col("passes"), "Passed").otherwise("Failed")).scalar()
    version = F.col("model_version")
    versions = measured.select(
        *keys,
        F.when(version == "1", gates.CHAMPION).otherwise(gates.CHALLENGER).alias("alias"),
        F.concat(F.lit("Risk score rule, version "), version).alias("description"),
        passed.alias("fairness_check"),
    )
    performance = measured.select(*keys, "f1", "value", "scored", "unscored")
    return gates.promotion_gate(versions, performance, F.lit(DECIDED_AT).cast("timestamp_ntz"))


_CHALLENGER = """challenger AS (SELECT * REPLACE (CASE WHEN risk_score >= CAST(0.5 AS FLOAT) THEN 1 ELSE 0 END AS prediction) FROM fraud_scored),
both_versions AS (SELECT '1' AS model_version, label, prediction FROM fraud_scored UNION ALL SELECT '2', label, prediction FROM challenger)"""


@query(
    over(
        "fraud_scored",
        ctes=f"""{_CHALLENGER}, {_CALIBRATION.replace("fraud_scored", "challenger")},
gate AS (SELECT coalesce(max(ratio) <= 5.0, true) AS passes FROM worst),
counts AS (SELECT model_version, {_COUNTS}, count(*) FILTER (WHERE prediction IS NULL) AS unscored FROM both_versions GROUP BY 1),
judged AS (SELECT *, CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1, -500 * fp - 200000 * fn + 199500 * tp AS value FROM counts),
flags AS (SELECT c.model_version, p.model_version AS champion_version, true AS has_description, c.unscored = 0 AS predicts,
  c.f1 >= p.f1 * 0.95::DOUBLE AS metric_f1_passed, c.value >= p.value AS business_metric_passed, passes AS fairness_passed
  FROM judged c, judged p, gate WHERE c.model_version = '2' AND p.model_version = '1'),
decided AS (SELECT *, has_description AND predicts AND metric_f1_passed AND business_metric_passed AND fairness_passed AS promoted FROM flags)""",
        select=f"""SELECT 'rule' AS model_name, d.*, CASE WHEN promoted THEN 'Approved' ELSE 'Failed' END AS approval_check, TIMESTAMP '{DECIDED_AT}' AS decided_at,
  CASE WHEN promoted THEN '2' ELSE '1' END AS champion_after FROM decided d""",
    )
)
def model_validation(bank: Bank) -> DataFrame:
    """The rule with a lower cutoff against the rule in use, on the same rows, and which of them is the champion afterwards."""
    rows = bank.scored.drop("prediction", "model_version")

    def rule(cutoff: float):
        return lambda df: df.withColumn("prediction", features.rule_prediction(F.col("risk_score"), cutoff))

    known = [("rule", "1", gates.CHAMPION, "The risk score rule in use, cutoff 0.6"), ("rule", "2", gates.CHALLENGER, "The risk score rule with cutoff 0.5")]
    table = VersionedTable(bank.spark, scratch(bank.spark, "versions"))
    table.replace(bank.spark.createDataFrame(known, "model_name string, model_version string, alias string, description string"))
    decisions = staged(validation.validate(rows, {"1": rule(0.6), "2": rule(0.5)}, table.read(), "rule", DECIDED_AT), "decision")
    after = validation.promote(table, decisions).where(F.col("alias") == gates.CHAMPION)
    return decisions.join(after.select("model_name", F.col("model_version").alias("champion_after")), "model_name")
